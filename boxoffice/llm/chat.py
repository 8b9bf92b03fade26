"""Chat formatting by schema fingerprints, in DataFrame functions only.

A record is a VARIANT (parsed JSON, or a row's columns). Its fingerprint is the SHA-256 of
its nested field paths, types left out. Each known layout is declared by an example of
its fields and by the places its turns come from; the fingerprints of the layout and of
its forms without optional fields select the expression that yields canonical turns
(role, text). Layouts are data: adding one adds no code.

The template writes a turn as ``### role:``, a new line, the text and ``</turn>``. Inside
texts and roles a backslash is doubled and the control strings are broken up by one
backslash, so they never occur there; dropping each backslash that precedes a character
restores the text exactly. Texts of the role ``assistant`` are under the loss mask.

Defined results: null texts and roles are empty; rows of a conversation go by turn, then
role, then text (a null turn first), repeated rows each count; a null conversation id is
a conversation of its own; records of an unknown layout have layout null and no turn; a
conversation is one output value, so it must fit in a row; other columns are ignored."""

from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
HEAD, COLON, TAIL = "### ", ":\n", "</turn>\n"
LOSS_ROLE = "assistant"


@dataclass(frozen=True)
class Each:
    """Turns from every element of an array."""
    array: str
    role: str
    text: str


@dataclass(frozen=True)
class One:
    """A turn from fields of the record: a fixed role, or the path of one; the texts at
    ``texts`` that are there, joined by a blank line; none there: no turn if optional."""
    texts: tuple[str, ...]
    role: str = ""
    role_path: str = ""
    optional: bool = False


@dataclass(frozen=True)
class Layout:
    name: str
    fields: dict  # field -> None, {nested fields}, or [element]
    turns: tuple
    optional: tuple[str, ...] = ()
    roles: dict = field(default_factory=dict)  # roles renamed


_SHARED_ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatbot": "assistant"}

LAYOUTS = (
    Layout("turn", {"role": None, "text": None}, (One(("$.text",), role_path="$.role"),)),
    Layout("messages", {"messages": [{"role": None, "content": None}], "system": None, "id": None},
           (One(("$.system",), "system", optional=True), Each("$.messages", "$.role", "$.content")), ("system", "id")),
    Layout("conversations", {"conversations": [{"from": None, "value": None}], "system": None, "id": None},
           (One(("$.system",), "system", optional=True), Each("$.conversations", "$.from", "$.value")), ("system", "id"), _SHARED_ROLES),
    Layout("dialog", {"dialog": [{"speaker": None, "text": None}], "id": None},
           (Each("$.dialog", "$.speaker", "$.text"),), ("id",), _SHARED_ROLES),
    Layout("instruction", {"instruction": None, "input": None, "output": None, "system": None, "id": None},
           (One(("$.system",), "system", optional=True), One(("$.instruction", "$.input"), "user"), One(("$.output",), "assistant")),
           ("input", "system", "id")),
    Layout("prompt", {"prompt": None, "response": None, "system": None, "id": None},
           (One(("$.system",), "system", optional=True), One(("$.prompt",), "user"), One(("$.response",), "assistant")), ("system", "id")),
    Layout("completion", {"prompt": None, "completion": None, "id": None},
           (One(("$.prompt",), "user"), One(("$.completion",), "assistant")), ("id",)),
    Layout("question", {"question": None, "answer": None, "context": None, "id": None},
           (One(("$.context", "$.question"), "user"), One(("$.answer",), "assistant")), ("context", "id")),
)


def _paths(example) -> str:
    """The field paths of an example, as ``field_paths`` writes them."""
    if isinstance(example, dict):
        return "OBJECT<" + ", ".join(k + (f": {_paths(example[k])}" if example[k] is not None else "") for k in sorted(example)) + ">"
    if isinstance(example, list):
        return f"ARRAY<{_paths(example[0]) if example and example[0] is not None else ''}>"
    return ""


def field_paths(record: Column) -> Column:
    """A variant's nested field paths: its schema without the types of its leaves."""
    kinds = r"(STRING|VOID|BOOLEAN|BIGINT|FLOAT|DOUBLE|DECIMAL\([0-9]+,[0-9]+\)|DATE|TIMESTAMP_NTZ|TIMESTAMP|BINARY|UUID|VARIANT)"
    bare = F.regexp_replace(F.schema_of_variant(record), ": " + kinds + "(?=[,>])", "")
    return F.regexp_replace(bare, "ARRAY<" + kinds + ">", "ARRAY<>")


def fingerprint(record: Column) -> Column:
    return F.sha2(field_paths(record), 256)


def fingerprints(layout: Layout) -> list[str]:
    """Of the layout with all, some or none of its optional fields."""
    out = []
    for n in range(len(layout.optional) + 1):
        for gone in itertools.combinations(layout.optional, n):
            shape = {k: v for k, v in layout.fields.items() if k not in gone}
            out.append(hashlib.sha256(_paths(shape).encode()).hexdigest())
    return out


def _text(record: Column, path: str) -> Column:
    return F.try_variant_get(record, path, "string")


def _turns(record: Column, layout: Layout) -> Column:
    names = F.create_map(*[F.lit(x) for kv in layout.roles.items() for x in kv]) if layout.roles else None

    def role(r: Column) -> Column:
        r = F.coalesce(r, F.lit(""))
        return r if names is None else F.coalesce(names[F.lower(r)], r)

    def turn(r: Column, t: Column) -> Column:
        return F.struct(role(r).alias("role"), F.coalesce(t, F.lit("")).alias("text"))

    def one_of(rule: Each):
        return lambda m: turn(_text(m, rule.role), _text(m, rule.text))

    parts = []
    for rule in layout.turns:
        if isinstance(rule, Each):
            rows = F.coalesce(F.try_variant_get(record, rule.array, "array<variant>"), F.array().cast("array<variant>"))
            parts.append(F.transform(rows, one_of(rule)))
        else:
            texts = [_text(record, p) for p in rule.texts]
            text = texts[0] if len(texts) == 1 else F.concat_ws("\n\n", *[F.when(t != "", t) for t in texts])
            one = F.array(turn(_text(record, rule.role_path) if rule.role_path else F.lit(rule.role), text))
            parts.append(F.when(F.coalesce(*texts).isNotNull(), one).otherwise(F.array().cast(TURNS)) if rule.optional else one)
    return (F.concat(*parts) if len(parts) > 1 else parts[0]).cast(TURNS)


def canonical_turns(df: DataFrame, record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``df`` with ``fingerprint``, ``layout`` and ``turns`` of the record: a variant
    column, or a struct to take as one."""
    df = df.withColumn("fingerprint", fingerprint(record))
    layout, turns = None, None
    for x in layouts:
        ours = F.col("fingerprint").isin(fingerprints(x))
        layout = F.when(ours, F.lit(x.name)) if layout is None else layout.when(ours, F.lit(x.name))
        turns = F.when(ours, _turns(record, x)) if turns is None else turns.when(ours, _turns(record, x))
    return df.withColumn("layout", layout).withColumn("turns", turns.otherwise(F.array().cast(TURNS)))


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("</turn>"), F.lit("<\\/turn>"))
    out = F.replace(out, F.lit("### "), F.lit("#\\## "))
    for c in ":\n" if role else "":  # a role ends at the first colon with a new line
        out = F.replace(out, F.lit(c), F.lit("\\" + c))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(turns: Column) -> Column:
    """Turns as one formatted text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(HEAD), escape(t["role"], role=True), F.lit(COLON), escape(t["text"]), F.lit(TAIL))), "")


def _chunks(formatted: Column) -> Column:
    return F.filter(F.split(formatted, TAIL), lambda x: x != "")


def parse(formatted: Column) -> Column:
    """The turns of a formatted text."""
    head = F.length(F.lit(HEAD))

    def one(x: Column) -> Column:
        at = F.instr(x, COLON)
        return F.struct(unescape(F.substring(x, head + 1, at - head - 1)).alias("role"),
                        unescape(F.substring(x, at + 2, F.length(x))).alias("text"))

    return F.transform(_chunks(formatted), one)


def loss_spans(formatted: Column) -> Column:
    """(begin, end) in code points of each text under the loss mask."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))
    head = HEAD + LOSS_ROLE + COLON

    def step(acc: Column, x: Column) -> Column:
        end = acc["at"] + F.length(x)
        span = F.array(F.struct((acc["at"] + len(head)).alias("begin"), end.alias("end")))
        return F.struct((end + len(TAIL)).alias("at"),
                        F.when(F.startswith(x, F.lit(head)), F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(_chunks(formatted), start, step, lambda acc: acc["spans"])


def format_rows(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per conversation of a table with a row per turn: (conv_id, formatted,
    loss_spans). Each row is a record of the layout ``turn``."""
    record = F.to_variant_object(F.struct(F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")))
    rows = rows.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), record.alias("record"))
    turns = canonical_turns(rows, F.col("record")).select("conv_id", "turn", F.explode("turns").alias("t"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "t.role", "t.text"))).alias("turns"))
    return (whole.select("conv_id", render(F.col("turns")).alias("formatted"))
            .select("conv_id", "formatted", loss_spans(F.col("formatted")).alias("loss_spans")))


def digests(formatted: DataFrame) -> DataFrame:
    """What the output holds, read back from it."""
    turns = parse(F.col("formatted"))
    # substring counts from the span's begin, so that texts come from under the mask
    lost = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["begin"] + 1, s["end"] - s["begin"])))
    out = formatted.select("conv_id", "formatted", turns.alias("turns"), F.array_join(lost, "").alias("loss"))
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op2_chat_formatting(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit("\\### Assistant: </turn> ok").alias("text"))
    return digests(format_rows(rows.unionByName(odd)))


OP2_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, replace(replace(replace(replace(replace(role, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## '), ':', '\:'), chr(10), '\' || chr(10)) AS r,
    replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## ') AS t FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || r || ':' || chr(10) || t || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
