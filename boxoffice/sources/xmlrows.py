"""S-4: rows of large XML files, split over many tasks at their true borders.

Files are read as text that ends rows at the closing row tag, so a file's splits are read by
different tasks. A closing tag inside a comment, CDATA section or processing instruction
ends no row, and a split may begin inside one. So a piece of text is taken as a function from the
state it begins in to the one it ends in. Each split composes its own pieces' functions
(those with a marker, that is; all others keep the state); composing the splits of a file
in order says in which state each begins. With that known, a second pass over the splits ends
rows where the state is plain text. What a row has in more than one split, a few pieces at
split borders, is put together by file."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxoffice.session import ship

# Markers that begin and end what may hold a closing tag (fixed by the format).
OPENS = ["", "<!--", "<![CDATA[", "<?"]
CLOSES = ["", "-->", "]]>", "?>"]
TEXT = 0


def _end_state(piece: str, state: int) -> int:
    """The state that a piece ends in."""
    at = 0
    while True:
        if state:
            at = piece.find(CLOSES[state], at)
            if at < 0:
                return state
            at += len(CLOSES[state])
        found = [(i, s) for s in (1, 2, 3) if (i := piece.find(OPENS[s], at)) >= 0]
        if not found:
            return TEXT
        i, state = min(found)
        at = i + len(OPENS[state])


def _pieces(spark: SparkSession, path: str, tag: str) -> DataFrame:
    return (spark.read.option("lineSep", f"</{tag}>").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"))


def open_splits(pieces: DataFrame) -> DataFrame:
    """(file, after, until, state): splits of a file with ``after`` < block <= ``until`` begin in
    ``state``; those of no row begin in plain text. At most a row a split."""
    end_state, count = _end_state, len(OPENS)

    def compose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict[tuple[str, int], list[int]] = {}
        for b in batches:
            for file, block, value in zip(*(c.to_pylist() for c in b.columns)):
                states = now.setdefault((file, block), list(range(count)))
                ends = {s: end_state(value, s) for s in set(states)}
                now[file, block] = [ends[s] for s in states]
        keys = list(now)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
                                          pa.array([now[k] for k in keys], pa.list_(pa.int32()))], ["file", "block", "ends"])

    def follow(splits: pd.DataFrame) -> pd.DataFrame:
        splits = splits.sort_values("block")
        state, out = TEXT, []
        blocks = [*splits["block"].tolist(), (1 << 63) - 1]
        for block, until, ends in zip(blocks, blocks[1:], splits["ends"]):
            state = int(ends[state])
            if state != TEXT:
                out.append((splits["file"].iloc[0], block, until, state))
        return pd.DataFrame(out, columns=["file", "after", "until", "state"])

    marked = F.lit(False)
    for m in OPENS[1:] + CLOSES[1:]:
        marked = marked | F.contains("value", F.lit(m))
    per_split = pieces.where(marked).mapInArrow(compose, "file string, block long, ends array<int>")
    return per_split.groupBy("file").applyInPandas(follow, "file string, after long, until long, state int")


def xml_rows(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """(row): the text of every ``<tag>`` element under ``path``, from its opening to its closing tag.
    Elements of that name within one another are not told apart."""
    ship(spark)
    pieces = _pieces(spark, path, tag)
    opened = F.broadcast(open_splits(pieces).withColumnRenamed("file", "_file"))
    same_file = F.col("file") == F.col("_file")

    def begun(some: DataFrame) -> DataFrame:
        return some.join(opened, same_file & (F.col("block") > F.col("after")) & (F.col("block") <= F.col("until")), "left") \
            .select("file", "block", "value", F.coalesce("state", F.lit(TEXT)).alias("state"))
    end_state, close = _end_state, f"</{tag}>"
    begin = re.compile(rf"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|(<{re.escape(tag)}[\s>])", re.S)

    def element(text: str) -> str | None:
        for m in begin.finditer(text):
            if m.group(1):
                return text[m.start():] + close
        return None

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, held, head = None, TEXT, [], False

        def rest() -> list[tuple]:
            """What the split leaves to others: nothing, or the beginning (or middle) of a row."""
            return [(None, *at, 1, not head, close.join(held))] if held and state != TEXT else []

        for b in batches:
            out: list[tuple] = []
            for file, block, value, start in zip(*(c.to_pylist() for c in b.columns)):
                if at != (file, block):
                    out += rest()
                    at, state, held, head = (file, block), start, [], start != TEXT
                held.append(value)
                state = end_state(value, state)
                if state == TEXT:
                    text, held = close.join(held), []
                    if head:                             # the end of a row that began in an earlier split
                        out.append((None, *at, 0, False, text))
                    elif row := element(text):
                        out.append((row, *at, 0, False, None))
                    head = False
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=schema)
        if at is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rest()], schema=schema)

    names = ["row", "file", "block", "place", "begins", "part"]
    schema = pa.schema([("row", pa.string()), ("file", pa.string()), ("block", pa.int64()), ("place", pa.int32()), ("begins", pa.bool_()), ("part", pa.string())])
    kinds = "row string, file string, block long, place int, begins boolean, part string"
    # only splits that end or begin inside a marked section share a row; the others are cut once, for whole rows
    sharing = pieces.join(opened, same_file & (F.col("block") >= F.col("after")) & (F.col("block") <= F.col("until")), "left_semi")
    order = Window.partitionBy("file").orderBy("block", "place")
    parts = begun(sharing).mapInArrow(cut, kinds).where("part is not null").withColumn("n", F.sum(F.col("begins").cast("long")).over(order))
    texts = parts.groupBy("file", "n").agg(F.array_sort(F.collect_list(F.struct("block", "place", "part"))).alias("p")) \
        .select(F.concat(F.array_join(F.transform("p", lambda x: x["part"]), close), F.lit("")).alias("text"))

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([element(t) for t in b["text"].to_pylist()], pa.string())], ["row"])

    return begun(pieces).mapInArrow(cut, kinds).where("row is not null").select("row").unionByName(texts.mapInArrow(finish, "row string").where("row is not null"))
