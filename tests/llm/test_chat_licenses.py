"""Chat formatting (round trips, layouts) and license scan, with odd rows."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boxoffice.llm import chat, licenses

PIECES = ["\\", "</turn>", "### ", "###", "#", ":", "\n", "</turn>\n", "assistant", "a", "é🙂", "$1", " "]


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int, layout int")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(PIECES), max_size=6), st.lists(st.sampled_from(PIECES), max_size=12)), min_size=1, max_size=30))
def test_turns_read_back(spark, turns):
    rows = [(1, k, "".join(r), "".join(t), 0, 0) for k, (r, t) in enumerate(turns)]
    out = chat.format_rows(frame(spark, rows))
    got = out.select(chat.parse(F.col("formatted")).alias("t")).first()["t"]
    assert [(x["role"], x["text"]) for x in got] == [(r[2], r[3]) for r in rows]
    loss = "".join(r[3] for r in rows if r[2] == "assistant")
    d = chat.digests(out).first()
    assert (d["loss_chars"], d["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert d["formatted_chars"] == len(out.first()["formatted"])


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x", 1, 1), (2, None, None, None, 1, 1), (2, 0, "assistant", None, 1, 1), (2, 0, "assistant", None, 1, 1)]
    got = {r["conv_id"]: r for r in chat.digests(chat.format_rows(frame(spark, rows))).collect()}
    assert got[None]["n_turns"] == 1 and got[2]["n_turns"] == 3
    assert got[2]["turns_sha256"] == hashlib.sha256(b"\n\nassistant\n\nassistant\n\n").hexdigest()
    assert got[2]["loss_chars"] == 0
    assert chat.digests(chat.format_rows(frame(spark, []))).count() == 0


def test_layouts(spark):
    records = {
        '{"messages":[{"role":"user","content":"hi"},{"content":"yo","role":"assistant"}],"id":3}': ("messages", [("user", "hi"), ("assistant", "yo")]),
        '{"output":"done","instruction":"do","input":"it"}': ("instruction", [("user", "do\n\nit"), ("assistant", "done")]),
        '{"instruction":"do","output":null}': ("instruction", [("user", "do"), ("assistant", "")]),
        '{"conversations":[{"from":"human","value":"a"},{"from":"gpt","value":1}],"system":"s"}': ("conversations", [("system", "s"), ("user", "a"), ("assistant", "1")]),
        '{"prompt":"p","completion":"c"}': ("completion", [("user", "p"), ("assistant", "c")]),
        '{"question":"q","answer":"a","context":""}': ("question", [("user", "q"), ("assistant", "a")]),
        '{"other":1}': (None, []), "[1]": (None, []), "no json": (None, []),
    }
    df = spark.createDataFrame([(k,) for k in records], "j string").withColumn("r", F.try_parse_json("j"))
    for row in chat.canonical_turns(df, F.col("r")).collect():
        assert (row["layout"], [(t["role"], t["text"]) for t in row["turns"]]) == records[row["j"]], row["j"]


def test_field_paths_ignore_types(spark):
    df = spark.createDataFrame([('{"a":{"b":[1,2]},"c":"x"}',), ('{"c":1.5,"a":{"b":["y"]}}',), ('{"a":{"b":[]},"c":null}',)], "j string")
    assert df.select(chat.field_paths(F.parse_json("j"))).distinct().count() == 1


def brute_licenses(text):
    import re
    parts = re.split("\r\n|[\r\n]", text or "")
    parts += [p for p in re.split(r"(?:\r\n|[\r\n])(?:[\W_]*?(?:\r\n|[\r\n]))+", text or "") if re.search("[\r\n]", p)]
    best, n = None, 0
    for unit, part in enumerate(parts):
        own = set(licenses.template_bigrams(part))
        for name, kind, theirs in licenses.templates():
            if own and 2 * len(own & set(theirs)) / (len(own) + len(theirs)) >= licenses.THRESHOLD:
                n += 1
                key = (-2 * len(own & set(theirs)) / (len(own) + len(theirs)), name, unit, kind)
                best = min(best, key) if best else key
    return (best[1], best[3], -best[0], best[2], n) if best else (None, None, None, None, 0)


def test_licenses_against_brute_force(spark):
    mit = licenses.TEMPLATES[5][2]
    texts = [None, "", "one", "Prose here.\nReleased under the MIT License.\nmore", "released, under THE mit license", mit,
             "\n".join(mit[i:i + 60] for i in range(0, len(mit), 60)) + "\n\nother text",
             "first part\r\n\r\n" + "\r\n".join(mit[i:i + 60] for i in range(0, len(mit), 60)) + "\r\n \r\n\r\nother text",
             "// Name\n//\n// " + "\n// ".join(mit[i:i + 60] for i in range(0, len(mit), 60)) + "\n// --\ncode()",
             mit.replace("copy", "clone").replace("Software", "Work"), "license " * 5000, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0."]
    rows = [(i, t, 0, "x") for i, t in enumerate(texts)] + [(3, texts[3], 0, "x"), (None, texts[4], 0, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, unit int, license string")
    got = licenses.scan(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert tuple(r)[1:] == brute_licenses(texts[r["doc_id"]]), texts[r["doc_id"]]
    assert [r["license"] for r in got if r["doc_id"] is None] == ["MIT"]
    assert licenses.scan(df.limit(0)).count() == 0


def test_short_notices_are_found(spark):
    """The licence lines of the tables, and what only looks like one."""
    lines = {"This work is licensed under the GNU General Public License, version 3.": ("GPL-3.0", "copyleft"),
             "All rights reserved.": ("proprietary", "proprietary"), "ALL RIGHTS RESERVED": ("proprietary", "proprietary"),
             "Licensed under CC BY-NC 4.0.": ("CC-BY-NC-4.0", "non-commercial"), "Released under the MIT License.": ("MIT", "permissive"),
             "Licensed under the Apache License, Version 2.0.": ("Apache-2.0", "permissive"), "All rights": (None, None)}
    rows = [(i, f"Some words of prose.\n{line}\nand more words") for i, line in enumerate(lines)]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, want in enumerate(lines.values()):
        assert (got[i]["license"], got[i]["kind"]) == want
        assert got[i]["unit"] == (1 if want[0] else None)
