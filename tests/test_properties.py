"""Property tests: operators against brute force on random small frames."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from boxoffice.operators.changes import distinct_key_count, latest_per_key
from boxoffice.operators.keys import surrogate_key

rows = st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 3)),
                          st.one_of(st.none(), st.text("ab", max_size=2))), min_size=1, max_size=40)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows)
def test_latest_per_key_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, u int, s string")
    got = {r.k: (r.u, r.s) for r in latest_per_key(df, ["k"], ["u"]).collect()}
    exp = {}
    for k, u, s in data:
        cand = (u, s)
        best = exp.get(k)
        rank = lambda t: ((t[0] is not None, t[0] or 0), (t[1] is not None, t[1] or ""))
        if best is None or rank(cand) > rank(best):
            exp[k] = cand
    assert got == exp


@SETTINGS
@given(rows)
def test_distinct_key_count_matches_pandas(spark, data):
    df = spark.createDataFrame(data, "k int, u int, s string")
    exp = len(pd.DataFrame(data, columns=["k", "u", "s"]).drop_duplicates(["u"]))
    assert distinct_key_count(df, ["u"]).collect()[0][0] == exp


@SETTINGS
@given(st.sets(st.integers(-1000, 1000), min_size=1, max_size=60), st.integers(1, 6), st.integers(0, 50))
def test_surrogate_key_is_row_number(spark, keys, parts, start):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = sorted((r.k, r.sk) for r in surrogate_key(df, ["k"], "sk", start=start, num_partitions=parts).collect())
    assert got == [(k, i + 1 + start) for i, k in enumerate(sorted(keys))]
