"""Property tests (few examples each: every example runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyhouse.operators.dedupe import latest_per_key
from tallyhouse.operators.surrogate import assign_surrogate_keys

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(st.integers(0, 6),                                   # key
              st.one_of(st.none(), st.integers(0, 5)),             # update day (NULL allowed)
              st.one_of(st.none(), st.text("abc", max_size=2))),   # payload
    min_size=1, max_size=40)


def _py_latest(rows):
    """Newest update per key; ties by payload; NULL lowest (as max of a struct)."""
    def rank(r):
        _, ts, payload = r
        return (ts is not None, ts or 0, payload is not None, payload or "")
    best = {}
    for r in rows:
        if r[0] not in best or rank(r) > rank(best[r[0]]):
            best[r[0]] = r
    return sorted(best.values(), key=lambda r: r[0])


@SETTINGS
@given(rows_strategy)
def test_latest_per_key_matches_python(spark, rows):
    base = dt.datetime(2024, 1, 1)
    data = [(k, None if d is None else base + dt.timedelta(days=d), p) for k, d, p in rows]
    df = spark.createDataFrame(data, "k int, ts timestamp_ntz, payload string")
    got = sorted(((r["k"], r["ts"], r["payload"]) for r in latest_per_key(df, ["k"], "ts").collect()),
                 key=lambda r: r[0])
    want = [(k, None if d is None else base + dt.timedelta(days=d), p) for k, d, p in _py_latest(rows)]
    assert got == want


@SETTINGS
@given(st.sets(st.text("xyz0123", min_size=1, max_size=4), min_size=1, max_size=60),
       st.integers(1, 9), st.integers(0, 1000))
def test_surrogate_ids_are_rank_in_key_order(spark, keys, parts, start):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    out = assign_surrogate_keys(df, ["k"], "sk", start_after=start, num_partitions=parts)
    got = sorted((r["k"], r["sk"]) for r in out.collect())
    assert got == [(k, start + i + 1) for i, k in enumerate(sorted(keys))]
