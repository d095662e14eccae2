"""Operator 12 against brute force and SQL."""

import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import hard_negatives as hn
from tallyhouse.llm import queries

SF = "/root/testdata/sf0.01"
OUT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, step=100, k=5):
    """Counter of result rows; labels are given as they count."""
    held = lambda x, n=2 ** 63: max(-n, min(x, n - 1))
    part = [(i, [max(-2 ** 62, min(math.floor(256 * x), 2 ** 62)) for x in v], c) for i, v, c in rows
            if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for at, (i, v, c) in enumerate(part):
        if i % step:
            continue
        scored = [(held(sum(x * y for x, y in zip(v, w))), j, d) for b, (j, w, d) in enumerate(part) if b != at]
        for score, j, _ in sorted((s for s in scored if s[2] == c), key=lambda s: (-s[0], s[1]))[:k]:
            near = sorted((s for s in scored if s[2] != c and 80 * score <= 100 * s[0] <= 100 * score), key=lambda s: (-s[0], s[1]))
            for rank, (s, n, _) in enumerate(near[:k], 1):
                out[i, j, rank, n, score, s] += 1
    return out


def solve(spark, rows, step=100, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for name in ("row", "score", "block", "at", "vector"):  # clashing names
        df = df.withColumn(name, F.lit("clash"))
    got = hn.mine(df, F.col("vec_id") % step == 0, **kw)
    assert got.columns == list(OUT)
    return Counter(tuple(r) for r in got.collect())


def test_query_equals_sql_and_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF}/embeddings.parquet')")
    want = Counter(con.execute(f"select {', '.join(OUT)} from ({queries.oracle_sql()['op12_hard_negatives']})").fetchall())
    got = Counter(tuple(r[c] for c in OUT) for r in queries.op12_hard_negatives(spark, SF).collect())
    assert got == want and got
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got == brute(rows)


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 64, 5), (16, 16, 16), (33, 33, 70), (100, 64, 257), (64, 0, 3), (0, 8, 3)])
def test_strassen_equals_the_plain_product(shape):
    rng = np.random.default_rng(sum(shape))
    m, k, n = shape
    for most in (256, 1 << 30, 1 << 61):
        a, b = rng.integers(-most, most, (m, k)), rng.integers(-most, most, (k, n))
        want = a.astype(object) @ b.astype(object) if m and n and k else np.zeros((m, n), object)
        assert (hn.product(a, b) == np.clip(want, -2 ** 63, 2 ** 63 - 1)).all()


def test_strassen_recurses_and_stays_exact_where_sums_wrap(monkeypatch):
    leaves = []
    plain = hn._leaf
    monkeypatch.setattr(hn, "_leaf", lambda a, b: leaves.append(a.shape) or plain(a, b))
    a = np.full((64, 64), 1 << 28)
    b = np.full((64, 64), (1 << 28) - 1)
    assert (hn.product(a, b) == 64 * (1 << 28) * ((1 << 28) - 1)).all()  # the leaves' sums pass 2^53
    assert len(leaves) == 49 and set(leaves) == {(16, 16)}


def test_window():
    for score in (-7, -1, 0, 1, 2, 5, 99, 101):
        low, high = hn.window(score, 80, 100)
        assert [s for s in range(-200, 200) if 80 * score <= 100 * s <= 100 * score] == list(range(low, high + 1))


def test_hot_vectors_ties_blocks_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 9)
    monkeypatch.setattr(hn, "SLICE_ROWS", 130)
    monkeypatch.setattr(hn, "TILE_ROWS", 4)
    rng = np.random.default_rng(5)
    rows = [(i, [0.5, 0.25, 1.0] if i % 3 == 0 else (rng.normal(size=5) * 0.4).tolist(), int(i % 4)) for i in range(600)]
    rows += [(600, None, 1), (601, [None, 1.0], 1), (602, [math.nan], 2), (603, [math.inf, 0.0], 2), (None, [9.0], 1),
             (604, [9.0, 9.0], None), (700, [], 1), (620, [0.0], 1), (20, [0.5, 0.25, 1.0], 0), (20, [0.5, 0.25, 1.0], 0),
             (-20, [1e-9, 0.3], 3), (40, [-1.0, -1.0], 2)]
    want = brute(rows, step=20)
    assert solve(spark, rows, step=20) == want and sum(want.values()) > 300


def test_large_components(spark):
    rows = [(i, [x, -x / 3, 1e300 if i == 5 else x / 7], i % 2) for i, x in enumerate([1e10, 2e10, 3e15, 4e15, -1e9, 1e12, 5e5, 1e17])]
    assert solve(spark, rows, step=1) == brute(rows, step=1)


def test_small_tables(spark):
    assert solve(spark, []) == Counter()
    assert solve(spark, [(100, [1.0], 1)]) == Counter()
    assert solve(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == Counter()  # no anchor
    assert solve(spark, [(100, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)]) == Counter({(100, 1, 1, 2, 65536, 58880): 1})
