"""Operator 11 against brute force and SQL."""

import hashlib
import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import common, queries
from tallyhouse.llm import vector_codes as vc

SF = "/root/testdata/sf0.01"
OUT = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def brute(rows, parts=8, entries=16, rounds=6):
    """Counter of result rows, in Python integers."""
    kept = [(i, [max(-2 ** 62, min(math.floor(4096 * x), 2 ** 62)) for x in v], c) for i, v, c in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return Counter()
    step = -(-max(1, *(len(v) for _, v, _ in kept)) // parts)
    kept = [(i, v + [0] * (step * parts - len(v)), c) for i, v, c in kept]
    cut = [[tuple(v[p * step:(p + 1) * step]) for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0))
    books = [[cut[k][p] for k in order[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for c in cut:
                mine.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [tuple(sum(col) // len(mine[n]) for col in zip(*mine[n])) if n in mine else e for n, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [min(sum(d for d, _ in f), 2 ** 63 - 1) for f in found]
    by_label = Counter()
    for (_, _, c), e in zip(kept, errors):
        by_label[c] += e
    return Counter((i, "".join(f"{n:02x}" for _, n in f), e, min(by_label[c], 2 ** 63 - 1), sha)
                   for (i, _, c), f, e in zip(kept, found, errors))


def solve(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for name in ("of", "rows", "error", "code", "vector", "label_error"):  # clashing names
        df = df.withColumn(name, F.lit("clash"))
    got = vc.compress(df, **kw)
    assert got.columns == list(OUT)
    return Counter(tuple(r) for r in got.collect())


def test_query_equals_sql_and_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF}/embeddings.parquet')")
    want = Counter(con.execute(f"select {', '.join(OUT)} from ({queries.oracle_sql()['op11_vector_codes']})").fetchall())
    got = Counter(tuple(r[c] for c in OUT) for r in queries.op11_vector_codes(spark, SF).collect())
    assert got == want and got
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got == brute(rows)


@pytest.mark.parametrize("fan", [2, 4, 7])
@pytest.mark.parametrize("most", [1, 3, 4096, 1 << 40])
def test_tree_equals_plain_search_with_ties(fan, most):
    rng = np.random.default_rng(most % 97 + fan)
    for size in (1, 2, 5, 16, 90):
        entries = rng.integers(-most, most + 1, (size, 3))
        x = np.concatenate([rng.integers(-most, most + 1, (200, 3)), entries])
        index, best = vc.SplitTree(entries, fan).nearest(x)
        square = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, e)) for e in entries] for r in x]
        assert [int(b) for b in best] == [min(s) for s in square]
        assert index.tolist() == [s.index(min(s)) for s in square]


def test_tree_leaves_out_whole_groups():
    rng = np.random.default_rng(1)
    centres = rng.integers(-100_000, 100_000, (12, 8))
    entries = np.repeat(centres, 16, axis=0) + rng.integers(-50, 50, (192, 8))
    x = np.repeat(centres, 100, axis=0) + rng.integers(-50, 50, (1200, 8))
    tree = vc.SplitTree(entries)
    index, best = tree.nearest(x)
    assert tree.measured < 0.35 * len(x) * len(entries)
    square = ((x[:, None] - entries[None]) ** 2).sum(2)
    assert (index == square.argmin(1)).all() and (best == square.min(1)).all()


def test_groups_touching_the_reach_are_not_left_out():
    # On a line, with whole distances: the second of two equally near entries
    # lies exactly at the reach, and the lower index wins.
    entries = np.array([[30], [10], [0], [20], [40], [12], [8]])
    x = np.arange(-5, 46)[:, None]
    for fan in (2, 3):
        index, _ = vc.SplitTree(entries, fan).nearest(x)
        assert index.tolist() == np.abs(x - entries.T).argmin(1).tolist()


ODD = [(500, None, 1), (501, [None, 1.0], 1), (502, [math.nan], 2), (503, [math.inf], 2), (None, [0.25, -0.5], 1), (504, [0.1] * 11, None),
       (505, [], None), (7, [0.1, 0.2], 3), (7, [0.1, 0.2], 3), (-3, [-1e-9], 3)]


@pytest.mark.parametrize("limit", [None, 0])
def test_hot_labels_ties_and_odd_rows(spark, monkeypatch, limit):
    if limit is not None:  # sums too large for a broadcast
        monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(vc, "HOT_SHARE", 5)
    rng = np.random.default_rng(2)
    rows = [(i, [0.5, 0.25] * 5 if i % 3 == 0 else (rng.integers(-3, 4, 10) / 4).tolist(), None if i % 4 == 1 else 5 if i % 4 else i)
            for i in range(300)] + ODD
    for kw in ({}, {"parts": 3, "entries": 5, "rounds": 2}):
        assert solve(spark, rows, **kw) == brute(rows, **kw)


def test_large_components(spark):
    rows = [(i, [x, -x / 3, x / 7], i % 2) for i, x in enumerate([1e10, 2e10, 3e15, 4e15, -1e9, 1e12, 5e5, 1e17, 1e300, -1e300])]
    assert solve(spark, rows, parts=2, entries=3) == brute(rows, 2, 3)


def test_small_tables(spark):
    assert solve(spark, []) == Counter()
    assert solve(spark, [(1, None, 1)]) == Counter()
    for rows in ([(5, [1.0], 1)], [(5, [], 1)], ODD):
        assert solve(spark, rows) == brute(rows)
    with pytest.raises(ValueError):
        solve(spark, [(1, [1.0], 1)], entries=300)
