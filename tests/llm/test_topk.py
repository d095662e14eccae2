"""Operator 6 against brute force."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import queries, topk

SF = "/root/testdata/sf0.01"


def brute(rows, k):
    kept = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * x) for x in v]
        while whole and not whole[-1]:
            whole.pop()
        kept.setdefault(i, []).append(whole)
    one = {i: min(v, key=lambda w: np.array(w, "<f8").tobytes()) for i, v in kept.items()}
    out = set()
    for q, a in one.items():
        if q % 50 == 0:
            found = sorted((-max(min(sum(x * y for x, y in zip(a, b)), 2 ** 63 - 1), -2 ** 63), i) for i, b in one.items() if i != q)
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])}
    return out


def test_op6_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF}/embeddings.parquet')")
    sql = "select query_id, rank, vec_id, score from (" + queries.oracle_sql()["op6_voronoi_join"] + ")"
    assert sorted(map(tuple, queries.op6_voronoi_join(spark, SF).collect())) == sorted(con.execute(sql).fetchall())


def test_sql_equals_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert {tuple(r) for r in queries.op6_voronoi_join(spark, SF).collect()} == brute(rows, 5)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")).withColumn("cell", F.lit(1))


def solve(spark, rows, k=5):
    return [tuple(r) for r in topk.top_k(table(spark, rows), F.col("vec_id") % 50 == 0, k).collect()]


def test_hot_vectors_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "SAMPLE", 64)
    monkeypatch.setattr(topk, "PIVOTS", 16)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 7)
    monkeypatch.setattr(topk, "SLICE_ROWS", 150)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [0.5, -0.25, 1.0] if i % 3 == 0 else (centres[i % 6] + rng.normal(size=8) * 0.1).tolist()) for i in range(1200)]
    rows += [(None, [1.0]), (2000, None), (2050, []), (2100, [None, 1.0]), (2150, [math.nan]), (2200, [math.inf, 1.0]),
             (2250, [1.0] * 12), (0, [0.5, -0.25, 1.0]), (50, [9.0, 9.0]), (51, [9.0, 9.0])]
    found = solve(spark, rows)
    assert set(found) == brute(rows, 5) and len(found) == len(set(found))


def test_cells_are_packed_into_bins():
    assert topk.packed([3, 4, 5, 0, 25, 2, 9], 10) == ([0, 0, 1, 1, 2, 5, 6], [1, 1, 1, 1, 3, 1, 1])
    assert topk.packed([], 10) == ([], []) and topk.packed([0, 0], 10) == ([0, 0], [1, 1])


def test_few_rows_and_large_values(spark):
    assert solve(spark, []) == []
    assert solve(spark, [(50, [1.0])]) == []
    assert set(solve(spark, [(50, [1.0]), (7, [2.0]), (8, [0.0])])) == {(50, 1, 7, 131072), (50, 2, 8, 0)}
    rows = [(0, [1e9, 3.0]), (1, [1e9, 1.0]), (2, [1e300, 0.0]), (3, [-1e300, 1.0]), (4, [1e7 + 1 / 256, 5.0])]
    assert set(solve(spark, rows)) == brute(rows, 5)
    with pytest.raises(Exception):
        topk.top_k(table(spark, []).drop("embedding"), F.lit(True)).collect()
