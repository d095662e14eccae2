"""Exact top-k search by inner product: a Voronoi join (operator 6).

Vectors become whole numbers (floor of a multiple of each component).
Pivots, a bounded sample, cut the vectors into cells; queries of cells
are put together into groups of bounded size. For every cell its largest
distance from the pivot is summarised, and for every query a score that
its k-th best candidate reaches at least is taken from a bounded sample of
the data. A cell whose best possible score (pivot's score plus the query's
length times the cell's radius) stays below that for all queries of a
group is not sent to the group. The rest is solved group by group and
slice by slice as a matrix product.

Equal vectors stand for each other: of their ids only the k + 1 smallest
can be among the best k of any query, so one row per distinct vector and
those ids are compared.

Results in special cases: vectors that are null or hold null, NaN or
infinite components take no part, nor do rows without id; vectors of
unlike lengths are compared as if the shorter ended in zeros, so the empty
vector scores 0; scores beyond the range of a long are held at its ends;
rows of a repeated id count once (of unlike vectors the one whose packed
form is smallest); with fewer candidates than k all are returned; an empty
table gives an empty result; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import saved

SAMPLE = 2048  # data rows that lower bounds are taken from; pivots are among them
PIVOTS = 1024  # most cells; below that a quarter of the root of the number of vectors
GROUP_QUERIES = 1024  # queries of a group
SLICE_ROWS = 16384  # distinct data vectors of a slice
EXACT = float(1 << 53)
LONG = np.iinfo(np.int64)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, vector) of the rows that take part; the vector is packed as
    little-endian 64-bit floats of whole value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, packed = [], []
            for vec_id, x in zip(b["vec_id"].to_pylist(), b["vector"].to_pylist()):
                if vec_id is None or x is None or None in x:
                    continue
                values = np.asarray(x, dtype=np.float64)
                whole = np.floor(values * scale)
                if np.isfinite(values).all() and np.isfinite(whole).all():
                    ids.append(vec_id)
                    packed.append(_pack(whole))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packed, pa.binary())],
                                             names=["vec_id", "vector"])

    source = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                            F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    return source.mapInArrow(run, "vec_id long, vector binary")


def _pack(whole: np.ndarray) -> bytes:
    """Without trailing zeros, so that vectors that compare alike are equal."""
    used = np.flatnonzero(whole)
    return (whole[:used[-1] + 1 if len(used) else 0] + 0.0).astype("<f8").tobytes()


def _matrix(packed: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(packed), width))
    for i, x in enumerate(packed):
        out[i, :len(x) // 8] = np.frombuffer(x, "<f8")
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, held in the range of a long."""
    with np.errstate(over="ignore"):
        bound = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(a.shape[1], 1)
    if bound < EXACT:
        return (a @ b.T).astype(np.int64)
    left = np.array([[int(v) for v in r] for r in a], dtype=object).reshape(a.shape)
    right = np.array([[int(v) for v in r] for r in b], dtype=object).reshape(b.shape)
    return np.clip(left @ right.T, LONG.min, LONG.max).astype(np.int64)


def _distinct(rows: DataFrame, keep: int) -> DataFrame:
    """(vector, ids): distinct vectors with their smallest ids. The rank is
    cut before rows move, so a vector of any number of rows is small."""
    order = Window.partitionBy("vector").orderBy("vec_id")
    first = rows.select("vector", "vec_id").withColumn("at", F.row_number().over(order)).where(F.col("at") <= keep)
    return first.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _best(scores: np.ndarray, ids: list[list[int]], k: int) -> list[tuple[int, int]]:
    """The k best (score, id) of one query: higher scores, smaller ids."""
    top = min(k, len(scores))
    least = np.partition(scores, len(scores) - top)[len(scores) - top]
    found = [(int(scores[c]), i) for c in np.flatnonzero(scores >= least) for i in ids[c]]
    return sorted(found, key=lambda x: (-x[0], x[1]))[:k]


def nearest_cells(pivots: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and distance from its pivot of each row of ``x``."""
    with np.errstate(all="ignore"):  # a distance that overflows only widens its cell
        square = (x ** 2).sum(1)[:, None] - 2 * (x @ pivots.T) + (pivots ** 2).sum(1)[None, :]
        cell = square.argmin(axis=1)
        return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1))


def packed(counts: list[int], room: int) -> tuple[list[int], list[int]]:
    """Put cells in order into bins of about ``room`` rows. A larger cell is
    split over several bins: the first bin of each cell, and how many."""
    first, parts, last, left = [], [], -1, 0
    for n in counts:
        share = max(1, -(-n // room))
        if share > 1 or n > left or last < 0:
            last, left = last + 1, room - n
        else:
            left -= n
        first.append(last)
        parts.append(share)
        if share > 1:
            last, left = last + share - 1, 0
    return first, parts


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` rows of highest
    inner product for each row that ``is_query`` (a condition on the column
    ``vec_id``) selects; ties go to the smaller id."""
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col, scale).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = saved(rows, "vectors")
    data = saved(_distinct(rows, k + 1), "distinct-vectors")
    asked = rows.where(is_query)
    queries = asked.select("vector").distinct()
    size = data.agg(F.count("*").alias("rows"), F.coalesce(F.max(F.octet_length("vector")), F.lit(0)).alias("bytes")).first()
    total, width = size["rows"], size["bytes"] // 8
    schema = "query_id long, rank int, vec_id long, score long"
    if not total:
        return spark.createDataFrame([], schema)

    # A bounded sample by hash order: pivots and lower bounds.
    sample = data.orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).collect()
    sample_x = _matrix([bytes(r["vector"]) for r in sample], width)
    sample_ids = [list(r["ids"]) for r in sample]
    pivots = sample_x[:min(PIVOTS, max(16, int(total ** 0.5) // 4))]
    cells = len(pivots)

    def with_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, away = nearest_cells(pivots, _matrix(b["vector"].to_pylist(), width))
            yield pa.RecordBatch.from_arrays([*(b[c] for c in b.schema.names), pa.array(cell, pa.int32()), pa.array(away)],
                                             names=[*b.schema.names, "cell", "away"])

    data = saved(data.mapInArrow(with_cells, "vector binary, ids array<long>, cell int, away double"), "data-cells")
    queries = saved(queries.mapInArrow(with_cells, "vector binary, cell int, away double"), "query-cells")
    radius, rows_of = np.full(cells, -1.0), [0] * cells  # cells without data need no visit
    for r in data.groupBy("cell").agg(F.max("away").alias("radius"), F.count("*").alias("rows")).collect():
        radius[r["cell"]], rows_of[r["cell"]] = r["radius"], r["rows"]
    asked_of = {r["cell"]: r["count"] for r in queries.groupBy("cell").count().collect()}

    def bin_of(counts: list[int], room: int) -> Column:
        first, parts = (F.element_at(F.lit(x).cast("array<int>"), F.col("cell") + 1) for x in packed(counts, room))
        return first + F.pmod(F.xxhash64("vector"), parts).cast("int")

    queries = queries.withColumn("group", bin_of([asked_of.get(c, 0) for c in range(cells)], GROUP_QUERIES))
    data = data.withColumn("slice", bin_of(rows_of, SLICE_ROWS))

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate([np.full(len(x), i) for i, x in enumerate(sample_ids)])
        for b in batches:
            x = _matrix(b["vector"].to_pylist(), width)
            scores = _scores(x, sample_x).astype(np.float64)[:, ids]
            # k others than the query's own row are at least this good
            reach = np.sort(scores, axis=1)[:, -(k + 1)] if scores.shape[1] > k else np.full(len(x), -np.inf)
            with np.errstate(all="ignore"):
                length = np.sqrt((x ** 2).sum(1))
                most = x @ pivots.T + length[:, None] * radius[None, :]
                slack = 1 + 1e-9 * (np.abs(most) + length[:, None] * radius.max())
                # a bound that is no number shuts nothing out
                visit = ~(most + slack < reach[:, None]) & (radius != -1)[None, :]
            q, cell = np.nonzero(visit)
            group = b["group"].to_numpy()[q]
            pairs = np.unique(np.stack([group, cell]), axis=1) if len(q) else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()) for p in pairs], names=["group", "cell"])

    visits = queries.select("vector", "group").mapInArrow(needed, "group int, cell int").distinct()
    # groups x cells rows at most: small beside the data
    visits = saved(visits, "cell-visits")
    slices = data.select("cell", "slice").distinct()
    sent = data.join(visits, "cell").select("group", "slice", "vector", "ids")
    met = saved(visits.join(slices, "cell").select("group", "slice").distinct(), "slice-visits")
    asking = queries.select("group", "vector").join(met, "group")

    def solve(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            y, ids = _matrix(list(right["vector"]), width), [list(i) for i in right["ids"]]
            for start in range(0, len(left), 256):
                names = list(left["vector"][start:start + 256])
                for name, scores in zip(names, _scores(_matrix(names, width), y)):
                    out += [(name, i, s) for s, i in _best(scores, ids, k + 1)]
        return pd.DataFrame(out, columns=["vector", "vec_id", "score"])

    partial = asking.groupBy("group", "slice").cogroup(sent.groupBy("group", "slice")).applyInPandas(
        solve, "vector binary, vec_id long, score long")
    found = asked.withColumnRenamed("vec_id", "query_id").join(partial, "vector").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
