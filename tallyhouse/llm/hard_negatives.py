"""Hard-negative mining by Strassen products (operator 12).

Vectors become whole numbers (floor of a multiple of each component).
Anchors are cut into blocks and all rows into slices; a task holds one
block and one slice and multiplies them tile by tile: Strassen's recursion
on 64-bit integers, padded with zeros to even halves, down to leaves of
LEAF rows or columns. Additions of 64-bit integers are exact modulo 2^64,
so the sums of the seven products are the scores whenever these fit a
long. Each tile keeps, for each anchor, a bounded list of its best rows;
the lists of all slices are merged by rank.

The first pass keeps the best rows of the anchor's own label, its
positives. The second keeps, for each positive, the best rows of other
labels in the window of scores that the positive opens.

Results in special cases: rows without id or label, and rows whose vector
is null or holds a null, NaN or infinite component take no part; rows of a
repeated id count one by one, also when they are alike (ties between them
do not show); ties go to the smaller id; vectors of unlike or no length
are compared as if the shorter ended in zeros; components beyond 2^62 and
scores beyond the range of a long are held at its ends; a positive score
below zero opens no window; an empty table, or one without anchors, gives
an empty result; other columns are not used, whatever their names. The
label's text decides which labels are the same.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import saved
from tallyhouse.llm.whole_vectors import matrix, whole_vectors

LEAF = 16  # smallest side that is still halved
BLOCK_ROWS = 8192  # anchors of a block
SLICE_ROWS = 8192  # rows of a slice
TILE_ROWS = 256  # anchors that are multiplied at once
EXACT = 1 << 53
LONG = np.iinfo(np.int64)
FOUND = "anchor_row long, anchor_id long, at int, vec_id long, row long, score long"


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of whole numbers modulo 2^64 (of Python integers: in full).
    Where no sum can leave the range in which a double is exact, doubles
    are multiplied."""
    if a.dtype != object and a.size and b.size:
        x, y = a.astype(np.float64), b.astype(np.float64)
        if np.abs(x).max() * np.abs(y).max() * a.shape[1] < EXACT:
            return (x @ y).astype(np.int64)
    return a @ b


def _halves(x: np.ndarray) -> tuple[np.ndarray, ...]:
    r, c = x.shape[0] // 2, x.shape[1] // 2
    return x[:r, :c], x[:r, c:], x[r:, :c], x[r:, c:]


def _strassen(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return _leaf(a, b)
    a11, a12, a21, a22 = _halves(a)
    b11, b12, b21, b22 = _halves(b)
    down = levels - 1
    p1 = _strassen(a11 + a22, b11 + b22, down)
    p2 = _strassen(a21 + a22, b11, down)
    p3 = _strassen(a11, b12 - b22, down)
    p4 = _strassen(a22, b21 - b11, down)
    p5 = _strassen(a11 + a12, b22, down)
    out = np.empty((a.shape[0], b.shape[1]), p1.dtype)
    o11, o12, o21, o22 = _halves(out)
    o12[:], o21[:] = p3 + p5, p2 + p4
    o11[:] = p1 + p4 - p5 + _strassen(a12 - a22, b21 + b22, down)
    o22[:] = p1 - p2 + p3 + _strassen(a21 - a11, b11 + b12, down)
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b`` of 64-bit integers, held in the range of a long."""
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if not (rows and inner and columns):
        return np.zeros((rows, columns), np.int64)
    most = [max(abs(int(x.max())), abs(int(x.min()))) for x in (a, b)]
    wide = most[0] * most[1] * inner > LONG.max
    levels = max(0, (min(rows, inner, columns) // LEAF).bit_length() - 1)
    unit = 1 << levels
    padded = [np.pad(x, [(0, -s % unit) for s in x.shape]) for x in (a, b)]
    if wide:  # Python integers take the same way
        padded = [x.astype(object) for x in padded]
    out = _strassen(*padded, levels)[:rows, :columns]
    return np.clip(out, int(LONG.min), int(LONG.max)).astype(np.int64) if wide else out


def _first(scores: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k of the positions ``at`` that come first: higher scores, then
    smaller ids."""
    if len(at) > k:
        chosen = scores[at]
        least = np.partition(chosen, len(at) - k)[len(at) - k]
        at = at[chosen >= least]
    return at[np.lexsort((ids[at], -scores[at].astype(object) if (scores[at] == LONG.min).any() else -scores[at]))][:k]


def window(score: int, low: int, whole: int) -> tuple[int, int]:
    """Scores s with low * score <= whole * s <= whole * score."""
    return -((-low * score) // whole), score


def _pairs(anchors: DataFrame, rows: DataFrame, width: int, blocks: int, slices: int, choose: Callable) -> DataFrame:
    """What ``choose`` finds for the anchors of every block among the rows
    of every slice: (anchor, its place ``at``, positions)."""

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {c: [] for c in ("anchor_row", "anchor_id", "at", "vec_id", "row", "score")}
        if len(left) and len(right):
            table = np.ascontiguousarray(matrix(list(right["vector"]), width).T)
            ids, own = right["vec_id"].to_numpy(), right["row"].to_numpy()
            codes, names = pd.factorize(pd.concat([right["label"], left["label"]]))
            labels, asked = codes[:len(right)], codes[len(right):]
            for start in range(0, len(left), TILE_ROWS):
                tile = left.iloc[start:start + TILE_ROWS]
                scores = product(matrix(list(tile["vector"]), width), table)
                for i, a in enumerate(tile.itertuples(index=False)):
                    same = labels == asked[start + i]
                    for at, places in choose(a, scores[i], same, own, ids):
                        for p in places:
                            for c, v in zip(out, (a.row, a.vec_id, at, ids[p], own[p], scores[i, p])):
                                out[c].append(int(v))
        return pd.DataFrame(out)

    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    every_slice = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")
    # Both sides come from one table: aliases keep their columns apart.
    left = anchors.select(*[F.col(c).alias(c) for c in anchors.columns], F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), every_slice)
    right = rows.select("*", F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int").alias("slice"), every_block)
    return left.groupBy("block", "slice").cogroup(right.groupBy("block", "slice")).applyInPandas(solve, FOUND)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The lists of all slices: for each anchor and place its k best."""
    order = Window.partitionBy("anchor_row", "at").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, whole: int = 100,
         id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: for each anchor (a condition on the column ``vec_id``)
    and each of its ``positives`` best other rows of its label, the
    ``negatives`` best rows of other labels whose score is between ``low``
    of ``whole`` parts of the positive's score and that score."""
    spark = vectors.sparkSession
    taking_part = whole_vectors(vectors, id_col, vector_col, label_col, scale).where("vec_id is not null and label is not null")
    # Written with the numbers, so that a row keeps its number.
    rows = saved(taking_part.withColumn("row", F.monotonically_increasing_id()), "mining-rows")
    anchors = rows.where(is_anchor)
    size = rows.agg(F.count("*").alias("rows"), F.count_if(is_anchor).alias("anchors"),
                    F.coalesce(F.max(F.octet_length("vector")), F.lit(0)).alias("bytes")).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not size["anchors"]:
        return spark.createDataFrame([], schema)
    width, blocks, slices = size["bytes"] // 8, -(-size["anchors"] // BLOCK_ROWS), -(-size["rows"] // SLICE_ROWS)

    def positive(a, scores, same, own, ids):
        yield 0, _first(scores, ids, np.flatnonzero(same & (own != a.row)), positives)

    def negative(a, scores, same, own, ids):
        for w in a.windows:
            least, most = window(int(w["score"]), low, whole)
            at = np.flatnonzero(~same & (scores >= max(least, int(LONG.min))) & (scores <= most)) if least <= most else []
            if len(at):
                yield w["at"], _first(scores, ids, at, negatives)

    best = _merged(_pairs(anchors, rows, width, blocks, slices, positive), positives)
    best = saved(best.select("anchor_row", F.col("rank").alias("at"), F.col("vec_id").alias("positive_id"),
                             F.col("score").alias("positive_score")), "mining-positives")
    windows = best.groupBy("anchor_row").agg(F.collect_list(F.struct("at", F.col("positive_score").alias("score"))).alias("windows"))
    asking = anchors.join(windows.withColumnRenamed("anchor_row", "row"), "row")
    found = _merged(_pairs(asking, rows, width, blocks, slices, negative), negatives)
    return found.join(best, ["anchor_row", "at"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
