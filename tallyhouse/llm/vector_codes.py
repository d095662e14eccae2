"""Vector code compression by searches in split trees (operator 11).

Vectors become whole numbers and are cut into equal parts; every part
position has a codebook, and a vector is kept as the index of the nearest
entry in each part. Codebooks start from the vectors of the smallest ids
and are refined in rounds: every part goes to its nearest entry, then each
entry becomes the floored mean of its parts. Tasks add up counts and sums,
so a round moves a few numbers per task whatever the number of rows.

The nearest entry is found in a geometric near-neighbour access tree over
the entries: a node holds split points, every other entry belongs to its
nearest split point, and for each split point and each such group the node
keeps the range of their distances. A query measures its distances to the
split points; a group is left out when some range cannot hold an entry as
near as the best one so far. Distances are squared whole numbers, compared
exactly, with ties to the lower index; only the test that leaves out uses
roots, rounded so that a group with an equally near entry stays.

Results in special cases: rows whose vector is null or holds a null, NaN
or infinite component are dropped; rows without id are kept and come last
among the first entries; rows of a repeated id count one by one (ordered
by vector among the first entries); with fewer rows than entries the
codebooks are as short; vectors of unlike or no length are taken as if the
shorter ended in zeros, up to the next multiple of the number of parts;
components beyond 2^62 and errors beyond the range of a long are held at
its ends; an empty table gives an empty result; other columns are not
used, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import saved, small
from tallyhouse.llm.whole_vectors import matrix, whole_vectors

FAN = 4  # split points of a node
SLACK = 2.0 ** -48  # more than the rounding of a root, a sum and their comparison
LONG_MAX = (1 << 63) - 1
#: A label of more than this share of the rows is joined by broadcast.
HOT_SHARE = 1000


def squared(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` from ``entry``."""
    away = x - entry
    return (away * away).sum(axis=1)


def exactly(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as 64-bit integers if no squared distance between their
    rows can leave these, else as Python integers."""
    most = max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)
    width = max(a.shape[1] for a in arrays)
    fits = 4 * most * most * max(width, 1) <= LONG_MAX
    return [a.astype(np.int64 if fits else object) for a in arrays]


class SplitTree:
    """Nearest entries of a codebook (one entry a row, at least one)."""

    def __init__(self, entries: np.ndarray, fan: int = FAN):
        self.entries, self.fan, self.measured = entries, fan, 0
        self.root = self._node(list(range(len(entries))))

    def _node(self, members: list[int]) -> tuple:
        """(split points, ranges, nodes of the groups)."""
        e = exactly(self.entries)[0]
        splits, nearest = members[:1], squared(e[members], e[members[0]])
        while len(splits) < min(self.fan, len(members)):
            # The member farthest from all split points so far; repeated
            # entries are taken in order.
            nearest[[members.index(s) for s in splits]] = -1
            splits.append(members[int(np.argmax(nearest))])
            nearest = np.minimum(nearest, squared(e[members], e[splits[-1]]))
        groups: list[list[int]] = [[] for _ in splits]
        for m in members:
            if m not in splits:
                groups[int(np.argmin([squared(e[[m]], e[s])[0] for s in splits]))].append(m)
        low, high = np.zeros((len(splits), len(splits))), np.zeros((len(splits), len(splits)))
        for j, g in enumerate(groups):
            for i, s in enumerate(splits):
                if g:
                    away = np.sqrt(squared(e[g], e[s]).astype(np.float64))
                    low[i, j], high[i, j] = away.min() * (1 - SLACK), away.max() * (1 + SLACK)
        return splits, low, high, [self._node(g) if g else None for g in groups]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of and squared distance from the nearest entry of each row;
        of equally near entries the one of the lowest index."""
        x, entries = exactly(x, self.entries)
        index = np.full(len(x), len(entries))
        best = np.full(len(x), 0, x.dtype)
        self._search(self.root, x, entries, np.arange(len(x)), index, best)
        return index, best

    def _search(self, node: tuple, x: np.ndarray, entries: np.ndarray, rows: np.ndarray,
                index: np.ndarray, best: np.ndarray) -> None:
        splits, low, high, groups = node
        away = np.empty((len(rows), len(splits)))
        for i, s in enumerate(splits):
            d = squared(x[rows], entries[s])
            self.measured += len(rows)
            away[:, i] = np.sqrt(d.astype(np.float64))
            won = (index[rows] == len(entries)) | (d < best[rows]) | ((d == best[rows]) & (s < index[rows]))
            index[rows[won]], best[rows[won]] = s, d[won]
        own = away.argmin(axis=1)
        for first in (True, False):  # the group of the nearest split point, then the others
            for j, group in enumerate(groups):
                if group is None:
                    continue
                at = np.flatnonzero((own == j) == first)
                reach = np.sqrt(best[rows[at]].astype(np.float64))[:, None]
                # An entry e of the group has |d(x, s) - d(s, e)| <= d(x, e).
                beyond = ((away[at] * (1 - SLACK) > (high[:, j] + reach) * (1 + SLACK))
                          | (low[:, j] * (1 - SLACK) > (away[at] + reach) * (1 + SLACK))).any(axis=1)
                at = at[~beyond]
                if len(at):
                    self._search(group, x, entries, rows[at], index, best)


def assign(x: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, list]:
    """Codes of each row of ``x`` (a column a part) and squared distances."""
    step = x.shape[1] // len(books)
    found = [SplitTree(book).nearest(x[:, p * step:(p + 1) * step]) for p, book in enumerate(books)]
    return np.stack([f[0] for f in found], axis=1), [f[1] for f in found]


def refined(rows: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The codebooks after one round over all rows."""
    step = width // len(books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        totals = [np.zeros(b.shape, object) for b in books]
        for b in batches:
            x = matrix(b["vector"].to_pylist(), width)
            codes, _ = assign(x, books)
            if np.abs(x.astype(np.float64)).max(initial=0) * len(x) >= LONG_MAX:
                x = x.astype(object)
            for p in range(len(books)):
                for e in np.unique(codes[:, p]):
                    mine = x[codes[:, p] == e, p * step:(p + 1) * step]
                    counts[p][e] += len(mine)
                    totals[p][e] += mine.sum(axis=0)
        out = [(p, int(e), i, int(counts[p][e]), Decimal(int(totals[p][e, i])))
               for p in range(len(books)) for e in np.flatnonzero(counts[p]) for i in range(step)]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
        names = ["part", "entry", "place", "rows", "total"]
        columns = list(zip(*out)) or [()] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    schema = "part int, entry int, place int, rows long, total decimal(38,0)"
    added = rows.select("vector").mapInArrow(sums, schema).groupBy("part", "entry", "place").agg(
        F.sum("rows").alias("rows"), F.sum("total").alias("total"))
    books = [b.copy() for b in books]
    for r in added.collect():  # one row for each number of the codebooks
        books[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["rows"]
    return books


def fit(rows: DataFrame, parts: int, entries: int, rounds: int, width: int) -> list[np.ndarray]:
    """Codebooks of the packed vectors ``rows``, one a part."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    seeds = matrix([bytes(r["vector"]) for r in first], width)
    step = width // parts
    books = [seeds[:, p * step:(p + 1) * step] for p in range(parts)]
    for _ in range(rounds):
        books = refined(rows, books, width)
    return books


def _sums_of_labels(coded: DataFrame) -> DataFrame:
    """``coded`` with the error summed over equal labels, nulls together."""
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = saved(coded.groupBy(F.col("label").alias("of")).agg(
        F.least(total, F.lit(LONG_MAX)).cast("long").alias("label_error"), F.count("*").alias("rows")), "label-errors")
    same = F.col("label").eqNullSafe(F.col("of"))
    if small(sums) is not sums:
        return coded.join(F.broadcast(sums), same)
    # Many labels: those of many rows, at most HOT_SHARE of them, are
    # broadcast, so that the others are moved in small groups.
    all_rows = coded.count()
    hot = F.col("rows") * HOT_SHARE > all_rows
    met = coded.join(F.broadcast(sums.where(hot)), same, "left")
    rest = met.where("label_error is null").select(*coded.columns)
    return met.where("label_error is not null").unionByName(rest.join(sums.where(~hot), same))


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label", scale: int = 4096) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error and
    codebooks_sha256 of every row whose vector takes part."""
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits has 1 to 256 entries")
    spark = vectors.sparkSession
    rows = saved(whole_vectors(vectors, id_col, vector_col, label_col, scale), "whole-vectors")
    longest = rows.agg(F.max(F.octet_length("vector"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    width = -(-max(longest // 8, 1) // parts) * parts
    books = fit(rows, parts, entries, rounds, width)
    numbers = ",".join(str(int(v)) for book in books for entry in book for v in entry)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, away = assign(matrix(b["vector"].to_pylist(), width), books)
            texts = [bytes(c).hex() for c in codes.astype(np.uint8)]
            error = [min(int(e), LONG_MAX) for e in sum(a.astype(object) for a in away)]
            yield pa.RecordBatch.from_arrays([b["vec_id"], b["label"], pa.array(texts, pa.string()), pa.array(error, pa.int64())],
                                             names=["vec_id", "label", "code", "error"])

    coded = saved(rows.mapInArrow(code, "vec_id long, label string, code string, error long"), "vector-codes")
    return _sums_of_labels(coded).select("vec_id", "code", "error", "label_error", F.lit(
        hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"))
