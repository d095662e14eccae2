"""Histogram sort into shards of near-equal bytes (operator 3).

Rows are ordered by a pair of longs. The driver holds candidate key
boundaries (probes); every round, each partition counts the exact bytes
and rows between neighbouring probes, the counts are summed, and the
interval around each wanted splitter shrinks to the two probes next to
it, until a probe meets the tolerance or no key is left between them.
Then the rows move once, straight to their place.

The key is (hash of the text, id), so rows of equal text are neighbours.
Probes fall between texts as long as that can meet the tolerance; only a
group of copies too large for it is cut, between ids.

Results in special cases: a null text has no bytes (size 1); null ids
sort before all others; rows with equal id and equal text always share a
shard; an empty table gives an empty table; input columns with the name
of an output column are replaced, all other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import saved, text_or_empty

LOW = -(1 << 63)
#: Most ranges that rows are dealt to; beyond it ranges grow with the data.
MAX_RANGES = 1 << 14
#: Most probes of one round, over all splitters.
MAX_PROBES = 1 << 17
_SPAN = 1 << 64  # values of one long


def _pack(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Pairs of longs as 16-byte strings in the same order."""
    both = np.empty((len(first), 2), dtype=">u8")
    for i, x in enumerate((first, second)):
        both[:, i] = x.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return both.view("S16").ravel()


def _pack_probes(probes: list[int]) -> np.ndarray:
    return np.array([p.to_bytes(16, "big") for p in probes], dtype="S16")


@dataclass
class Splitter:
    """A key boundary: all keys below ``key`` come before it."""

    key: int
    rows: int  # exact number of rows below
    size: int  # exact sum of sizes below


def _histogram(keys: DataFrame, probes: list[int]) -> list[tuple[int, int]]:
    """Exact (rows, size) below each probe."""
    edges = [p.to_bytes(16, "big") for p in probes]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorted_edges = np.array(edges, dtype="S16")
        rows = np.zeros(len(edges) + 1, dtype=np.int64)
        size = np.zeros(len(edges) + 1, dtype=np.int64)
        for b in batches:
            at = np.searchsorted(sorted_edges, _pack(b["a"].to_numpy(), b["b"].to_numpy()), side="right")
            rows += np.bincount(at, minlength=len(rows))
            np.add.at(size, at, b["size"].to_numpy())
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(rows[used]), pa.array(size[used])],
            names=["bin", "rows", "size"])

    found = (keys.mapInArrow(count, "bin int, rows long, size long")
             .groupBy("bin").agg(F.sum("rows").alias("rows"), F.sum("size").alias("size")).collect())
    rows, size = [0] * (len(probes) + 1), [0] * (len(probes) + 1)
    for r in found:
        rows[r["bin"]], size[r["bin"]] = r["rows"], r["size"]
    below, r_sum, s_sum = [], 0, 0
    for i in range(len(probes)):  # bin i holds the keys below probe i
        r_sum, s_sum = r_sum + rows[i], s_sum + size[i]
        below.append((r_sum, s_sum))
    return below


def _probes(low: int, high: int, count: int) -> list[int]:
    """Keys strictly between two keys; between first parts where possible."""
    unit = _SPAN if (high - 1) // _SPAN > low // _SPAN else 1
    first, last = low // unit + 1, (high - 1) // unit
    between = last - first + 1
    if between <= count:
        return [k * unit for k in range(first, last + 1)]
    return [(first + between * (i + 1) // (count + 1)) * unit for i in range(count)]


def ranges_of(total: int, range_bytes: int, multiple: int = 1) -> int:
    """Number of ranges of about ``range_bytes``, a multiple of ``multiple``."""
    most = max(1, MAX_RANGES // multiple)
    return multiple * min(most, max(1, -(-total // (multiple * range_bytes))))


def find_splitters(keys: DataFrame, parts: int, tolerance: float, probes: int = 64) -> list[Splitter]:
    """``parts - 1`` splitters of ``keys`` (longs a, b and size), each with
    a size below it that is off its share by at most ``tolerance`` of a
    part, or the nearest possible boundary."""
    total = keys.agg(F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    ends = Splitter(0, 0, 0), Splitter(_SPAN * _SPAN, total["rows"], total["size"])
    wanted = [total["size"] * i / parts for i in range(1, parts)]
    slack = tolerance * total["size"] / parts
    around = [ends for _ in wanted]
    done: dict[int, Splitter] = {}

    def settle(i: int) -> None:
        low, high = around[i]
        best = min(low, high, key=lambda s: abs(s.size - wanted[i]))
        if abs(best.size - wanted[i]) <= slack or high.rows - low.rows <= 1 or high.key - low.key <= 1:
            done[i] = best

    for i in range(len(wanted)):
        settle(i)
    while len(done) < len(wanted):
        count = max(2, min(probes, MAX_PROBES // (len(wanted) - len(done))))
        asked = {p for i in range(len(wanted)) if i not in done
                 for p in _probes(around[i][0].key, around[i][1].key, count)}
        ordered = sorted(asked)
        known = [Splitter(p, *x) for p, x in zip(ordered, _histogram(keys, ordered))]
        sizes = [s.size for s in known]
        for i in range(len(wanted)):
            if i in done:
                continue
            low, high = around[i]
            at = int(np.searchsorted(sizes, wanted[i], side="right"))
            if at and known[at - 1].key > low.key:
                low = known[at - 1]
            if at < len(known) and known[at].key < high.key:
                high = known[at]
            around[i] = low, high
            settle(i)
    return [done[i] for i in range(len(wanted))]


def range_of(a: Column, b: Column, splitters: list[Splitter]) -> Column:
    """Number of the range between splitters that a key belongs to."""
    edges = [min(s.key, _SPAN * _SPAN - 1).to_bytes(16, "big") for s in splitters]
    beyond = [s.key == _SPAN * _SPAN for s in splitters]

    @F.arrow_udf("int")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        sorted_edges = np.array([e for e, out in zip(edges, beyond) if not out], dtype="S16")
        for x, y in batches:
            keys = _pack(x.to_numpy(zero_copy_only=False), y.to_numpy(zero_copy_only=False))
            yield pa.array(np.searchsorted(sorted_edges, keys, side="right"), pa.int32())

    return run(a, b)


def text_size(text_col: str) -> Column:
    """UTF-8 bytes of a text (null: none) plus 1."""
    return F.octet_length(text_or_empty(text_col)).cast("long") + 1


def key_part(col: str) -> Column:
    return F.coalesce(F.col(f"`{col}`").cast("long"), F.lit(LOW))


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                   tolerance: float = 0.002, range_bytes: int = 32 << 20) -> DataFrame:
    """All rows and columns of ``docs`` with ``size``, ``shard`` and ``slot``
    (gapless from 0 in each shard). Shards have near-equal sums of sizes:
    each boundary is off by at most ``tolerance`` of a shard or is the
    nearest one possible. A shard is sorted in ranges of about
    ``range_bytes``, one per task."""
    a, b = F.xxhash64(text_or_empty(text_col)), key_part(id_col)
    keys = saved(docs.select(a.alias("a"), b.alias("b"), text_size(text_col).alias("size")), "shard-keys")
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()["size"]
    parts = ranges_of(total, range_bytes, shards)
    per_shard = parts // shards
    splitters = find_splitters(keys, parts, tolerance)
    below = [0, *(s.rows for s in splitters)]
    # Rows of the shard before each range.
    before = [below[i] - below[i - i % per_shard] for i in range(parts)]
    a_name, b_name, part = "__shard_a", "__shard_b", "__shard_part"
    placed = docs.drop("size", "shard", "slot").withColumns({a_name: a, b_name: b})
    placed = placed.withColumn(part, range_of(F.col(a_name), F.col(b_name), splitters))
    placed = placed.repartitionById(parts, F.col(part)).sortWithinPartitions(a_name, b_name)
    # A partition is one range, so the low 33 bits count its rows from 0.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    offset = F.element_at(F.lit(before).cast("array<long>"), F.col(part) + 1)
    return (placed.withColumns({"size": text_size(text_col),
                                "shard": F.floor(F.col(part) / per_shard).cast("int"),
                                "slot": row + offset})
            .drop(a_name, b_name, part))
