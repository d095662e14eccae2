"""Which sets can reach a bound on the Jaccard similarity: sets that share
one of their rarest shingles.

Two sets of similarity num / den or more share at least ceil(num * n / den)
of the n shingles of either. So, if all sets order their shingles alike,
the first n - ceil(num * n / den) + 1 of one and of the other have one in
common. The order here is by the number of sets that hold a shingle, rare
ones first: what a set holds alone comes first and meets nobody, and a
passage that many documents repeat comes last. A set with enough shingles
of its own has no candidates at all.

To count, shingles are cut to 32 bits and more, dealt over groups of equal
ranges of hashes and sent packed, with 32 bits of the set's name: a group
counts its shingles and returns those that several sets hold. Shingles or
names that agree in these bits only add candidates, as sets of one name
all meet. Shingles of a large
share of the sets would fill one group; they are found beforehand by their
number within batches of documents, count as the most frequent ones and
are not sent. Exact copies count once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


GROUP_ENTRIES = 4_000_000  # shingles of a group, on average
GROUP_BITS = 8  # at least so many bits of a hash name the group
NAME_BITS = 32  # bits of a set's name
IN_BATCH = 4  # a shingle of so many sets of a batch may be frequent
FREQUENT_LEAST, FREQUENT_SHARE = 1000, 1000  # and is, with so many sets or one of so many
FREQUENT = (1 << 31) - 1  # its count
HELD_FREQUENT, ALIKE = -1, -2  # instead of a shingle: how many frequent, how many of equal bits a set holds
SPREAD = 4096  # groups that pass on what is not counted


def frequent_in(sets: list[np.ndarray]) -> tuple[bytes, bytes] | None:
    """Packed shingles, and their counts, of many of the distinct ``sets``."""
    if len(sets) < IN_BATCH:
        return None
    found, counts = np.unique(np.concatenate(sets), return_counts=True)
    many = counts >= IN_BATCH
    return (found[many].tobytes(), counts[many].astype(np.uint32).tobytes()) if many.any() else None


def frequent_of(rows: DataFrame, total: int) -> np.ndarray:
    """Shingles of many of the ``total`` rows, from the batches' columns
    ``often`` and ``often_counts``: at most FREQUENT_SHARE for each shingle
    of an average row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys, counts in zip(b["often"].to_pylist(), b["often_counts"].to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, np.int64)), pa.array(
                    np.frombuffer(counts, np.uint32).astype(np.int64))], names=["key", "sets"])

    found = rows.where("often is not null").select("often", "often_counts").mapInArrow(run, "key long, sets long")
    found = found.groupBy("key").agg(F.sum("sets").alias("sets")).where(F.col("sets") >= max(FREQUENT_LEAST, total // FREQUENT_SHARE))
    return np.array([r["key"] for r in found.select("key").collect()], np.int64).astype(np.uint64)


def set_name(set_key: bytes, bits: int) -> int:
    return int.from_bytes(set_key[:4], "little") & ((1 << bits) - 1)


def _pack(sets: dict[bytes, np.ndarray], shift: int, frequent: np.ndarray, prefix: Callable[[int], int],
          name_bits: int, salt: int) -> list[tuple]:
    """(group, keys, names, counts) of the distinct sets of a batch. Groups
    below 0 hold what needs no counting."""
    out, light, names, told = [], [], [], []
    for set_key, found in sets.items():
        name = set_name(set_key, name_bits)
        keys = np.unique(found >> np.uint64(shift))
        if len(keys) < len(found):
            told.append((ALIKE, name, len(found) - len(keys)))
        often = np.isin(keys, frequent, assume_unique=True) if len(frequent) else np.zeros(len(keys), bool)
        if often.any():
            told.append((HELD_FREQUENT, name, int(often.sum())))
            told += [(int(k), name, FREQUENT) for k in keys[often][:prefix(len(found))]]
            keys = keys[~often]
        light.append(keys)
        names.append(np.full(len(keys), name, np.uint32))
    if light:
        keys, names = np.concatenate(light), np.concatenate(names)
        order = np.argsort(keys, kind="stable")
        keys, names = keys[order], names[order]
        group = (keys >> np.uint64(32)).astype(np.int64)
        edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]) if len(keys) else []
        low = keys.astype(np.uint32)
        out = [(int(group[s]), low[s:e].tobytes(), names[s:e].tobytes(), None) for s, e in zip(edges[:-1], edges[1:])]
    if told:
        a, b, c = zip(*told)
        out.append((-1 - salt % SPREAD, np.array(a, np.int64).tobytes(), np.array(b, np.uint32).tobytes(), np.array(c, np.int64).tobytes()))
    return out


def _repeated(group: int, keys: list[bytes], names: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, shingles and counts of what several sets of a group hold."""
    key = np.frombuffer(b"".join(keys), np.uint32).astype(np.uint64)
    both = np.unique(key << np.uint64(32) | np.frombuffer(b"".join(names), np.uint32))
    key = both >> np.uint64(32)
    edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    counts = np.repeat(np.diff(edges), np.diff(edges))
    many = counts > 1
    return (both[many] & np.uint64(0xFFFFFFFF)).astype(np.int64), key[many].astype(np.int64) + (group << 32), counts[many]


def rare_keys(texts: DataFrame, classes: DataFrame, rows: DataFrame, num: int, den: int,
              set_of: Callable[[bytes], np.ndarray], key_of: Callable[[np.ndarray], bytes]) -> DataFrame:
    """(rid, key): of each class (rid, set_key, n) the shingles by which it
    must meet every class that it links to and that another class holds.
    ``texts`` (text) are read again, ``rows`` are theirs with n_shingles and
    the batches' columns of :func:`frequent_in`."""
    total = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("shingles")).first()
    bits = max(GROUP_BITS, (total["shingles"] // GROUP_ENTRIES).bit_length())
    shift, name_bits = 64 - 32 - bits, NAME_BITS
    frequent = np.unique(frequent_of(rows, total["rows"]) >> np.uint64(shift))

    def prefix(n: int) -> int:
        return n - -(-num * n // den) + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, b in enumerate(batches):
            sets = {}
            for raw in b["text"].cast(pa.binary()).to_pylist():
                found = set_of(raw)
                if len(found):
                    sets[key_of(found)] = found
            packed = _pack(sets, shift, frequent, prefix, name_bits, at)
            columns = list(zip(*packed)) or [()] * 4
            types = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["group", "keys", "names", "counts"])

    def batch(names: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (names, keys, counts)], names=["name", "key", "sets"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, names = None, [], []
        for b in batches:
            for group, k, n, c in zip(*(b[x].to_pylist() for x in ("group", "keys", "names", "counts"))):
                if group < 0:
                    yield batch(np.frombuffer(n, np.uint32).astype(np.int64), np.frombuffer(k, np.int64), np.frombuffer(c, np.int64))
                    continue
                if group != now:
                    if keys:
                        yield batch(*_repeated(now, keys, names))
                    now, keys, names = group, [], []
                keys.append(k)
                names.append(n)
        if keys:
            yield batch(*_repeated(now, keys, names))

    packed = texts.select("text").mapInArrow(pack, "group long, keys binary, names binary, counts binary")
    counted = packed.repartition("group").sortWithinPartitions("group").mapInArrow(count, "name long, key long, sets long")
    # A set's shingles at most; what copies of a set tell alike is one before it moves.
    lists = counted.groupBy("name").agg(F.collect_set(F.struct("sets", "key")).alias("found"))
    named = classes.select("rid", "n", _name(F.col("set_key"), name_bits).alias("name"))
    named = named.groupBy("name").agg(F.collect_list(F.struct("rid", "n")).alias("classes"))
    told = lambda what: F.aggregate(F.filter("found", lambda x: x["key"] == what), F.lit(0).cast("long"), lambda a, x: a + x["sets"])
    met = lists.join(named, "name").select(
        F.explode("classes").alias("c"), (F.size("classes") > 1).alias("several"), told(HELD_FREQUENT).alias("frequent"), told(ALIKE).alias("alike"),
        F.array_sort(F.filter("found", lambda x: x["key"] >= 0)).alias("shared"))
    light = F.size(F.filter("shared", lambda x: x["sets"] < FREQUENT))
    own = F.col("c.n") - F.col("alike") - F.col("frequent") - light  # shingles that no other set holds
    first = F.expr(f"c.n - (({num} * c.n + {den - 1}) div {den}) + 1")
    wanted = F.when(F.col("several"), F.size("shared")).otherwise(F.least(first - own, F.size("shared"))).cast("int")
    chosen = met.select("c.rid", "shared", wanted.alias("wanted")).where("wanted > 0")
    keys = chosen.select("rid", F.explode(F.slice("shared", 1, F.col("wanted"))).alias("x")).select("rid", F.col("x.key").alias("key"))
    # Classes of one name were counted as one: they meet by the name.
    alike = named.where(F.size("classes") > 1).select(F.explode("classes.rid").alias("rid"), (-1 - F.col("name")).alias("key"))
    return keys.unionByName(alike)


def _name(set_key: Column, bits: int) -> Column:
    """As :func:`set_name`: the first four bytes, the lowest first."""
    hexed = F.hex(F.substring(set_key, 1, 4))
    pairs = [F.substring(hexed, i, 2) for i in (7, 5, 3, 1)]
    return F.conv(F.concat(*pairs), 16, 10).cast("long").bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
