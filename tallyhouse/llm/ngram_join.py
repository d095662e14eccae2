"""N-gram Jaccard join by a blocked sparse matrix product (operator 9).

Rows of the matrix are documents, columns are word shingles (of 3 words
unless ``width`` says otherwise). Documents
link when the Jaccard similarity of their shingle sets reaches a bound.

1. Equal sets are one class; only classes are compared.
2. Which rows can meet: two sets that reach the bound share one of the
   rarest shingles of either, as many as the bound lets a set differ in and
   one more (:mod:`rare_shingles`). Classes that share such a shingle are
   candidates of each other, and candidates that hang together form a
   cluster. Rows that only share what many documents hold do not meet.
3. In a cluster every class is first compared with the class that shares
   most; classes that link to it need no comparison among each other.
4. The other rows of the cluster are cut into row blocks of bounded size.
   Each pair of row blocks is one task's matrix product: overlap counts
   are accumulated over blocks of columns, and pairs drop out as soon as
   what is left of a row cannot lift them over the bound that the sizes
   set. Of the links a spanning forest is kept: as many as there are rows,
   not pairs.
5. Links become components.

Words are what white space (space, tab to carriage return) separates,
with A-Z in lower case; texts of fewer words than a shingle have their
whole sequence as the only shingle. Shingles are compared by 64-bit hashes.

Results in special cases: null and empty texts and texts of white space
have no shingles and link with nothing, their component is their own id;
repeated rows are equal sets; a component of rows without id has none; an
empty table gives an empty table; other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import saved, small, text_or_empty
from tallyhouse.llm.components import components
from tallyhouse.llm.rare_shingles import frequent_in, rare_keys

SHINGLE = 3
BLOCK_ROWS = 128  # rows of a row block
BLOCK_ENTRIES = 1_000_000  # shingles of a row block
BLOCK_COLUMNS = 4096

# Odd 64-bit constants of the hash mixing.
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingles(raw: bytes, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a UTF-8 text."""
    words = raw.lower().split()  # bytes: A-Z alone, ASCII white space alone
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(width, len(h))
    total = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total = _mixed(total * _MIX[0] + h[i:len(h) - width + 1 + i])
    return np.unique(total)


def _sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """doc_id, n_shingles and set_key of each row; one row of each batch
    also holds the shingles that are frequent in the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(raw, width) for raw in b["text"].cast(pa.binary()).to_pylist()]
            names = [set_key(x) for x in found]
            often = frequent_in(list({k: x for k, x in zip(names, found) if k is not None}.values())) or (None, None)
            told = [pa.array([x, *[None] * (len(found) - 1)][:len(found)], pa.binary()) for x in often]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array([len(x) for x in found], pa.int64()), pa.array(names, pa.binary()), *told],
                names=["doc_id", "n_shingles", "set_key", "often", "often_counts"])

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, often binary, often_counts binary")


def set_key(found: np.ndarray) -> bytes | None:
    """128-bit name of a shingle set; none for the empty set."""
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def set_key_of(text: Column, width: int = SHINGLE) -> Column:
    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array([set_key(shingles(raw, width)) for raw in b.cast(pa.binary()).to_pylist()], pa.binary())

    return run(text)


def _candidates(rows: DataFrame) -> DataFrame:
    """(leader, rid): each class with the most connected class of each of
    the shingles (rid, key) that it shares with another one."""
    shared = saved(rows.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "shared-shingles")
    members = saved(rows.join(small(shared), "key"), "shingle-members")
    weight = members.groupBy("rid").agg(F.sum("members").alias("weight"))
    ranked = members.select("rid", "key").join(weight, "rid")
    leader = ranked.groupBy("key").agg(F.max(F.struct("weight", (-F.col("rid")).alias("minus"))).alias("best"))
    pairs = members.select("rid", "key").join(leader.select("key", (-F.col("best.minus")).alias("leader"), "best.weight"), "key")
    return saved(pairs.select("leader", "rid", "weight").distinct(), "candidates")


def _links_of(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return den * both >= num * (len(a) + len(b) - both)


def _star_links(members: DataFrame, num: int, den: int) -> DataFrame:
    """Whether each member of a cluster links to the cluster's leader."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            links = [_links_of(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), num, den)
                     for x, y in zip(b["found"].to_pylist(), b["leader_found"].to_pylist())]
            yield pa.RecordBatch.from_arrays([b["rid"], pa.array(links, pa.bool_())], names=["rid", "linked"])

    return members.select("rid", "found", "leader_found").mapInArrow(run, "rid long, linked boolean")


def _row_blocks(members: DataFrame) -> DataFrame:
    """Adds ``block``: neighbours in (cluster, linked, size) order in groups
    of bounded size, none of which spans two clusters."""
    ordered = members.repartitionByRange("cluster", "linked", "n", "rid").sortWithinPartitions("cluster", "linked", "n", "rid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows, entries, block = None, 0, 0, -1
        for b in batches:
            out = []
            for cluster, n, first in zip(b["cluster"].to_pylist(), b["n"].to_pylist(), b["base"].to_pylist()):
                if cluster != last or rows >= BLOCK_ROWS or entries + n > BLOCK_ENTRIES:
                    last, rows, entries, block = cluster, 0, 0, block + 1
                rows, entries = rows + 1, entries + n
                out.append((first >> 33 << 33) + block)
            columns = [*(b[c] for c in ("rid", "cluster", "linked", "n")), pa.array(out, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["rid", "cluster", "linked", "n", "block"])

    numbered = ordered.select("rid", "cluster", "linked", "n", F.monotonically_increasing_id().alias("base"))
    return numbered.mapInArrow(run, "rid long, cluster long, linked boolean, n long, block long")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], num: int, den: int,
              wanted: np.ndarray) -> np.ndarray:
    """Which pairs of rows link: the product of two incidence blocks,
    accumulated over column blocks; ``wanted`` pairs only."""
    rows = left + right
    columns, at = np.unique(np.concatenate(rows), return_inverse=True)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    sizes = np.array([len(r) for r in rows])
    n, m = len(left), len(right)
    total = sizes[:n, None] + sizes[None, n:]
    need = -(-total * num // (num + den))  # the least overlap that reaches the bound
    alive = wanted & (np.minimum(sizes[:n, None], sizes[None, n:]) >= need)
    overlap = np.zeros((n, m), dtype=np.float32)
    left_over = sizes.copy()
    for start in range(0, len(columns), BLOCK_COLUMNS):
        if not alive.any():
            break
        lo, hi = np.searchsorted(at, [start, start + BLOCK_COLUMNS])
        block = np.zeros((len(rows), min(BLOCK_COLUMNS, len(columns) - start)), dtype=np.float32)
        block[row[lo:hi], at[lo:hi] - start] = 1
        overlap += block[:n] @ block[n:].T
        left_over = left_over - np.bincount(row[lo:hi], minlength=len(rows))
        # what is left of the shorter row bounds what can still be added
        alive &= overlap + np.minimum(left_over[:n, None], left_over[None, n:]) >= need
    return alive & (overlap >= need)


def _forest(links: np.ndarray, first: list[int], second: list[int]) -> list[tuple[int, int]]:
    """Edges that keep together what the links hold together."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for i, j in zip(*np.nonzero(links)):
        a, b = root(first[i]), root(second[j])
        if a != b:
            parent[a] = b
            kept.append((first[i], second[j]))
    return kept


def _block_links(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Spanning links of every pair of row blocks. Rows: left, right, block,
    rid, linked, found."""

    def solve(rows: list[tuple]) -> list[tuple[int, int]]:
        left_block, right_block = rows[0][0], rows[0][1]
        sides = [[(rid, linked, np.frombuffer(found, np.uint64)) for _, _, block, rid, linked, found in rows if block == side]
                 for side in (left_block, right_block)]
        ids, linked = ([[r[k] for r in s] for s in sides] for k in (0, 1))
        wanted = ~(np.array(linked[0], bool)[:, None] & np.array(linked[1], bool)[None, :])
        if left_block == right_block:
            wanted &= np.triu(np.ones(wanted.shape, dtype=bool), 1)
        links = _overlaps([r[2] for r in sides[0]], [r[2] for r in sides[1]], num, den, wanted)
        return _forest(links, ids[0], ids[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        names = ("left", "right", "block", "rid", "linked", "found")

        def links(of: list[tuple]) -> pa.RecordBatch:
            found = solve(of)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for b in batches:
            for r in zip(*(b[c].to_pylist() for c in names)):
                if rows and rows[0][:2] != r[:2]:
                    yield links(rows)
                    rows = []
                rows.append(r)
        if rows:
            yield links(rows)

    return (pairs.repartition("left", "right").sortWithinPartitions("left", "right")
            .select("left", "right", "block", "rid", "linked", "found").mapInArrow(run, "a long, b long"))


def _found_of(docs: DataFrame, involved: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """rid, cluster, n and the shingles (``found``) of the involved classes,
    read again from the documents that name them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(raw, width) for raw in b["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(x) for x in found], pa.binary()), pa.array([x.tobytes() for x in found], pa.binary())],
                names=["set_key", "found"])

    name = "__wanted_id"
    ids = involved.select(F.col("min_id").alias(name)).distinct()
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    source = source.join(small(ids), F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")
    found = source.select("text").mapInArrow(run, "set_key binary, found binary")
    wanted = involved.select("rid", "cluster", "n", "set_key")
    found = saved(found.join(small(wanted), "set_key").drop("set_key"), "involved-sets")
    if found.count() != involved.count():  # rows that repeat an id and a set
        found = saved(found.dropDuplicates(["rid"]), "involved-sets")
    return found


def link_classes(docs: DataFrame, num: int = 9, den: int = 10, id_col: str = "doc_id",
                 text_col: str = "text", width: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Two tables: the rows (doc_id, n_shingles, set_key) and the classes
    (set_key, group_id, component_id). ``group_id`` names a component even
    where ids are missing."""
    if not 0 < num <= den:
        raise ValueError("the bound must be above 0 and at most 1")
    if width < 1:
        raise ValueError("a shingle has at least one word")
    rows = saved(_sets(docs, id_col, text_col, width), "shingle-sets")
    classes = (rows.where("set_key is not null").groupBy("set_key")
               .agg(F.min("doc_id").alias("min_id"), F.max("n_shingles").alias("n")))
    classes = saved(classes.withColumn("rid", F.monotonically_increasing_id()), "classes")
    slim = classes.select("rid", "set_key", "min_id", "n")

    texts = docs.select(text_or_empty(text_col).alias("text"))
    rare = rare_keys(texts, classes, rows, num, den, lambda raw: shingles(raw, width), set_key)
    candidates = _candidates(saved(rare, "rare-shingles"))
    cluster = saved(components(candidates, "leader", "rid").withColumnsRenamed({"node": "rid", "component": "cluster"}), "clusters")
    involved = saved(slim.join(cluster, "rid"), "involved")
    found = _found_of(docs, involved, id_col, text_col, width)
    # Clusters of more than one row block are first compared with their
    # leader, the most connected class.
    large = involved.groupBy("cluster").count().where(F.col("count") > BLOCK_ROWS).select("cluster")
    weights = candidates.groupBy(F.col("leader").alias("rid")).agg(F.max("weight").alias("weight"))
    leaders = (cluster.join(large, "cluster").join(weights, "rid").groupBy("cluster")
               .agg(F.max(F.struct("weight", (-F.col("rid")).alias("minus"))).alias("best"))
               .select("cluster", (-F.col("best.minus")).alias("leader")))
    leaders = saved(leaders, "cluster-leaders")
    leader_found = small(leaders.select(F.col("leader").alias("rid"))).join(found, "rid").select(
        "cluster", F.col("found").alias("leader_found"))
    star = _star_links(found.select("rid", "cluster", "found").join(saved(leader_found, "leader-sets"), "cluster"), num, den)
    star = saved(star.where("linked"), "star-links")
    members = involved.select("rid", "cluster", "n").join(small(star), "rid", "left")
    members = members.withColumn("linked", F.coalesce("linked", F.lit(False)))
    blocks = saved(_row_blocks(members), "row-blocks")
    stats = blocks.groupBy("cluster", "block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("linked").alias("all_linked"))
    other = stats.select("cluster", F.col("block").alias("right"), F.col("low").alias("low2"),
                         F.col("high").alias("high2"), F.col("all_linked").alias("all_linked2"))
    # Pairs of row blocks, not of rows; those whose sizes are too far apart
    # or whose rows all hang together already are left out.
    block_pairs = (stats.withColumnRenamed("block", "left").join(other, "cluster")
                   .where("left <= right and not (all_linked and all_linked2)")
                   .where(f"low * {num} <= high2 * {den} and low2 * {num} <= high * {den}"))
    sides = block_pairs.select("left", "right", F.explode(F.array_distinct(F.array("left", "right"))).alias("block"))
    # Which pairs a row goes to is small beside the sets, which move once.
    places = saved(blocks.select("rid", "linked", "block").join(sides, "block"), "row-places")
    links = _block_links(found.select("rid", "found").join(small(places), "rid"), num, den)
    star_pairs = star.join(cluster, "rid").join(leaders, "cluster").select(
        F.col("leader").alias("a"), F.col("rid").alias("b"))
    groups = components(links.unionAll(star_pairs), "a", "b").withColumnsRenamed({"node": "rid", "component": "group"})
    grouped = slim.join(groups, "rid", "left").withColumn("group_id", F.coalesce("group", "rid"))
    # Classes without links name themselves; the others take the smallest id of their group.
    names = (grouped.where("group is not null").groupBy("group_id").agg(F.min("min_id").alias("name")))
    named = grouped.join(names, "group_id", "left").select(
        "set_key", "group_id", F.when(F.col("group").isNull(), F.col("min_id")).otherwise(F.col("name")).alias("component_id"))
    return rows.drop("often", "often_counts"), saved(named, "components")


def ngram_components(docs: DataFrame, num: int = 9, den: int = 10, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, the
    smallest id that links reach."""
    rows, classes = link_classes(docs, num, den, id_col, text_col)
    found = rows.join(small(classes), "set_key").select("doc_id", "n_shingles", "component_id")
    # Rows without words, however many, take no part in the join.
    wordless = rows.where("set_key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(wordless)


def keep_one(docs: DataFrame, num: int = 9, den: int = 10, id_col: str = "doc_id", text_col: str = "text",
             width: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` without near duplicates, all columns kept: of
    each component the row with the smallest id stays (of rows that repeat
    this id, one of the smallest shingle set). Rows without words stay."""
    rows, classes = link_classes(docs, num, den, id_col, text_col, width)
    met = rows.join(small(classes), "set_key")
    own_id = F.col(f"`{id_col}`").cast("long")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if not rows.where("doc_id is null").limit(1).count() and not (
            rows.groupBy("doc_id").count().where("count > 1").limit(1).count()):
        # Every row has an id of its own: the ids that go are enough.
        gone = met.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone_id"))
        return docs.join(small(saved(gone, "gone-ids")), own_id == F.col("__gone_id"), "left_anti")
    claims = met.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keepers = claims.groupBy("group_id").agg(F.min(F.struct("set_key", F.col("doc_id").alias("id"))).alias("best"),
                                             F.count("*").alias("claims"))
    names = {"set_key": "__set_key", "id": "__kept_id", "group_id": "__group", "claims": "__claims"}
    keepers = saved(keepers.select(*[F.col(f"best.{c}" if c in ("set_key", "id") else c).alias(n) for c, n in names.items()]),
                    "keepers")
    keyed = docs.withColumn("__key", set_key_of(text_or_empty(text_col), width))
    found = keyed.join(small(keepers), (F.col("__key") == F.col("__set_key"))
                       & own_id.eqNullSafe(F.col("__kept_id")))
    single = found.where("__claims = 1").select(*columns).unionByName(keyed.where("__key is null").select(*columns))
    # Where several rows carry the id to be kept, one of each group.
    several = found.where("__claims > 1").dropDuplicates(["__group"]).select(*columns)
    return single.unionByName(several)
