"""Reference resolution: natural key -> parent's surrogate key.

Equivalent of ``UPDATE child SET id = p.id FROM parent p WHERE child.nk =
p.nk`` over all rows: a matched row takes the parent's id, an unmatched
row keeps what it had, batch stamps are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.joins import broadcast_if_measured_small, broadcast_limit
from tallyhouse.session import estimated_size_bytes, write_through


def resolve_ref(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                parent_id: str, as_col: str, only_rows: Column | None = None) -> DataFrame:
    """Left join on the natural key, ``coalesce(parent id, old id)``.

    Only (key, id) of the parent are read. Child rows whose key is NULL
    can never match; they are spread over the shuffle partitions (a hot NULL
    key would otherwise land in one) or bypass the join. A parent that fits the broadcast limit
    is broadcast (no shuffle of the child, immune to a hot child key);
    otherwise AQE splits skewed child partitions of the sort-merge join.

    ``only_rows`` restricts the join to the child rows it selects; the
    others pass through unchanged without a shuffle (see
    :func:`touched_or_unresolved`). A parent that cannot be broadcast is
    then cut to what those rows can meet, see :func:`reduced_parent`.
    """
    p = (parent.select(F.col(parent_key).alias("_ref_key"), F.col(parent_id).alias("_ref_id"))
         .where(F.col("_ref_key").isNotNull()))
    if only_rows is None:
        return _resolved_in_one_join(child, p, child_key, as_col)
    join_rows = F.col(child_key).isNotNull() & F.coalesce(only_rows, F.lit(False))
    asking = child.where(join_rows)
    size = estimated_size_bytes(p)
    if size is not None and size <= broadcast_limit(p):
        p = F.broadcast(p)
    else:
        asking = write_through(asking, "touched-rows")
        p = reduced_parent(asking, p, child_key)
    j = asking.join(p, F.col(child_key) == F.col("_ref_key"), "left")
    resolved = j.select(*[(F.coalesce(F.col("_ref_id"), F.col(c)) if c == as_col else F.col(c)).alias(c)
                          for c in child.columns])
    return resolved.unionByName(child.where(~join_rows))


def _resolved_in_one_join(child: DataFrame, p: DataFrame, child_key: str, as_col: str) -> DataFrame:
    """Every child row in one join, so that the child, which may be a whole
    upsert, is computed once. Not broadcast, the join takes a second key
    that differs among the rows whose key is NULL."""
    match = F.col(child_key) == F.col("_ref_key")
    size = estimated_size_bytes(p)
    if size is not None and size <= broadcast_limit(p):
        j = child.join(F.broadcast(p), match, "left")
    else:
        spread = F.when(F.col(child_key).isNull(), F.pmod(F.xxhash64(*child.columns), F.lit(4096)).cast("int")).otherwise(0)
        j = child.withColumn("_spread", spread).join(p.withColumn("_ref_spread", F.lit(0)),
                                                     match & (F.col("_spread") == F.col("_ref_spread")), "left")
    return j.select(*[(F.coalesce(F.col("_ref_id"), F.col(c)) if c == as_col else F.col(c)).alias(c)
                      for c in child.columns])


def reduced_parent(child: DataFrame, parent: DataFrame, child_key: str) -> DataFrame:
    """The rows of ``parent`` (``_ref_key``, ``_ref_id``) that ``child`` can
    meet. The child's distinct keys are measured; if they are small they are
    broadcast, so the parent is streamed through a semi join without an
    exchange, and what is left of it, again measured, is broadcast to the
    child. Otherwise the parent is returned as it is, for a sort-merge join."""
    keys = write_through(child.select(F.col(child_key).alias("_asked")).distinct(), "asked-keys")
    size = estimated_size_bytes(keys)
    if size is None or size > broadcast_limit(keys):
        return parent
    met = parent.join(F.broadcast(keys), F.col("_ref_key") == F.col("_asked"), "left_semi")
    return broadcast_if_measured_small(met, "met-parents")


def touched_or_unresolved(as_col: str, batch_no: Column) -> Column:
    """Rows whose reference can change in this batch, given that every
    earlier batch resolved its references: rows written by this batch
    (new or updated, possibly with a new natural key) and rows still
    without an id (their parent may have arrived now). Parent ids never
    change and nothing is deleted, so every other row already holds the
    id a full pass would give it."""
    return (F.col("etl_batch_no") == batch_no) | F.col(as_col).isNull()
