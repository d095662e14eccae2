"""Keyed upsert, SCD type 1 (U1-U16) with surrogate keys.

The original runs INSERT ... LEFT JOIN ... IS NULL, then UPDATE ... FROM
stage WHERE stage.ts > target.ts. Here both are DataFrames over the same
inputs, and the next snapshot is ``updated(target) UNION inserted``:

* ``upsert_updates``: target LEFT JOIN deduplicated stage on the update
  keys; a column takes the stage value only where the stage row is
  strictly newer (NULL on either side: no update).
* ``upsert_inserts``: stage LEFT ANTI JOIN target on the insert keys,
  then fresh surrogate ids after the largest existing one.

``upsert`` de-duplicates and writes the delta once, then picks the plan. A
delta under the broadcast limit is broadcast: the (large) target is
streamed, its keys once more, and nothing of it is shuffled. A larger
delta of a table whose two keys agree takes one outer join, of which
Catalyst keeps the target's side for the updates and the stage's side for
the rows to be numbered; without rows to be numbered the join is made once
and such a delta not written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.context import BatchContext
from tallyhouse.operators.dedupe import latest_per_key
from tallyhouse.operators.joins import broadcast_if_small, broadcast_limit
from tallyhouse.operators.surrogate import assign_surrogate_keys, max_id
from tallyhouse.schemas import TableSpec
from tallyhouse.session import estimated_size_bytes, write_through

# A delta of more rows than the broadcast limit holds of this many bytes is
# taken as a large one without being written (a row of keys, two timestamps
# and values takes more in parquet).
LEAST_ROW_BYTES = 16


def stage_to_warehouse(stage: DataFrame, spec: TableSpec) -> DataFrame:
    """Deduplicate the stage (newest update_timestamp per update key) and
    rename its columns to warehouse names."""
    s = latest_per_key(stage.select(*spec.source_names), spec.update_keys, "update_timestamp")
    return s.select(*[F.col(c).alias(spec.wh(c)) for c in spec.source_names])


def _replaced(target: DataFrame, spec: TableSpec, ctx: BatchContext) -> list:
    """The target's columns where ``_s_`` columns hold the stage row."""
    newer = F.coalesce(F.col("_s_src_update_timestamp") > F.col("src_update_timestamp"), F.lit(False))
    new = {spec.wh(c): F.col(f"_s_{spec.wh(c)}") for c in spec.update_cols}
    new |= {"src_update_timestamp": F.col("_s_src_update_timestamp"),
            "etl_batch_no": ctx.no_col(), "etl_batch_date": ctx.date_col()}
    return [(F.when(newer, new[c]).otherwise(F.col(c)) if c in new else F.col(c)).alias(c)
            for c in target.columns]


def _new_rows(rows: DataFrame, spec: TableSpec, ctx: BatchContext, start_after: int) -> DataFrame:
    """Stage rows (warehouse names) as new warehouse rows: fresh ids, NULL
    references, current batch stamps."""
    cols = {c: F.col(c) for c in rows.columns}
    cols |= {r: F.lit(None).cast("long") for r in spec.refs}
    cols |= {"etl_batch_no": ctx.no_col(), "etl_batch_date": ctx.date_col()}
    names = [c for c, _ in spec.warehouse_columns() if c != spec.id_col]
    out = rows.select(*[cols[c].alias(c) for c in names])
    if spec.id_col:
        out = assign_surrogate_keys(out, [spec.wh(k) for k in spec.insert_keys], spec.id_col, start_after)
    return out.select(*[c for c, _ in spec.warehouse_columns()])


def _updates(target: DataFrame, s: DataFrame, spec: TableSpec, ctx: BatchContext) -> DataFrame:
    keys = [spec.wh(k) for k in spec.update_keys]
    used = keys + [spec.wh(c) for c in spec.update_cols] + ["src_update_timestamp"]
    # A delta under the size limit is broadcast: the target is then read
    # and streamed through the join without a shuffle.
    s = broadcast_if_small(s.select(*[F.col(c).alias(f"_s_{c}") for c in used]))
    joined = target.join(s, [F.col(k) == F.col(f"_s_{k}") for k in keys], "left")
    return joined.select(*_replaced(target, spec, ctx))


def absent_rows(target: DataFrame, s: DataFrame, spec: TableSpec) -> DataFrame:
    """De-duplicated stage rows whose insert key the target lacks."""
    keys = [spec.wh(k) for k in spec.insert_keys]
    # Target keys that the stage mentions: the target's key columns are
    # streamed through a semi join against the (broadcast, when small)
    # stage keys, so the large target is not shuffled; the anti join that
    # follows is between two small sides. NULL keys never match: inserted.
    tkeys = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    skeys = broadcast_if_small(s.select(*[F.col(k).alias(f"_s_{k}") for k in keys]))
    hit = tkeys.join(skeys, [F.col(f"_t_{k}") == F.col(f"_s_{k}") for k in keys], "left_semi")
    return s.join(hit, [F.col(k) == F.col(f"_t_{k}") for k in keys], "left_anti")


def _inserts(target: DataFrame, s: DataFrame, spec: TableSpec, ctx: BatchContext, start_after: int) -> DataFrame:
    return _new_rows(absent_rows(target, s, spec), spec, ctx, start_after)


def _first_free(target: DataFrame, spec: TableSpec, start_after: int | None) -> int:
    if start_after is not None or not spec.id_col:
        return start_after or 0
    return max_id(target, spec.id_col)


def updated_rows(target: DataFrame, delta: DataFrame, spec: TableSpec, ctx: BatchContext) -> DataFrame:
    """``target`` after the UPDATE step of a de-duplicated delta (warehouse
    names)."""
    return _updates(target, delta, spec, ctx)


def inserted_rows(fresh: DataFrame, spec: TableSpec, ctx: BatchContext, start_after: int) -> DataFrame:
    """Delta rows that the table lacks as new warehouse rows."""
    return _new_rows(fresh, spec, ctx, start_after)


def upsert_updates(target: DataFrame, stage: DataFrame, spec: TableSpec,
                   ctx: BatchContext) -> DataFrame:
    """Target rows after the UPDATE step (every target row, same columns)."""
    return _updates(target, stage_to_warehouse(stage, spec), spec, ctx)


def upsert_inserts(target: DataFrame, stage: DataFrame, spec: TableSpec,
                   ctx: BatchContext, start_after: int | None = None) -> DataFrame:
    """Stage rows whose insert key is absent from the target, as new
    warehouse rows. Ids follow ``start_after`` (the target's largest id)."""
    return _inserts(target, stage_to_warehouse(stage, spec), spec, ctx, _first_free(target, spec, start_after))


def _merged(target: DataFrame, s: DataFrame, spec: TableSpec, ctx: BatchContext) -> DataFrame:
    """Updated and new rows of a table without surrogate ids, whose new rows
    need no numbering: one outer join, each side moved once."""
    keys = [spec.wh(k) for k in spec.update_keys]
    marked = s.select(*[F.col(c).alias(f"_s_{c}") for c in s.columns])
    joined = target.withColumn("_t_row", F.lit(True)).join(
        marked, [F.col(k) == F.col(f"_s_{k}") for k in keys], "full_outer")
    new = {c: F.col(f"_s_{c}") for c in s.columns}
    new |= {r: F.lit(None).cast("long") for r in spec.refs}
    new |= {"etl_batch_no": ctx.no_col(), "etl_batch_date": ctx.date_col()}
    return joined.select(*[F.when(F.col("_t_row"), old).otherwise(new[c]).alias(c)
                           for c, old in zip(target.columns, _replaced(target, spec, ctx), strict=True)])


def upsert(target: DataFrame, stage: DataFrame, spec: TableSpec,
           ctx: BatchContext, start_after: int | None = None) -> DataFrame:
    """Complete next snapshot of an SCD1 table. Reads the stage once, but
    for a delta of so many rows that it is joined without being written:
    those are counted first."""
    if not spec.id_col and spec.insert_keys == spec.update_keys:
        if stage.count() * LEAST_ROW_BYTES > broadcast_limit(stage):
            return _merged(target, stage_to_warehouse(stage, spec), spec, ctx)
    s = write_through(stage_to_warehouse(stage, spec), f"delta-{spec.name}")
    start_after = _first_free(target, spec, start_after)
    size = estimated_size_bytes(s)
    small = size is not None and size <= broadcast_limit(s)
    if small or spec.insert_keys != spec.update_keys:
        return _updates(target, s, spec, ctx).unionByName(_inserts(target, s, spec, ctx, start_after))
    keys = [spec.wh(k) for k in spec.update_keys]
    marked = s.select(*[F.col(c).alias(f"_s_{c}") for c in s.columns], F.lit(True).alias("_s_row"))
    joined = target.withColumn("_t_row", F.lit(True)).join(
        marked, [F.col(k) == F.col(f"_s_{k}") for k in keys], "full_outer")
    updated = joined.where("_t_row").select(*_replaced(target, spec, ctx))
    fresh = joined.where("_t_row is null").select(*[F.col(f"_s_{c}").alias(c) for c in s.columns])
    return updated.unionByName(_new_rows(fresh, spec, ctx, start_after))
