"""SCD type 2 history of one tracked attribute (H1-H4), in one pass.

The original closes changed active rows (UPDATE) and then inserts a new
active row for keys that have none left (INSERT ... LEFT JOIN active ...
IS NULL OR value <> value). Because the close runs first, a key gets a
new row exactly when it had no active row before the batch or its value
changed; the change test is computed once against the pre-batch history.

Plan of ``scd2``: inactive history rows pass through without a shuffle;
active rows are joined once to ``(key, value)`` of the dimension (full
outer join, both sides hash-partitioned on the key), and each joined row
gives the active row as it is now (closed or not) and, where one opens,
the new row. ``scd2_close`` and ``scd2_open`` are the two steps alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.context import BatchContext
from tallyhouse.functions.columns import day_before


def _changed(old, new, null_safe: bool):
    if null_safe:
        return ~old.eqNullSafe(new)
    # Plain SQL '<>': NULL on either side is "not changed".
    return F.coalesce(old != new, F.lit(False))


def _active_join(history: DataFrame, dim: DataFrame, key: str, tracked: str) -> DataFrame:
    act = _active(history)
    d = dim.select(F.col(key).alias("_d_key"), F.col(tracked).alias("_d_val"))
    return act.join(d, F.col(key) == F.col("_d_key"), "full_outer")


def _active(df: DataFrame) -> DataFrame:
    return df.where(F.col("dw_active_record_ind") == 1)


def _inactive(df: DataFrame) -> DataFrame:
    return df.where(~F.coalesce(F.col("dw_active_record_ind") == 1, F.lit(False)))


def _kept(history: DataFrame, tracked: str, ctx: BatchContext, null_safe: bool) -> list:
    """Columns of an active row after the close step."""
    ch = F.col("_d_key").isNotNull() & _changed(F.col(tracked), F.col("_d_val"), null_safe)
    upd = {
        "dw_active_record_ind": F.when(ch, F.lit(0)).otherwise(F.col("dw_active_record_ind")),
        "effective_to_date": F.when(ch, day_before(ctx.date_col())).otherwise(F.col("effective_to_date")),
        "update_etl_batch_no": F.when(ch, ctx.no_col()).otherwise(F.col("update_etl_batch_no")),
        "update_etl_batch_date": F.when(ch, ctx.date_col()).otherwise(F.col("update_etl_batch_date")),
        "dw_update_timestamp": F.when(ch, ctx.run_ts_col()).otherwise(F.col("dw_update_timestamp")),
    }
    return [upd.get(c, F.col(c)).cast(history.schema[c].dataType).alias(c) for c in history.columns]


def _opens(tracked: str, null_safe: bool):
    """Joined rows that open a new active row."""
    return F.col("_d_key").isNotNull() & (F.col("dw_active_record_ind").isNull()
                                          | _changed(F.col(tracked), F.col("_d_val"), null_safe))


def _opened(history: DataFrame, key: str, tracked: str, ctx: BatchContext) -> list:
    vals = {
        key: F.col("_d_key"),
        tracked: F.col("_d_val"),
        "effective_from_date": ctx.date_col(),
        "effective_to_date": F.lit(None).cast("date"),
        "dw_active_record_ind": F.lit(1),
        "dw_create_timestamp": ctx.run_ts_col(),
        "dw_update_timestamp": ctx.run_ts_col(),
        "create_etl_batch_no": ctx.no_col(),
        "create_etl_batch_date": ctx.date_col(),
        "update_etl_batch_no": F.lit(None).cast("int"),
        "update_etl_batch_date": F.lit(None).cast("date"),
    }
    return [vals[c].cast(history.schema[c].dataType).alias(c) for c in history.columns]


def scd2_close(history: DataFrame, dim: DataFrame, key: str, tracked: str,
               ctx: BatchContext, null_safe: bool = False) -> DataFrame:
    """History after the close step (H1/H3): every row, changed active
    rows closed with effective_to = batch date - 1."""
    joined = _active(_active_join(history, dim, key, tracked))
    return _inactive(history).unionByName(joined.select(*_kept(history, tracked, ctx, null_safe)))


def scd2_open(history: DataFrame, dim: DataFrame, key: str, tracked: str,
              ctx: BatchContext, null_safe: bool = False) -> DataFrame:
    """Rows inserted by the open step (H2/H4): dimension keys without an
    active row, or whose tracked value changed."""
    joined = _active_join(history, dim, key, tracked)
    return joined.where(_opens(tracked, null_safe)).select(*_opened(history, key, tracked, ctx))


def scd2_active(history: DataFrame, dim: DataFrame, key: str, tracked: str,
                ctx: BatchContext, null_safe: bool = False) -> DataFrame:
    """What becomes of the active rows of ``history``: those rows, closed
    where their value changed, and the rows that open. One join."""
    joined = _active_join(history, dim, key, tracked)
    rows = F.array(
        F.when(F.col("dw_active_record_ind") == 1, F.struct(*_kept(history, tracked, ctx, null_safe))),
        F.when(_opens(tracked, null_safe), F.struct(*_opened(history, key, tracked, ctx))))
    return joined.select(F.explode(rows).alias("_row")).where(F.col("_row").isNotNull()) \
        .select(*[F.col(f"_row.{c}").alias(c) for c in history.columns])


def scd2(history: DataFrame, dim: DataFrame, key: str, tracked: str,
         ctx: BatchContext, null_safe: bool = False) -> DataFrame:
    """Complete next history table."""
    return _inactive(history).unionByName(scd2_active(history, dim, key, tracked, ctx, null_safe))
