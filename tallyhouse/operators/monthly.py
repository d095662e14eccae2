"""Incremental monthly roll-ups of the daily summaries (M1-M4).

``monthly_update`` (M1/M3): existing (month, id) rows absorb this
batch's daily rows: additive measures ``m.x + d.x`` (a NULL delta makes
the sum NULL), flags ``CASE WHEN m.f = 1 THEN 1 ELSE d.f END``. The
original UPDATE ... FROM may match several daily rows per key and then
applies one arbitrary row; here the delta is first aggregated per key
(SUM, MAX flags, MAX batch), which is identical when one row matches.

``monthly_insert`` (M2/M4): (month, id) pairs absent from the monthly
table, aggregated over all their daily rows. NULL ids never match an
existing row (plain equality), so they are inserted again each batch
unless ``null_safe_keys`` is set.

``monthly_recompute`` (Q23): touched and absent pairs from all their
daily rows, whatever the monthly table held.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.context import BatchContext
from tallyhouse.functions.columns import month_start, on_or_after
from tallyhouse.operators.daily import AMOUNT, COUNT, FLAG
from tallyhouse.operators.joins import broadcast_if_measured_small
from tallyhouse.session import write_through

MONTH = "start_of_the_month_date"


@dataclass(frozen=True)
class RollupSpec:
    key: str
    columns: tuple[tuple[str, T.DataType], ...]  # monthly table, in order
    sums: tuple[str, ...]
    flags: tuple[str, ...]  # daily flag names (``x_apd``); monthly adds ``x_apm``

    @staticmethod
    def apm(flag: str) -> str:
        return flag[:-4] + "_apm"


_TAIL = (("dw_create_timestamp", T.TimestampNTZType()), ("dw_update_timestamp", T.TimestampNTZType()),
         ("etl_batch_no", T.IntegerType()), ("etl_batch_date", T.DateType()))

CUSTOMER_ROLLUP = RollupSpec(
    key="dw_customer_id",
    columns=((MONTH, T.DateType()), ("dw_customer_id", T.LongType()),
             ("order_count", COUNT), ("order_apd", FLAG), ("order_apm", FLAG),
             ("order_cost_amount", AMOUNT), ("cancelled_order_count", COUNT),
             ("cancelled_order_amount", AMOUNT), ("cancelled_order_apd", FLAG),
             ("cancelled_order_apm", FLAG), ("shipped_order_count", COUNT),
             ("shipped_order_amount", AMOUNT), ("shipped_order_apd", FLAG),
             ("shipped_order_apm", FLAG), ("payment_apd", FLAG), ("payment_apm", FLAG),
             ("payment_amount", AMOUNT), ("products_ordered_qty", COUNT),
             ("products_items_qty", COUNT), ("order_mrp_amount", AMOUNT),
             ("new_customer_apd", FLAG), ("new_customer_apm", FLAG),
             ("new_customer_paid_apd", FLAG), ("new_customer_paid_apm", FLAG)) + _TAIL,
    sums=("order_count", "order_cost_amount", "cancelled_order_count", "cancelled_order_amount",
          "shipped_order_count", "shipped_order_amount", "payment_amount",
          "products_ordered_qty", "products_items_qty", "order_mrp_amount"),
    flags=("order_apd", "cancelled_order_apd", "shipped_order_apd", "payment_apd",
           "new_customer_apd", "new_customer_paid_apd"),
)

PRODUCT_ROLLUP = RollupSpec(
    key="dw_product_id",
    columns=((MONTH, T.DateType()), ("dw_product_id", T.LongType()),
             ("customer_apd", FLAG), ("customer_apm", FLAG),
             ("product_cost_amount", AMOUNT), ("product_mrp_amount", AMOUNT),
             ("cancelled_product_qty", COUNT), ("cancelled_cost_amount", AMOUNT),
             ("cancelled_mrp_amount", AMOUNT), ("cancelled_order_apd", FLAG),
             ("cancelled_order_apm", FLAG)) + _TAIL,
    sums=("product_cost_amount", "product_mrp_amount", "cancelled_product_qty",
          "cancelled_cost_amount", "cancelled_mrp_amount"),
    flags=("customer_apd", "cancelled_order_apd"),
)


def _aggregate_daily(daily: DataFrame, spec: RollupSpec, *more) -> DataFrame:
    """Per (month, id): SUM measures, MAX flags, MAX batch columns."""
    types = dict(spec.columns)
    aggs = [F.sum(c).cast(types[c]).alias(c) for c in spec.sums]
    aggs += [F.max(f).cast(FLAG).alias(f) for f in spec.flags]
    aggs += [F.max("etl_batch_no").alias("etl_batch_no"),
             F.max("etl_batch_date").alias("etl_batch_date")]
    return daily.groupBy(month_start("summary_date").alias(MONTH), spec.key).agg(*aggs, *more)


def _key_match(left_month, left_key, right_month, right_key, null_safe: bool):
    if null_safe:
        return (left_month == right_month) & left_key.eqNullSafe(right_key)
    return (left_month == right_month) & (left_key == right_key)


def monthly_update(monthly: DataFrame, daily: DataFrame, spec: RollupSpec, ctx: BatchContext,
                   null_safe_keys: bool = False) -> DataFrame:
    """Monthly table after the UPDATE step (all rows)."""
    d = _aggregate_daily(daily.where(on_or_after("summary_date", ctx.date_col())), spec)
    # One row per touched (month, id): broadcast once measured small, so the
    # monthly table is streamed through the join without a shuffle.
    d = broadcast_if_measured_small(d.select(*[F.col(c).alias(f"_d_{c}") for c in d.columns]),
                                    "monthly_delta")
    j = monthly.join(d, _key_match(F.col(MONTH), F.col(spec.key), F.col(f"_d_{MONTH}"),
                                   F.col(f"_d_{spec.key}"), null_safe_keys), "left")
    hit = F.col(f"_d_{MONTH}").isNotNull()
    new = {}
    for c in spec.sums:
        new[c] = F.when(hit, F.col(c) + F.col(f"_d_{c}")).otherwise(F.col(c))
    for f in spec.flags:
        m = spec.apm(f)
        new[f] = F.when(hit, F.when(F.col(f) == 1, 1).otherwise(F.col(f"_d_{f}"))).otherwise(F.col(f))
        new[m] = F.when(hit, F.when(F.col(m) == 1, 1).otherwise(F.col(f"_d_{f}"))).otherwise(F.col(m))
    new["dw_update_timestamp"] = F.when(hit, ctx.run_ts_col()).otherwise(F.col("dw_update_timestamp"))
    new["etl_batch_no"] = F.when(hit, F.col("_d_etl_batch_no")).otherwise(F.col("etl_batch_no"))
    new["etl_batch_date"] = F.when(hit, F.col("_d_etl_batch_date")).otherwise(F.col("etl_batch_date"))
    return j.select(*[new.get(c, F.col(c)).cast(t).alias(c) for c, t in spec.columns])


def _fresh(agg: DataFrame, spec: RollupSpec, ctx: BatchContext, created=None) -> DataFrame:
    """Aggregated daily rows as monthly rows."""
    vals = {c: F.col(c) for c in agg.columns}
    for f in spec.flags:
        vals[spec.apm(f)] = F.col(f)
    vals["dw_create_timestamp"] = ctx.run_ts_col() if created is None else created
    vals["dw_update_timestamp"] = ctx.run_ts_col()
    return agg.select(*[vals[c].cast(t).alias(c) for c, t in spec.columns])


def monthly_insert(monthly: DataFrame, daily: DataFrame, spec: RollupSpec, ctx: BatchContext,
                   null_safe_keys: bool = False) -> DataFrame:
    """Rows inserted for (month, id) pairs the monthly table lacks.

    The daily rows are aggregated first, so the anti join meets one row per
    pair, on the partitioning that the aggregate left. Pairs of a NULL id,
    one per month by then, match nothing (unless ``null_safe_keys``)."""
    existing = monthly.select(F.col(MONTH).alias("_m_month"), F.col(spec.key).alias("_m_key"))
    match = _key_match(F.col(MONTH), F.col(spec.key), F.col("_m_month"), F.col("_m_key"), null_safe_keys)
    return _fresh(_aggregate_daily(daily, spec).join(existing, match, "left_anti"), spec, ctx)


def _daily_types(daily: DataFrame, spec: RollupSpec) -> list[tuple[str, str]]:
    """What the roll-up reads of a daily row beside its day and id."""
    types = dict(daily.dtypes)
    return [(c, types[c]) for c in (*spec.sums, *spec.flags, "etl_batch_no", "etl_batch_date")]


def recomputed_pairs(monthly: DataFrame, daily: DataFrame, spec: RollupSpec, ctx: BatchContext) -> DataFrame:
    """Monthly rows of every (month, id) that this batch's daily rows touch
    or that the monthly table lacks, aggregated from all its daily rows; an
    existing row keeps its create time."""
    # Both tables in one grouped aggregate, which takes NULL ids as equal:
    # monthly rows (NULL months match nothing) bring their keys and create time.
    types = dict(monthly.dtypes)
    day = F.to_date(F.col(MONTH)).alias("summary_date")
    kept = monthly.where(month_start(MONTH) == F.col(MONTH)).select(
        day, spec.key, "dw_create_timestamp", *[F.lit(None).cast(t).alias(c) for c, t in _daily_types(daily, spec)],
        F.lit(False).alias("_daily"), F.lit(False).alias("_new"))
    rows = daily.select("summary_date", spec.key, F.lit(None).cast(types["dw_create_timestamp"]).alias("dw_create_timestamp"),
                        *[c for c, _ in _daily_types(daily, spec)], F.lit(True).alias("_daily"),
                        F.coalesce(on_or_after("summary_date", ctx.date_col()), F.lit(False)).alias("_new"))
    again = _aggregate_daily(rows.unionByName(kept), spec, F.min("dw_create_timestamp").alias("_created"),
                             F.max("_daily").alias("_daily"), F.max("_new").alias("_touched"),
                             F.max(~F.col("_daily")).alias("_m_row"))
    met = again.where(F.col("_daily") & (F.col("_touched") | ~F.col("_m_row")))
    return _fresh(met, spec, ctx, F.coalesce("_created", ctx.run_ts_col()))


def monthly_recompute(monthly: DataFrame, daily: DataFrame, spec: RollupSpec, ctx: BatchContext) -> DataFrame:
    """Alternative to update+insert that is safe to rerun: touched and
    absent pairs are aggregated again, other monthly rows pass through."""
    again = write_through(recomputed_pairs(monthly, daily, spec, ctx), "monthly_again")
    pairs = again.select(F.col(MONTH).alias("_t_month"), F.col(spec.key).alias("_t_key"))
    keep = monthly.join(pairs, (F.col(MONTH) == F.col("_t_month"))
                        & F.col(spec.key).eqNullSafe(F.col("_t_key")), "left_anti")
    return keep.unionByName(again)


def monthly_rollup(monthly: DataFrame, daily: DataFrame, spec: RollupSpec, ctx: BatchContext,
                   mode: str = "incremental", null_safe_keys: bool = False) -> DataFrame:
    """Complete next monthly table."""
    if mode == "recompute":
        return monthly_recompute(monthly, daily, spec, ctx)
    return monthly_update(monthly, daily, spec, ctx, null_safe_keys) \
        .unionByName(monthly_insert(monthly, daily, spec, ctx, null_safe_keys))


def monthly_schema(spec: RollupSpec) -> T.StructType:
    return T.StructType([T.StructField(c, t, True) for c, t in spec.columns])
