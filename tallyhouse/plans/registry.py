"""Registered queries: one per operator key, each over whole driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame. Money is
computed in decimals; :func:`present` casts decimal columns to double as
the last step so both engines of the correctness check print the same
values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.context import latest_batch, snapshot_date_col
from tallyhouse.operators import daily as D
from tallyhouse.operators import monthly as M
from tallyhouse.operators.audit import batch_state
from tallyhouse.operators.scd2 import scd2_close, scd2_open
from tallyhouse.operators.surrogate import assign_surrogate_keys
from tallyhouse.plans.testbed import Testbed
from tallyhouse.schemas import SPECS
from tallyhouse.session import ensure_checkpoint_dir
from tallyhouse.functions.columns import norm_text
from tallyhouse.sources.csv_stage import (parse_auto_date, parse_auto_timestamp, read_stage,
                                          truncate_columns, write_delta_csv)


def present(df: DataFrame) -> DataFrame:
    return df.select(*[(F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType)
                        else F.col(f.name)).alias(f.name) for f in df.schema.fields])


Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        _REGISTRY[name] = lambda spark, sf_dir: present(fn(Testbed.shared(spark, sf_dir)))
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# ------------------------------------------------------------ control data

def control_table(tb: Testbed) -> DataFrame:
    """Control rows: one batch per month of order activity."""
    m = tb.table("orders").select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("d")).distinct()
    return m.select(
        (F.months_between("d", F.lit("1995-01-01").cast("date")).cast("int") + 1).alias("etl_batch_no"),
        F.col("d").alias("etl_batch_date"))


@register("batch_context")
def q_batch_context(tb):
    return latest_batch(control_table(tb))


@register("snapshot_source")
def q_snapshot_source(tb):
    c = control_table(tb)
    snap = snapshot_date_col(F.col("etl_batch_date"))
    return c.select("etl_batch_no", "etl_batch_date", snap.alias("snapshot_date"),
                    F.concat(F.lit("CM_"), F.date_format(snap, "yyyyMMdd")).alias("snapshot_name"))


def log_events(tb: Testbed) -> DataFrame:
    """Batch log events derived from the event stream: a signup starts
    (or restarts) the batch of its day, a purchase completes it, an error
    fails it; other event types are not log events."""
    e = tb.table("events")
    ev = F.when(F.col("event_type") == "signup", "R").when(F.col("event_type") == "purchase", "C") \
        .when(F.col("event_type") == "error", "F")
    return e.select(F.dayofmonth("ts").cast("int").alias("etl_batch_no"),
                    F.col("ts").cast("date").alias("etl_batch_date"), ev.alias("event"),
                    F.col("ts").cast("timestamp_ntz").alias("event_time"),
                    F.col("event_id").alias("seq")).where(F.col("event").isNotNull())


@register("batch_log_state")
def q_batch_log_state(tb):
    return batch_state(log_events(tb))


# ------------------------------------------------------------------ sources

@register("delta_extract")
def q_delta_extract(tb):
    return tb.stage("orders")


for _t in SPECS:
    register(f"delta_extract_{_t}")(lambda tb, _t=_t: tb.stage(_t))


def _scratch(tb: Testbed) -> str:
    return f"{ensure_checkpoint_dir(tb.spark).rstrip('/')}/tallyhouse-stage/{uuid.uuid4().hex}"


@register("csv_roundtrip")
def q_csv_roundtrip(tb):
    root = _scratch(tb)
    path = write_delta_csv(tb.stage("orders"), root, "orders", tb.ctx.batch_date)
    return read_stage(tb.spark, path, SPECS["orders"], empty_text="null")


@register("stage_empty_status")
def q_stage_empty_status(tb):
    """Orders without a status come back from the stage with an empty one,
    which makes them open orders (the default of the load)."""
    root = _scratch(tb)
    orders = tb.stage("orders").withColumn("status", F.when(F.col("orderNumber") % 5 != 0, F.col("status")))
    path = write_delta_csv(orders, root, "orders", tb.ctx.batch_date)
    back = read_stage(tb.spark, path, SPECS["orders"])
    return back.select("orderNumber", "status", (~norm_text("status").isin(D.CANCELLED, D.SHIPPED)).alias("is_open"))


@register("stage_reload")
def q_stage_reload(tb):
    root = _scratch(tb)
    path = write_delta_csv(tb.stage("customers"), root, "customers", tb.ctx.batch_date)
    return read_stage(tb.spark, path, SPECS["customers"], empty_text="empty")


# Column widths used by the truncation query (fixed test values).
TEST_WIDTHS = {"customerName": 12, "contactLastName": 5}


@register("truncate_columns")
def q_truncate_columns(tb):
    return truncate_columns(tb.stage("customers"), TEST_WIDTHS)


@register("truncate_columns_bytes")
def q_truncate_columns_bytes(tb):
    """Widths count bytes; a letter that would be cut in two is left out."""
    o = tb.stage("offices").withColumn("cut", F.concat("city", F.lit("é")))
    return truncate_columns(o, {"cut": 5}).select("officeCode", "city", "cut")


@register("parse_auto_dates")
def q_parse_auto_dates(tb):
    o = tb.source("orders")
    ts = F.col("create_timestamp")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    plain = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    forms = [plain, F.date_format(ts, "yyyy/MM/dd HH:mm:ss"), F.date_format(ts, "MM/dd/yyyy"), F.concat(iso, F.lit(".123")),
             F.concat(iso, F.lit("Z")), F.date_format(ts, "M/d/yyyy"), F.date_format(ts, "yyyy-MM-dd HH:mm"),
             F.concat(plain, F.lit(".1234567")), F.concat(iso, F.lit("+02:00"))]
    text = F.element_at(F.array(*forms), F.col("orderNumber") % len(forms) + 1)
    parsed = parse_auto_timestamp(text)
    return o.select("orderNumber", text.alias("ts_text"), parsed.alias("parsed_ts"),
                    parsed.cast("date").alias("parsed_date"), parse_auto_date(text).alias("auto_date"))


# ----------------------------------------------------------------- upserts

for _t in SPECS:
    register(f"upsert_insert_{_t}")(lambda tb, _t=_t: tb.inserted(_t))
    register(f"upsert_update_{_t}")(lambda tb, _t=_t: tb.updated(_t))


@register("surrogate_keys")
def q_surrogate_keys(tb):
    # Numbered in several range partitions, whatever the input size.
    keys = tb.source("orderdetails").select("orderNumber", "productCode").distinct()
    n = int(tb.spark.conf.get("spark.sql.shuffle.partitions"))
    return assign_surrogate_keys(keys, ["orderNumber", "productCode"], "dw_orderdetail_id",
                                 num_partitions=n)


register("ref_customers_employee")(lambda tb: tb.wh_customers)
register("ref_employees_office")(lambda tb: tb.wh_employees_office)
register("ref_employees_manager")(lambda tb: tb.wh_employees)
register("ref_products_line")(lambda tb: tb.wh_products)
register("ref_orders_customer")(lambda tb: tb.wh_orders)
register("ref_orderdetails_order")(lambda tb: tb.wh_orderdetails_order)
register("ref_orderdetails_product")(lambda tb: tb.wh_orderdetails)
register("ref_payments_customer")(lambda tb: tb.wh_payments)


# --------------------------------------------------------------------- scd2

def _scd2_args(tb, name):
    if name == "customers":
        return tb.prior_history("customers"), tb.mat("wh_customers"), "dw_customer_id", "creditLimit"
    return tb.prior_history("products"), tb.mat("wh_products"), "dw_product_id", "MSRP"


for _t in ("customers", "products"):
    register(f"scd2_close_{_t}")(lambda tb, _t=_t: scd2_close(*_scd2_args(tb, _t), tb.ctx))
    register(f"scd2_open_{_t}")(lambda tb, _t=_t: scd2_open(*_scd2_args(tb, _t), tb.ctx))


# ------------------------------------------------------------------- daily

register("first_payment")(lambda tb: D.first_payment(tb.mat("wh_payments")))
register("daily_new_customers")(lambda tb: D.new_customers(tb.mat("wh_customers"), tb.ctx))
register("daily_payments")(lambda tb: D.payment_branch(tb.mat("wh_payments"), tb.ctx))
for _key, _br in (("daily_products_ordered", D.ORDERED), ("daily_cancelled_orders", D.CANCEL),
                  ("daily_shipped_orders", D.SHIP), ("daily_open_orders", D.OPEN)):
    register(_key)(lambda tb, _br=_br: D.line_branch(_br, tb.mat("wh_orders"), tb.mat("wh_orderdetails"),
                                                     tb.mat("wh_products"), tb.ctx))
register("daily_customer_summary")(lambda tb: tb.daily_customer())
# Switch paths of the semantics register, over the same whole tables.
register("daily_customer_summary_additive_sum")(lambda tb: tb.daily_customer(additive="sum"))
register("daily_customer_summary_additive_exact")(lambda tb: tb.daily_customer(additive="exact"))
register("daily_customer_summary_customers_only")(lambda tb: tb.daily_customer(new_customer="customers_only"))
register("daily_product_ordered")(lambda tb: D.product_branch(
    D.ORDERED, tb.mat("wh_orders"), tb.mat("wh_orderdetails"), tb.mat("wh_products"), tb.ctx))
register("daily_product_cancelled")(lambda tb: D.product_branch(
    D.CANCEL, tb.mat("wh_orders"), tb.mat("wh_orderdetails"), tb.mat("wh_products"), tb.ctx))
register("daily_product_summary")(lambda tb: tb.daily_product())


# ----------------------------------------------------------------- monthly

def _monthly(tb, kind, step):
    daily, monthly = tb.daily_tables(kind)
    spec = M.CUSTOMER_ROLLUP if kind == "customer" else M.PRODUCT_ROLLUP
    fn = M.monthly_update if step == "update" else M.monthly_insert
    return fn(monthly, daily, spec, tb.ctx)


for _k in ("customer", "product"):
    for _s in ("update", "insert"):
        register(f"monthly_{_k}_{_s}")(lambda tb, _k=_k, _s=_s: _monthly(tb, _k, _s))


def _recompute(tb, kind):
    daily, monthly = tb.daily_tables(kind)
    spec = M.CUSTOMER_ROLLUP if kind == "customer" else M.PRODUCT_ROLLUP
    return M.monthly_rollup(monthly, daily, spec, tb.ctx, mode="recompute")


for _k in ("customer", "product"):
    register(f"monthly_{_k}_recompute")(lambda tb, _k=_k: _recompute(tb, _k))
