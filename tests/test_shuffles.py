"""What a query moves: exchanges of the steps that hold most rows."""

import re
from contextlib import contextmanager

from pyspark.sql import functions as F

from tallyhouse.operators import daily as D
from tallyhouse.operators import monthly as M
from tallyhouse.operators.refs import resolve_ref
from tallyhouse.operators.upsert import upsert
from tallyhouse.schemas import SPECS

from helpers import CTX, d, m, rows, ts
from test_summaries import _inputs


@contextmanager
def _nothing_broadcast(spark):
    conf = {"spark.tallyhouse.broadcastMaxBytes": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df, on=""):
    return len(re.findall(rf"Exchange hashpartitioning\({on}", _plan(df)))


def _order_data(spark):
    orders = [(i, i % 3 or None, i, d("2024-03-12"), d("2024-03-13"), d("2024-03-14"), ["In Process", "shipped", "cancelled "][i % 3],
               ts("2024-03-12 01:00:00"), ts("2024-03-12 01:00:00")) for i in range(1, 13)]
    lines = [(i, j, i, f"P{j}", j, m(i), 7, d("2024-03-10")) for i in range(1, 13) for j in (1, 2, 2)]
    return _inputs(spark, orders, lines, [(1, ts("2024-03-12 00:00:00"), ts("2024-03-12 00:00:00"), 7, d("2024-03-10"))],
                   [(1, d("2024-03-12"), m(5), ts("2024-03-12 00:00:00"), ts("2024-03-12 00:00:00"), 7, d("2024-03-10")),
                    (1, d("2024-03-12"), m(6), ts("2024-03-12 00:00:00"), ts("2024-03-12 09:00:00"), 7, d("2024-03-10"))])


def test_customer_events_move_once(spark):
    c, o, od, p, pa = _order_data(spark)
    for mode in ("reference", "sum", "exact"):
        df = D.daily_customer_summary(c, o, od, p, pa, CTX, additive=mode)
        assert _exchanges(df, "summary_date") == 1
        assert _exchanges(df, "br") == 0
        got = {(r["summary_date"], r["dw_customer_id"]): r for r in df.collect()}
        day = got[d("2024-03-12"), 1]
        assert (day["payment_amount"], day["payment_apd"], day["new_customer_paid_apd"]) == (m(11), 1, 1)
        # customer 1 has the shipped orders 1, 4, 7 and 10, of 2 products each
        assert day["products_ordered_qty"] == 2 and day["new_customer_apd"] == 1
        assert day["products_items_qty"] == 4 * 5
        assert got[d("2024-03-13"), 1]["shipped_order_count"] == 4


def test_cancelled_orders_move_once(spark):
    _, o, od, p, _ = _order_data(spark)
    df = D.line_branch(D.CANCEL, o, od, p, CTX)
    assert _exchanges(df, "summary_date") == 1 and _exchanges(df, "br") == 0
    assert rows(df, "summary_date", "dw_customer_id", "cancelled_order_count", "cancelled_order_amount") \
        == [(d("2024-03-14"), 2, 4, m(5 * (2 + 5 + 8 + 11)))]


def test_product_events_move_as_lines(spark):
    _, o, od, p, _ = _order_data(spark)
    with _nothing_broadcast(spark):
        df = D.daily_product_summary(o, od, p, CTX)
        assert _exchanges(df, "summary_date") == 1
        # no sums below the exchange of the events
        below = _plan(df).split("Exchange hashpartitioning(summary_date")[1]
        assert "HashAggregate" not in below
        assert rows(df, "summary_date", "dw_product_id", "product_mrp_amount", "cancelled_product_qty") == rows(
            df.sparkSession.createDataFrame(
                [(d("2024-03-12"), 1, m(120), 0), (d("2024-03-12"), 2, m(960), 0), (d("2024-03-14"), 1, m(0), 4),
                 (d("2024-03-14"), 2, m(0), 16)], "summary_date date, dw_product_id long, product_mrp_amount decimal(38,2), cancelled_product_qty long"),
            "summary_date", "dw_product_id", "product_mrp_amount", "cancelled_product_qty")


def test_recomputed_pairs_move_daily_rows_once(spark):
    spec = M.PRODUCT_ROLLUP
    daily = D.daily_product_summary(*_order_data(spark)[1:4], CTX)
    daily = daily.unionByName(daily.withColumn("dw_product_id", F.lit(None).cast("long")))
    daily = spark.createDataFrame(daily.collect(), daily.schema)
    monthly = M.monthly_insert(spark.createDataFrame([], M.monthly_schema(spec)),
                               daily.where("dw_product_id = 1 or dw_product_id is null"), spec, CTX)
    old = ts("2024-01-01 00:00:00")
    monthly = monthly.withColumn("dw_create_timestamp", F.lit(old).cast("timestamp_ntz"))
    monthly = spark.createDataFrame(monthly.collect(), monthly.schema)
    with _nothing_broadcast(spark):
        df = M.recomputed_pairs(monthly, daily, spec, CTX)
        assert _exchanges(df) == 1
        made = {r["dw_product_id"]: r["dw_create_timestamp"] for r in df.collect()}
        assert made == {1: old, None: old, 2: CTX.run_ts}
        assert M.monthly_recompute(monthly, daily, spec, CTX).count() == 3


def test_large_delta_without_ids_takes_one_join(spark):
    spec = SPECS["orderdetails"]
    new, old = ts("2024-03-12 00:00:00"), ts("2024-01-01 00:00:00")
    target = spark.createDataFrame(
        [(1, "P1", 1, m(1), 1, 5, 6, old, old, 3, d("2024-01-01")), (1, "P2", 1, m(1), 2, 5, 6, old, new, 3, d("2024-01-01")),
         (None, "P3", 1, m(1), 3, None, 6, old, old, 3, d("2024-01-01"))], spec.warehouse_schema())
    stage = spark.createDataFrame(
        [(1, "P1", 9, m(9), 1, old, new), (1, "P1", 8, m(8), 1, old, old), (1, "P2", 9, m(9), 1, old, new),
         (2, "P1", 4, m(4), 1, new, new), (None, "P3", 7, m(7), 1, new, new)], spec.stage_schema())
    parent = spark.createDataFrame([(1, 50), (2, 51), (None, 52)], "src_orderNumber int, dw_order_id long")
    small = resolve_ref(upsert(target, stage, spec, CTX), parent, "src_orderNumber", "src_orderNumber", "dw_order_id", "dw_order_id")
    want = rows(small, *target.columns)
    assert [r[:3] for r in want].count((None, "P3", 7)) == 1
    with _nothing_broadcast(spark):
        df = resolve_ref(upsert(target, stage, spec, CTX), parent, "src_orderNumber", "src_orderNumber", "dw_order_id", "dw_order_id")
        assert "Union" not in _plan(df)
        assert rows(df, *target.columns) == want
    assert df.columns == target.columns and df.dtypes == target.dtypes


def test_events_keep_all_shuffle_partitions(spark):
    # Merged partitions would hold more groups in a task the more is moved.
    c, o, od, p, pa = _order_data(spark)
    n = spark.conf.get("spark.sql.shuffle.partitions")
    for df in (D.daily_product_summary(o, od, p, CTX), D.daily_customer_summary(c, o, od, p, pa, CTX)):
        assert re.search(rf"Exchange hashpartitioning\(summary_date[^\n]*, {n}\), REPARTITION_BY_NUM", _plan(df))
