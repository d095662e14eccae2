from pyspark.sql import functions as F

from tallyhouse.operators.dedupe import latest_per_key
from tallyhouse.operators.surrogate import assign_surrogate_keys
from tallyhouse.operators.upsert import upsert, upsert_inserts, upsert_updates
from tallyhouse.schemas import ORDERS, PAYMENTS, PRODUCTLINES

from helpers import CTX, d, m, rows, ts


def _pl_target(spark, data):
    return spark.createDataFrame(data, PRODUCTLINES.warehouse_schema())


def _pl_stage(spark, data):
    return spark.createDataFrame(data, PRODUCTLINES.stage_schema())


def test_update_only_when_strictly_newer(spark):
    # Q5: newer updates; equal, older and NULL timestamps on either side do not.
    t = _pl_target(spark, [
        (1, "newer", "old", ts("2024-01-01 00:00:00"), ts("2024-02-01 00:00:00"), 1, d("2024-02-01")),
        (2, "equal", "old", ts("2024-01-01 00:00:00"), ts("2024-02-01 00:00:00"), 1, d("2024-02-01")),
        (3, "older", "old", ts("2024-01-01 00:00:00"), ts("2024-02-01 00:00:00"), 1, d("2024-02-01")),
        (4, "tnull", "old", ts("2024-01-01 00:00:00"), None, 1, d("2024-02-01")),
        (5, "snull", "old", ts("2024-01-01 00:00:00"), ts("2024-02-01 00:00:00"), 1, d("2024-02-01")),
        (6, "untouched", "old", ts("2024-01-01 00:00:00"), ts("2024-02-01 00:00:00"), 1, d("2024-02-01")),
    ])
    s = _pl_stage(spark, [
        ("newer", "new", ts("2024-01-01 00:00:00"), ts("2024-03-10 00:00:00")),
        ("equal", "new", ts("2024-01-01 00:00:00"), ts("2024-02-01 00:00:00")),
        ("older", "new", ts("2024-01-01 00:00:00"), ts("2024-01-15 00:00:00")),
        ("tnull", "new", ts("2024-01-01 00:00:00"), ts("2024-03-10 00:00:00")),
        ("snull", "new", ts("2024-01-01 00:00:00"), None),
    ])
    out = upsert_updates(t, s, PRODUCTLINES, CTX)
    got = {r["productLine"]: (r["textDescription"], r["etl_batch_no"]) for r in out.collect()}
    assert got == {"newer": ("new", 7), "equal": ("old", 1), "older": ("old", 1),
                   "tnull": ("old", 1), "snull": ("old", 1), "untouched": ("old", 1)}
    # src_create_timestamp is never touched
    assert {r["src_create_timestamp"] for r in out.collect()} == {ts("2024-01-01 00:00:00")}


def test_insert_new_keys_with_ids_after_max(spark):
    t = _pl_target(spark, [(10, "A", "a", None, None, 1, None), (3, "C", "c", None, None, 1, None)])
    s = _pl_stage(spark, [("D", "d", None, ts("2024-03-10 00:00:00")),
                          ("B", "b", None, ts("2024-03-10 00:00:00")),
                          ("A", "a2", None, ts("2024-03-10 00:00:00"))])
    ins = upsert_inserts(t, s, PRODUCTLINES, CTX)
    assert rows(ins, "dw_product_line_id", "productLine", "etl_batch_no") == [(11, "B", 7), (12, "D", 7)]
    full = upsert(t, s, PRODUCTLINES, CTX)
    keys = [r["productLine"] for r in full.collect()]
    assert sorted(keys) == ["A", "B", "C", "D"]  # key stays unique


def test_duplicate_stage_keys_newest_wins(spark):
    # Q6: one row per key, newest update_timestamp, ties by remaining columns.
    s = _pl_stage(spark, [("X", "first", None, ts("2024-03-10 00:00:00")),
                          ("X", "second", None, ts("2024-03-12 00:00:00")),
                          ("Y", "aaa", None, ts("2024-03-10 00:00:00")),
                          ("Y", "zzz", None, ts("2024-03-10 00:00:00")),
                          ("Z", "nullts", None, None), ("Z", "hasts", None, ts("2024-01-01 00:00:00"))])
    out = latest_per_key(s, ["productLine"], "update_timestamp")
    assert rows(out, "productLine", "textDescription") == [("X", "second"), ("Y", "zzz"), ("Z", "hasts")]


def test_same_delta_twice_changes_nothing(spark):
    t = _pl_target(spark, [(1, "A", "a", None, ts("2024-01-01 00:00:00"), 1, d("2024-01-01"))])
    s = _pl_stage(spark, [("A", "a2", None, ts("2024-03-10 00:00:00")),
                          ("B", "b", None, ts("2024-03-10 00:00:00"))])
    once = upsert(t, s, PRODUCTLINES, CTX)
    twice = upsert(once, s, PRODUCTLINES, CTX)
    cols = once.columns
    assert rows(once, *cols) == rows(twice, *cols)


def test_payments_insert_key_differs_from_update_key(spark):
    # Q7: check number known under another customer: neither inserted nor updated.
    t = spark.createDataFrame([(101, 1, "CHK1", d("2024-01-05"), m(10), ts("2024-01-05 00:00:00"),
                                ts("2024-01-05 00:00:00"), 1, d("2024-01-05"))],
                              "dw_customer_id long, src_customerNumber int, checkNumber string, "
                              "paymentDate date, amount decimal(10,2), src_create_timestamp timestamp_ntz, "
                              "src_update_timestamp timestamp_ntz, etl_batch_no int, etl_batch_date date")
    t = t.select(*[c for c, _ in PAYMENTS.warehouse_columns()])
    s = spark.createDataFrame([(2, "CHK1", d("2024-03-10"), m(99), ts("2024-03-10 00:00:00"), ts("2024-03-10 00:00:00")),
                               (1, "CHK1", d("2024-03-11"), m(11), ts("2024-01-05 00:00:00"), ts("2024-03-10 00:00:00")),
                               (3, "CHK9", d("2024-03-10"), m(5), ts("2024-03-10 00:00:00"), ts("2024-03-10 00:00:00"))],
                              PAYMENTS.stage_schema())
    out = upsert(t, s, PAYMENTS, CTX)
    assert rows(out, "src_customerNumber", "checkNumber", "amount") == [
        (1, "CHK1", m(11)), (3, "CHK9", m(5))]


def test_order_update_keeps_customer(spark):
    # Q8: an update never moves an order to another customer.
    t = spark.createDataFrame([], ORDERS.warehouse_schema())
    base = (1, d("2024-03-01"), None, None, "In Process", None, 5,
            ts("2024-03-01 00:00:00"), ts("2024-03-01 00:00:00"), None)
    t = upsert(t, spark.createDataFrame([base], ORDERS.stage_schema()), ORDERS, CTX)
    moved = (1, d("2024-03-01"), None, None, "Shipped", None, 6,
             ts("2024-03-01 00:00:00"), ts("2024-03-12 00:00:00"), None)
    out = upsert(t, spark.createDataFrame([moved], ORDERS.stage_schema()), ORDERS, CTX)
    assert rows(out, "src_orderNumber", "status", "src_customerNumber") == [(1, "Shipped", 5)]


def test_surrogate_keys_match_global_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).distinct()
    out = assign_surrogate_keys(df, ["k"], "sk", start_after=100, num_partitions=7)
    got = [(r["k"], r["sk"]) for r in out.collect()]
    ordered = sorted(k for k, _ in got)
    assert sorted(got) == [(k, 101 + i) for i, k in enumerate(ordered)]
