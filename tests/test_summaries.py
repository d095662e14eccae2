from pyspark.sql import functions as F

from tallyhouse.operators import daily as D
from tallyhouse.operators import monthly as M
from tallyhouse.operators.daily import daily_customer_summary, daily_product_summary

from helpers import CTX, d, m, rows, ts

ORD = ("dw_order_id long, dw_customer_id long, src_orderNumber int, orderDate date, shippedDate date, "
       "cancelledDate date, status string, src_create_timestamp timestamp_ntz, src_update_timestamp timestamp_ntz")
OD = ("dw_order_id long, dw_product_id long, src_orderNumber int, src_productCode string, "
      "quantityOrdered int, priceEach decimal(10,2), etl_batch_no int, etl_batch_date date")
PR = "dw_product_id long, src_productCode string, MSRP decimal(10,2)"
CU = ("dw_customer_id long, src_create_timestamp timestamp_ntz, src_update_timestamp timestamp_ntz, "
      "etl_batch_no int, etl_batch_date date")
PA = ("dw_customer_id long, paymentDate date, amount decimal(10,2), src_create_timestamp timestamp_ntz, "
      "src_update_timestamp timestamp_ntz, etl_batch_no int, etl_batch_date date")


def _inputs(spark, orders, lines, customers=(), payments=()):
    return (spark.createDataFrame(list(customers), CU), spark.createDataFrame(orders, ORD),
            spark.createDataFrame(lines, OD),
            spark.createDataFrame([(1, "P1", m(10)), (2, "P2", m(20))], PR),
            spark.createDataFrame(list(payments), PA))


def test_same_day_orders_max_vs_sum(spark):
    # Q15: two open orders of one customer on one day with different create
    # timestamps form two inner rows; 'reference' keeps MAX, 'sum' adds.
    orders = [(1, 9, 1, d("2024-03-12"), None, None, "In Process", ts("2024-03-12 01:00:00"), ts("2024-03-12 01:00:00")),
              (2, 9, 2, d("2024-03-12"), None, None, "In Process", ts("2024-03-12 02:00:00"), ts("2024-03-12 02:00:00"))]
    lines = [(1, 1, 1, "P1", 2, m(5), 7, d("2024-03-10")), (2, 2, 2, "P2", 3, m(4), 7, d("2024-03-10"))]
    c, o, od, p, pa = _inputs(spark, orders, lines)
    ref = daily_customer_summary(c, o, od, p, pa, CTX).collect()[0]
    assert (ref["order_count"], ref["order_cost_amount"], ref["products_items_qty"]) == (1, m(12), 3)
    add = daily_customer_summary(c, o, od, p, pa, CTX, additive="sum").collect()[0]
    assert (add["order_count"], add["order_cost_amount"], add["products_items_qty"]) == (2, m(22), 5)
    assert ref["order_mrp_amount"] == m(80)  # SUM in both modes


def test_exact_counts_equal_direct_distinct_counts(spark):
    # Q15: lines of one order loaded by several batches make several inner
    # rows: 'sum' counts the order in each of them, 'exact' once.
    import random
    from collections import defaultdict
    rng = random.Random(15)
    day = lambda k: d(f"2024-03-{11 + k % 3}")
    states = ["In Process", "Shipped", "cancelled", None, "On Hold"]
    orders = [(i, rng.choice([1, 2, 3, None]), i, day(i), day(i + 1), day(i + 2), rng.choice(states),
               ts(f"2024-03-0{1 + rng.randrange(3)} 01:00:00"), ts("2024-03-09 01:00:00")) for i in range(1, 41)]
    lines = [(rng.randrange(1, 44), rng.randrange(1, 4), 0, "P", rng.randrange(1, 5), m(rng.randrange(1, 9)),
              rng.randrange(5, 9), d("2024-03-10")) for _ in range(300)]
    c, o, od, p, pa = _inputs(spark, orders, lines)
    want, groups, plus = defaultdict(set), defaultdict(set), defaultdict(int)
    by_id = {x[0]: x for x in orders}
    for line in lines:
        x = by_id.get(line[0])
        if x is None:
            continue
        state = None if x[6] is None else x[6].strip().upper()
        hits = [("cancelled_order_count", x[5], line[0])] if state == "CANCELLED" else [
            ("shipped_order_count", x[4], line[0])] if state == "SHIPPED" else [("order_count", x[3], line[0])] if state else []
        if line[1] < 3:  # the products that exist
            hits.append(("products_ordered_qty", x[3], line[1]))
        for measure, at, item in hits:
            want[at, x[1], measure].add(item)
            groups[at, x[1], measure].add((item, x[7], line[6]))
        plus[x[3], x[1]] += line[4] * (line[1] < 3)
    out = {}
    for mode in ("exact", "sum"):
        got = daily_customer_summary(c, o, od, p, pa, CTX, additive=mode).collect()
        out[mode] = {(r["summary_date"], r["dw_customer_id"], k): r[k] for r in got for k in (
            "order_count", "cancelled_order_count", "shipped_order_count", "products_ordered_qty") if r[k]}
        assert {(r["summary_date"], r["dw_customer_id"]): r["products_items_qty"] for r in got if r["products_items_qty"]} == {
            k: v for k, v in plus.items() if v}
    assert out["exact"] == {k: len(v) for k, v in want.items()}
    assert any(out["sum"][k] > v for k, v in out["exact"].items())


def test_new_customer_flag_and_status_forms(spark):
    # Q16: an order created on its order day sets new_customer_apd in
    # 'reference' mode; 'customers_only' only flags customer-created days.
    # UPPER(TRIM()) matches ' Shipped'/'CANCELLED '; tab, '' and NULL
    # status do not match; NULL is not an open order, '' is.
    orders = [(1, 1, 1, d("2024-03-12"), d("2024-03-13"), None, " Shipped", ts("2024-03-12 00:00:00"), None),
              (2, 2, 2, d("2024-03-12"), None, d("2024-03-14"), "CANCELLED ", ts("2024-03-01 00:00:00"), None),
              (3, 3, 3, d("2024-03-12"), d("2024-03-13"), None, "\tshipped", ts("2024-03-01 00:00:00"), None),
              (4, 4, 4, d("2024-03-12"), None, None, None, ts("2024-03-01 00:00:00"), None),
              (5, 5, 5, d("2024-03-12"), None, None, "", ts("2024-03-01 00:00:00"), None)]
    lines = [(i, 1, i, "P1", 1, m(10), 7, d("2024-03-10")) for i in range(1, 6)]
    c, o, od, p, pa = _inputs(spark, orders, lines)
    out = daily_customer_summary(c, o, od, p, pa, CTX)
    got = {(r["dw_customer_id"], str(r["summary_date"])): r for r in out.collect()}
    assert got[(1, "2024-03-12")]["new_customer_apd"] == 1
    assert got[(1, "2024-03-13")]["shipped_order_apd"] == 1
    assert got[(2, "2024-03-14")]["cancelled_order_count"] == 1
    assert got[(3, "2024-03-12")]["order_apd"] == 1      # tab kept: treated as open
    assert (3, "2024-03-13") not in got                  # and not as shipped
    assert got[(4, "2024-03-12")]["order_apd"] == 0      # NULL status: not open
    assert got[(5, "2024-03-12")]["order_apd"] == 1      # '' status: open
    only = daily_customer_summary(c, o, od, p, pa, CTX, new_customer="customers_only")
    assert only.where("new_customer_apd = 1").count() == 0


def test_product_summary_counts_cancelled_as_ordered(spark):
    # Q19: a cancelled order's lines appear in the ordered amounts too.
    orders = [(1, 1, 1, d("2024-03-12"), None, d("2024-03-12"), "Cancelled", None, None)]
    lines = [(1, 1, 1, "P1", 2, m(3), 7, d("2024-03-10"))]
    _, o, od, p, _ = _inputs(spark, orders, lines)
    r = daily_product_summary(o, od, p, CTX).collect()[0]
    assert (r["product_cost_amount"], r["cancelled_cost_amount"], r["cancelled_product_qty"],
            r["customer_apd"], r["cancelled_order_apd"], r["etl_batch_no"]) == (m(6), m(6), 2, 1, 1, 7)


def test_payments_branch_first_payment(spark):
    pays = [(1, d("2024-02-01"), m(5), None, None, 6, d("2024-02-01")),
            (1, d("2024-03-12"), m(7), None, None, 7, d("2024-03-10")),
            (2, d("2024-03-12"), m(9), None, None, 7, d("2024-03-10")),
            (None, d("2024-03-12"), m(1), None, None, 7, d("2024-03-10"))]
    c, o, od, p, pa = _inputs(spark, [], [], payments=pays)
    out = rows(daily_customer_summary(c, o, od, p, pa, CTX), "dw_customer_id", "payment_amount",
               "new_customer_paid_apd")
    assert out == [(1, m(7), 0), (2, m(9), 1)]


def _daily(spark, data):
    schema = ", ".join(f"{c} {t.simpleString()}" for c, t in D.PRODUCT_COLUMNS)
    return spark.createDataFrame(data, schema)


def _drow(day, pid, cost, apd=1, no=7):
    return (d(day), pid, 1, cost, m(0), 0, m(0), m(0), apd, None, None, no, d("2024-03-10"))


def test_monthly_multi_match_fresh_null(spark):
    # Q20: several daily rows for one existing key are pre-aggregated;
    # Q22: fresh pairs are inserted from all their daily rows;
    # Q24: a NULL delta makes the sum NULL; Q28: NULL ids insert again.
    spec = M.PRODUCT_ROLLUP
    mon = spark.createDataFrame(
        [(d("2024-03-01"), 1, 1, 1, m(100), m(0), 0, m(0), m(0), 0, 0, None, None, 6, d("2024-03-01")),
         (d("2024-03-01"), 2, 1, 1, m(100), m(0), 0, m(0), m(0), 0, 0, None, None, 6, d("2024-03-01")),
         (d("2024-03-01"), None, 1, 1, m(1), m(0), 0, m(0), m(0), 0, 0, None, None, 6, d("2024-03-01"))],
        M.monthly_schema(spec))
    daily = _daily(spark, [_drow("2024-03-10", 1, m(1), apd=0), _drow("2024-03-11", 1, m(2), apd=1),
                           _drow("2024-03-12", 1, m(3)), _drow("2024-03-10", 2, None),
                           _drow("2024-03-05", 3, m(4)), _drow("2024-03-10", 3, m(5)),
                           _drow("2024-03-10", None, m(6))])
    upd = {r["dw_product_id"]: r for r in M.monthly_update(mon, daily, spec, CTX).collect()}
    assert upd[1]["product_cost_amount"] == m(106) and upd[1]["cancelled_order_apm"] == 1
    assert upd[2]["product_cost_amount"] is None
    assert upd[None]["product_cost_amount"] == m(1)
    ins = rows(M.monthly_insert(mon, daily, spec, CTX), "dw_product_id", "product_cost_amount")
    assert ins == [(3, m(9)), (None, m(6))]
    safe = M.monthly_insert(mon, daily, spec, CTX, null_safe_keys=True)
    assert rows(safe, "dw_product_id") == [(3,)]


def test_monthly_recompute_equals_aggregate(spark):
    spec = M.PRODUCT_ROLLUP
    daily = _daily(spark, [_drow("2024-03-05", 1, m(4)), _drow("2024-03-10", 1, m(5)),
                           _drow("2024-02-10", 2, m(7))])
    empty = spark.createDataFrame([], M.monthly_schema(spec))
    first = M.monthly_rollup(empty, daily, spec, CTX)
    again = M.monthly_rollup(first, daily, spec, CTX, mode="recompute")
    again2 = M.monthly_rollup(again, daily, spec, CTX, mode="recompute")
    want = [(d("2024-02-01"), 2, m(7)), (d("2024-03-01"), 1, m(9))]
    for df in (first, again, again2):
        assert rows(df, M.MONTH, "dw_product_id", "product_cost_amount") == want
    doubled = M.monthly_rollup(first, daily, spec, CTX)  # Q23: incremental rerun double-adds
    assert rows(doubled.where(F.col("dw_product_id") == 1), "product_cost_amount") == [(m(14),)]


def test_batch_stamps_and_late_orders(spark):
    # Q27: the customer summary's batch columns come from the data (an
    # older line batch stays older); the product summary stamps the
    # running batch. Q18: an order dated before the batch date is never
    # counted, and appending the same batch twice duplicates its rows.
    orders = [(1, 1, 1, d("2024-03-12"), None, d("2024-03-12"), "Cancelled", ts("2024-03-01 00:00:00"), None),
              (2, 1, 2, d("2024-03-09"), None, None, "In Process", ts("2024-03-09 00:00:00"), None)]
    lines = [(1, 1, 1, "P1", 2, m(3), 4, d("2024-02-01")), (2, 1, 2, "P1", 1, m(3), 7, d("2024-03-10"))]
    c, o, od, p, pa = _inputs(spark, orders, lines)
    cs = daily_customer_summary(c, o, od, p, pa, CTX)
    assert rows(cs, "summary_date", "etl_batch_no", "etl_batch_date") == [(d("2024-03-12"), 4, d("2024-02-01"))]
    ps = daily_product_summary(o, od, p, CTX)
    assert rows(ps, "summary_date", "etl_batch_no") == [(d("2024-03-12"), 7)]
    assert cs.unionByName(cs).count() == 2 * cs.count()


def test_monthly_recompute_from_an_empty_table_equals_aggregate(spark):
    # Touched and absent pairs: whatever the monthly table held, afterwards
    # it is the aggregate of the daily rows; create times of known pairs stay.
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st
    from pyspark.sql import types as T
    from tallyhouse.operators import monthly as M
    from tallyhouse.operators.daily import PRODUCT_COLUMNS
    schema = T.StructType([T.StructField(c, t, True) for c, t in PRODUCT_COLUMNS])
    spec = M.PRODUCT_ROLLUP

    def row(day, pid, qty):
        vals = {"summary_date": d(day), "dw_product_id": pid, "cancelled_product_qty": qty}
        return tuple(vals.get(c) for c, _ in PRODUCT_COLUMNS)

    days = ["2024-01-05", "2024-02-01", "2024-03-09", "2024-03-10", "2024-03-20", "2024-04-01"]

    @settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(st.sampled_from(days), st.sampled_from([1, 2, None]), st.integers(0, 5)), max_size=12),
           st.sets(st.tuples(st.sampled_from(["2024-01-01", "2024-03-01"]), st.sampled_from([1, 2, None])), max_size=3))
    def check(rows_, known):
        daily = spark.createDataFrame([row(*r) for r in rows_], schema)
        old = ts("2020-01-01 00:00:00")
        held = [tuple({M.MONTH: d(m_), "dw_product_id": p, "cancelled_product_qty": -1, "dw_create_timestamp": old}.get(c)
                      for c, _ in spec.columns) for m_, p in known]
        monthly = spark.createDataFrame(held, M.monthly_schema(spec))
        out = {(str(r[M.MONTH]), r["dw_product_id"]): r for r in M.monthly_recompute(monthly, daily, spec, CTX).collect()}
        want = {}
        for day, p, q in rows_:
            want.setdefault((day[:7] + "-01", p), []).append((day, q))
        touched = {k for k, v in want.items() if any(day >= "2024-03-10" for day, _ in v)}
        assert set(out) == set(want) | known
        for k, r in out.items():
            if k in touched or k not in known:
                assert r["cancelled_product_qty"] == sum(q for _, q in want[k])
            else:
                assert r["cancelled_product_qty"] == -1
            assert (r["dw_create_timestamp"] == old) == (k in known)

    check()
