"""Daily customer and product summaries.

Original shape: six (customer) or two (product) grouped branches,
zero-padded to one row shape, UNION ALL, then an outer aggregate per
(summary_date, id). Here the four order-line branches share one pass:
lines are joined to orders (and products) once, each order is exploded
into the branch events it qualifies for, and one grouped aggregate
computes all inner groups. Customers (D1) and payments (D5) are their
own small branches. Lines are first added up per order, on the
partitioning of their join; then each event moves once, to its day and
customer (or product), where inner and outer groups are made.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.context import BatchContext
from tallyhouse.functions.columns import norm_text, on_or_after, to_day, zero
from tallyhouse.operators.joins import broadcast_if_measured_small, broadcast_if_small

AMOUNT = T.DecimalType(38, 2)
COUNT = T.LongType()
FLAG = T.IntegerType()

# Daily customer summary columns in table order, with the type each has.
CUSTOMER_MEASURES = (
    ("order_count", COUNT), ("order_apd", FLAG), ("order_cost_amount", AMOUNT),
    ("cancelled_order_count", COUNT), ("cancelled_order_amount", AMOUNT),
    ("cancelled_order_apd", FLAG), ("shipped_order_count", COUNT),
    ("shipped_order_amount", AMOUNT), ("shipped_order_apd", FLAG), ("payment_apd", FLAG),
    ("payment_amount", AMOUNT), ("products_ordered_qty", COUNT),
    ("products_items_qty", COUNT), ("order_mrp_amount", AMOUNT),
    ("new_customer_apd", FLAG), ("new_customer_paid_apd", FLAG),
)
TAIL = (("dw_create_timestamp", T.TimestampNTZType()), ("dw_update_timestamp", T.TimestampNTZType()),
        ("etl_batch_no", T.IntegerType()), ("etl_batch_date", T.DateType()))
CUSTOMER_COLUMNS = (("summary_date", T.DateType()), ("dw_customer_id", T.LongType())) \
    + CUSTOMER_MEASURES + TAIL

# Outer aggregate of the customer summary, column by column, as in the
# original statement (fixed values: which measure is MAX and which SUM).
CUSTOMER_OUTER_MAX = ("order_count", "order_apd", "order_cost_amount", "cancelled_order_count",
                      "cancelled_order_apd", "shipped_order_count", "shipped_order_apd",
                      "payment_apd", "products_ordered_qty", "products_items_qty",
                      "new_customer_paid_apd")
CUSTOMER_OUTER_SUM = ("cancelled_order_amount", "shipped_order_amount", "payment_amount",
                      "order_mrp_amount")
# Measures that 'additive=sum' and 'exact' switch from MAX to SUM.
CUSTOMER_ADDITIVE = ("order_count", "order_cost_amount", "cancelled_order_count",
                     "shipped_order_count", "products_ordered_qty", "products_items_qty")

PRODUCT_MEASURES = (
    ("customer_apd", FLAG), ("product_cost_amount", AMOUNT), ("product_mrp_amount", AMOUNT),
    ("cancelled_product_qty", COUNT), ("cancelled_cost_amount", AMOUNT),
    ("cancelled_mrp_amount", AMOUNT), ("cancelled_order_apd", FLAG),
)
PRODUCT_COLUMNS = (("summary_date", T.DateType()), ("dw_product_id", T.LongType())) \
    + PRODUCT_MEASURES + TAIL

CANCELLED = "CANCELLED"
SHIPPED = "SHIPPED"

ORDERED, CANCEL, SHIP, OPEN, NEW, PAY = "ordered", "cancelled", "shipped", "open", "new", "payment"


def _padded(values: dict, columns=CUSTOMER_COLUMNS) -> list[Column]:
    return [values.get(c, zero(t)).cast(t).alias(c) for c, t in columns]


# ---------------------------------------------------------------- customer

def first_payment(payments: DataFrame) -> DataFrame:
    """First payment date per customer over all history."""
    return payments.groupBy("dw_customer_id").agg(F.min("paymentDate").alias("first_payment_date"))


def new_customers(customers: DataFrame, ctx: BatchContext) -> DataFrame:
    """One zero row per customer created on/after the batch date."""
    c = (customers.where(on_or_after("src_create_timestamp", ctx.date_col(), timestamp=True))
         .select("dw_customer_id", "src_create_timestamp", "src_update_timestamp",
                 "etl_batch_no", "etl_batch_date")
         .distinct())
    return c.select(*_padded({
        "summary_date": to_day("src_create_timestamp"),
        "dw_customer_id": F.col("dw_customer_id"),
        "dw_create_timestamp": F.col("src_create_timestamp"),
        "dw_update_timestamp": F.col("src_update_timestamp"),
        "etl_batch_no": F.col("etl_batch_no"), "etl_batch_date": F.col("etl_batch_date"),
    }))


LINE_BRANCHES = (ORDERED, CANCEL, SHIP, OPEN)


def _line_conditions(b: Column) -> dict[str, tuple[str, Column]]:
    """Date column and order condition of each line branch."""
    return {
        ORDERED: ("orderDate", on_or_after("orderDate", b)),
        CANCEL: ("cancelledDate", on_or_after("cancelledDate", b) & (F.col("_st") == CANCELLED)),
        SHIP: ("shippedDate", on_or_after("shippedDate", b) & (F.col("_st") == SHIPPED)),
        # NOT IN: a NULL status is excluded, as in SQL.
        OPEN: ("orderDate", on_or_after("orderDate", b) & ~F.col("_st").isin(CANCELLED, SHIPPED)),
    }


def _spread_null(key: str, other: str) -> Column:
    """A join key whose NULLs, which match nothing, do not meet in one
    partition. Surrogate ids are positive."""
    return F.coalesce(F.col(key), -1 - F.pmod(F.xxhash64(other), F.lit(4096)))


def _parts(df: DataFrame) -> int:
    """All shuffle partitions of the session: events are grouped where they
    arrive, so merged partitions would hold that many more groups a task."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _order_lines(orders: DataFrame, orderdetails: DataFrame, products: DataFrame,
                 ctx: BatchContext, branches: tuple[str, ...] = LINE_BRANCHES) -> DataFrame:
    """One row per order and batch of its lines, with what the branches add
    up: all lines, and for the 'ordered' branch those of a known product.

    Joins on surrogate ids: lines to orders inner, products left (only the
    'ordered' branch requires a product, as its inner join does, so other
    branches alone do without). A branch and its day depend on the order
    alone, so lines are added up where the join left them, on the
    partitioning of the order id.
    """
    any_branch = reduce(lambda x, y: x | y, [c for k, (_, c) in _line_conditions(ctx.date_col()).items() if k in branches])
    o = orders.select(F.col("dw_order_id").alias("_o_id"), "dw_customer_id", "orderDate",
                      "cancelledDate", "shippedDate", norm_text("status").alias("_st"),
                      F.col("src_create_timestamp").alias("_o_cts"),
                      F.col("src_update_timestamp").alias("_o_uts"))
    # Orders with a branch on/after the batch date: a small slice of the
    # history, broadcast once measured so order lines are not shuffled.
    o = broadcast_if_measured_small(o.where(any_branch), "batch_orders")
    order = o.columns
    od = orderdetails.select("dw_order_id", "dw_product_id", "quantityOrdered", "priceEach",
                             "etl_batch_no", "etl_batch_date")
    lines = od.join(o, F.col("dw_order_id") == F.col("_o_id"), "inner")
    q = F.col("quantityOrdered")
    aggs = [F.sum(q).alias("_q"), F.sum(F.col("priceEach") * q).alias("_a")]
    if ORDERED in branches:
        p = broadcast_if_small(products.select(F.col("dw_product_id").alias("_p_id"), "MSRP")
                               .where(F.col("_p_id").isNotNull()))
        lines = lines.join(p, _spread_null("dw_product_id", "dw_order_id") == F.col("_p_id"), "left")
        known = F.col("_p_id").isNotNull()
        aggs += [F.collect_set(F.when(known, F.col("dw_product_id"))).alias("_products"),
                 F.sum(F.when(known, q)).alias("_pq"), F.sum(F.when(known, q * F.col("MSRP"))).alias("_pa")]
    return lines.groupBy(*order, "etl_batch_no", "etl_batch_date").agg(*aggs)


def _line_events(orders: DataFrame, orderdetails: DataFrame, products: DataFrame,
                 ctx: BatchContext, branches: tuple[str, ...] = LINE_BRANCHES) -> DataFrame:
    """(branch, summary_date) events of every order and batch: the items a
    branch counts (products or the order), their quantity and amount."""
    conditions = {k: v for k, v in _line_conditions(ctx.date_col()).items() if k in branches}
    lines = _order_lines(orders, orderdetails, products, ctx, branches)

    def event(name):
        day, cond = conditions[name]
        items, qty, total = F.array("_o_id"), "_q", "_a"
        if name == ORDERED:
            items, qty, total = F.col("_products"), "_pq", "_pa"
            cond = cond & (F.size("_products") > 0)
        return F.when(cond, F.struct(F.lit(name).alias("br"), F.col(day).cast("date").alias("day"), items.alias("items"),
                                     F.col(qty).alias("q"), F.col(total).cast(AMOUNT).alias("a")))

    keys = ("dw_customer_id", "_o_cts", "_o_uts", "etl_batch_no", "etl_batch_date")
    return lines.select(*keys, F.explode(F.array(*[event(k) for k in conditions])).alias("_ev")) \
        .where(F.col("_ev").isNotNull()) \
        .select(F.col("_ev.br").alias("br"), F.col("_ev.day").alias("summary_date"), *keys,
                F.col("_ev.items").alias("_items"), F.col("_ev.q").alias("_q"), F.col("_ev.a").alias("_a"))


def _as_events(name: str, rows: DataFrame, quantity: str, amount: str) -> DataFrame:
    """Padded rows of a branch without lines in the columns of line events."""
    return rows.select(F.lit(name).alias("br"), "summary_date", "dw_customer_id",
                       F.col("dw_create_timestamp").alias("_o_cts"), F.col("dw_update_timestamp").alias("_o_uts"),
                       "etl_batch_no", "etl_batch_date", F.array(F.lit(0).cast("long")).alias("_items"),
                       F.col(quantity).cast("long").alias("_q"), F.col(amount).alias("_a"))


def _inner_groups(ev: DataFrame, exact: bool = False) -> DataFrame:
    """Inner groups of events, zero-padded. ``exact`` groups by branch, day
    and customer alone, so that an order whose lines were loaded by several
    batches counts once.

    Events move once, to their day and customer: inner groups, the distinct
    counts within them and the outer groups are all made there. Items of one
    inner group (a day's orders of a customer, or their products) are held
    together to be counted."""
    ev = ev.repartition(_parts(ev), "summary_date", "dw_customer_id")
    inner = ["_o_cts", "_o_uts", "etl_batch_no", "etl_batch_date"]
    keys = ["br", "summary_date", "dw_customer_id"]
    g = ev.groupBy(*keys, *([] if exact else inner)) \
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("_n"), F.sum("_q").alias("_q"),
             F.sum("_a").alias("_a"), *([F.max(c).alias(c) for c in inner] if exact else []))
    br = F.col("br")

    def on(name, col):
        return F.when(br == name, col).otherwise(F.lit(0))

    return g.select("br", *_padded({
        "summary_date": F.col("summary_date"), "dw_customer_id": F.col("dw_customer_id"),
        "order_count": on(OPEN, F.col("_n")), "order_apd": on(OPEN, F.lit(1)),
        "order_cost_amount": on(OPEN, F.col("_a")),
        "cancelled_order_count": on(CANCEL, F.col("_n")),
        "cancelled_order_amount": on(CANCEL, F.col("_a")),
        "cancelled_order_apd": on(CANCEL, F.lit(1)),
        "shipped_order_count": on(SHIP, F.col("_n")),
        "shipped_order_amount": on(SHIP, F.col("_a")),
        "shipped_order_apd": on(SHIP, F.lit(1)),
        "products_ordered_qty": on(ORDERED, F.col("_n")),
        "products_items_qty": on(ORDERED, F.col("_q")),
        "order_mrp_amount": on(ORDERED, F.col("_a")),
        "payment_apd": on(PAY, F.lit(1)), "payment_amount": on(PAY, F.col("_a")),
        "new_customer_paid_apd": on(PAY, F.when(F.col("_q") > 0, 1).otherwise(0)),
        "dw_create_timestamp": F.col("_o_cts"), "dw_update_timestamp": F.col("_o_uts"),
        "etl_batch_no": F.col("etl_batch_no"), "etl_batch_date": F.col("etl_batch_date"),
    }))


def line_branch(name: str, orders, orderdetails, products, ctx) -> DataFrame:
    """D2 (ordered), D3 (cancelled), D4 (shipped), D6 (open): padded rows."""
    return _inner_groups(_line_events(orders, orderdetails, products, ctx, (name,))).drop("br")


def payment_branch(payments: DataFrame, ctx: BatchContext, first: DataFrame | None = None) -> DataFrame:
    """Payments on/after the batch date joined to D0 (inner). Only the
    history of customers who pay in this batch is aggregated; with ``first``
    (the kept result of D0) none is read."""
    p = payments.where(on_or_after("paymentDate", ctx.date_col()) & F.col("dw_customer_id").isNotNull())
    if first is not None:
        fp = broadcast_if_small(first)
    else:
        payers = broadcast_if_measured_small(p.select("dw_customer_id").distinct(), "payers")
        fp = broadcast_if_small(first_payment(payments.join(payers, "dw_customer_id", "left_semi")))
    g = p.join(fp, "dw_customer_id", "inner") \
        .groupBy("paymentDate", "dw_customer_id", "first_payment_date", "src_create_timestamp",
                 "src_update_timestamp", "etl_batch_no", "etl_batch_date") \
        .agg(F.sum("amount").alias("_a"))
    return g.select(*_padded({
        "summary_date": F.col("paymentDate"), "dw_customer_id": F.col("dw_customer_id"),
        "payment_apd": F.lit(1), "payment_amount": F.col("_a"),
        "new_customer_paid_apd": F.when(F.col("first_payment_date") == F.col("paymentDate"), 1)
                                  .otherwise(0),
        "dw_create_timestamp": F.col("src_create_timestamp"),
        "dw_update_timestamp": F.col("src_update_timestamp"),
        "etl_batch_no": F.col("etl_batch_no"), "etl_batch_date": F.col("etl_batch_date"),
    }))


def daily_customer_summary(customers: DataFrame, orders: DataFrame, orderdetails: DataFrame,
                           products: DataFrame, payments: DataFrame, ctx: BatchContext,
                           additive: str = "reference", new_customer: str = "reference",
                           first: DataFrame | None = None) -> DataFrame:
    """Rows appended to daily_customer_summary for this batch.

    ``additive='reference'`` keeps MAX for counts, cost and quantities
    (several inner rows per day and customer then under-report them);
    ``'sum'`` adds them up, which counts an order or product once for each
    of its inner rows; ``'exact'`` adds amounts and quantities and counts
    every order and product of a day and customer once. ``new_customer='reference'`` flags a day equal
    to the date of the newest create timestamp of any branch;
    ``'customers_only'`` flags only days with a customer-created row.
    ``first`` are first payment dates kept by earlier batches; ``payments``
    then need not go back before the batch date.
    """
    events = _line_events(orders, orderdetails, products, ctx)
    new = _as_events(NEW, new_customers(customers, ctx), "payment_apd", "payment_amount")
    pay = _as_events(PAY, payment_branch(payments, ctx, first), "new_customer_paid_apd", "payment_amount")
    u = _inner_groups(events.unionByName(new).unionByName(pay), exact=additive == "exact")
    aggs = []
    for c, t in CUSTOMER_MEASURES:
        if c == "new_customer_apd":
            if new_customer == "reference":
                e = F.when(F.col("summary_date") == to_day(F.max("dw_create_timestamp")), 1).otherwise(0)
            else:
                e = F.max(F.when(F.col("br") == NEW, 1).otherwise(0))
        elif c in CUSTOMER_OUTER_SUM or (additive in ("sum", "exact") and c in CUSTOMER_ADDITIVE):
            e = F.sum(c)
        else:
            e = F.max(c)
        aggs.append(e.cast(t).alias(c))
    aggs += [ctx.run_ts_col().alias("dw_create_timestamp"),
             ctx.run_ts_col().alias("dw_update_timestamp"),
             F.max("etl_batch_no").alias("etl_batch_no"),
             F.max("etl_batch_date").alias("etl_batch_date")]
    return u.groupBy("summary_date", "dw_customer_id").agg(*aggs) \
        .select(*[c for c, _ in CUSTOMER_COLUMNS])


# ----------------------------------------------------------------- product

def _product_events(orders: DataFrame, orderdetails: DataFrame, products: DataFrame,
                    ctx: BatchContext, branches: tuple[str, ...] = (ORDERED, CANCEL)) -> DataFrame:
    """Lines joined on source keys, exploded into the events of ``branches``."""
    # Cancelled orders are part of the 'ordered' amounts too.
    conditions = {k: v for k, v in _line_conditions(ctx.date_col()).items() if k in branches}
    o = broadcast_if_measured_small(
        orders.select(F.col("src_orderNumber").alias("_o_no"), "orderDate", "cancelledDate", "shippedDate",
                      norm_text("status").alias("_st"))
        .where(reduce(lambda x, y: x | y, [c for _, c in conditions.values()])), "batch_orders")
    p = broadcast_if_small(products.select(F.col("src_productCode").alias("_p_code"), "MSRP")
                           .where(F.col("_p_code").isNotNull()))
    od = orderdetails.select("src_orderNumber", "src_productCode", "dw_product_id",
                             "quantityOrdered", "priceEach")
    lines = (od.join(o, F.col("src_orderNumber") == F.col("_o_no"), "inner")
             .join(p, F.col("src_productCode") == F.col("_p_code"), "inner"))

    events = F.array(*[F.when(cond, F.struct(F.lit(name).alias("br"), F.col(day).cast("date").alias("day")))
                       for name, (day, cond) in conditions.items()])
    # An event is moved as it is, to its day and product: it is narrower than
    # the sums of the measures, and nearly every pair has one line only.
    return (lines.select("*", F.explode(events).alias("_ev")).where(F.col("_ev").isNotNull())
            .select(F.col("_ev.br").alias("br"), F.col("_ev.day").alias("summary_date"), "dw_product_id",
                    "quantityOrdered", "priceEach", "MSRP")
            .repartition(_parts(lines), "summary_date", "dw_product_id"))


def _product_values(br: Column) -> dict:
    cost = F.col("quantityOrdered") * F.col("priceEach")
    mrp = F.col("quantityOrdered") * F.col("MSRP")
    o, c = br == ORDERED, br == CANCEL
    return {
        "customer_apd": F.lit(1),
        "product_cost_amount": F.when(o, cost).otherwise(0),
        "product_mrp_amount": F.when(o, mrp).otherwise(0),
        "cancelled_product_qty": F.when(c, F.col("quantityOrdered")).otherwise(0),
        "cancelled_cost_amount": F.when(c, cost).otherwise(0),
        "cancelled_mrp_amount": F.when(c, mrp).otherwise(0),
        "cancelled_order_apd": F.when(c, 1).otherwise(0),
    }


def product_branch(name: str, orders, orderdetails, products, ctx) -> DataFrame:
    """P1 ('ordered') / P2 ('cancelled'): inner groups, zero-padded."""
    ev = _product_events(orders, orderdetails, products, ctx, (name,))
    vals = _product_values(F.col("br"))
    aggs = [(F.max(vals[c]) if c in ("customer_apd", "cancelled_order_apd") else F.sum(vals[c]))
            .cast(t).alias(c) for c, t in PRODUCT_MEASURES]
    return ev.groupBy("summary_date", "dw_product_id").agg(*aggs)


def daily_product_summary(orders: DataFrame, orderdetails: DataFrame, products: DataFrame,
                          ctx: BatchContext) -> DataFrame:
    """One pass. The outer SUM of branch SUMs is a SUM over all
    events and the outer MAX of flags a MAX, so a single grouped aggregate
    gives the same rows. Batch columns are the current batch literals."""
    ev = _product_events(orders, orderdetails, products, ctx)
    vals = _product_values(F.col("br"))
    aggs = [(F.max(vals[c]) if c in ("customer_apd", "cancelled_order_apd") else F.sum(vals[c]))
            .cast(t).alias(c) for c, t in PRODUCT_MEASURES]
    aggs += [ctx.run_ts_col().alias("dw_create_timestamp"),
             ctx.run_ts_col().alias("dw_update_timestamp"),
             ctx.no_col().alias("etl_batch_no"), ctx.date_col().alias("etl_batch_date")]
    return ev.groupBy("summary_date", "dw_product_id").agg(*aggs)
