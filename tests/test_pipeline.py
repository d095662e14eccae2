"""End to end: the batch pipeline over CSV deltas and the versioned store
gives the same tables as the registered (oracle-checked) queries."""

import dataclasses

from pyspark.sql import functions as F

from tallyhouse.operators import monthly as M
from tallyhouse.operators.scd2 import scd2
from tallyhouse.plans.retail import BatchLog, BatchOptions, extract_deltas, run_batch
from tallyhouse.plans.testbed import PRIOR_CTX, Testbed
from tallyhouse.schemas import LOAD_ORDER, SPECS
from tallyhouse.sources.store import TableStore

SF = "/root/testdata/sf0.001"


def _same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert b.select(*cols).exceptAll(a.select(*cols)).count() == 0


def test_batch_matches_registered_queries(spark, scratch):
    tb = Testbed(spark, SF)
    store = TableStore(spark, f"{scratch}/wh")
    for name in LOAD_ORDER:
        store.publish(name, store.write(name, tb.prior(name)))
    for h, dim in (("customer_history", "customers"), ("product_history", "products")):
        store.publish(h, store.write(h, tb.prior_history(dim)))
    for kind, table in (("customer", "daily_customer_summary"), ("product", "daily_product_summary")):
        daily, monthly = tb.daily_tables(kind)
        earlier = daily.where(F.col("summary_date") < tb.ctx.date_col())
        store.publish(table, store.write(table, earlier))
        mtable = f"monthly_{kind}_summary"
        store.publish(mtable, store.write(mtable, monthly))
    stage_root = f"{scratch}/stage"
    # staged as Parquet: CSV cannot tell an empty status from none
    extract_deltas({n: tb.source(n) for n in LOAD_ORDER}, stage_root, tb.ctx, "parquet")

    opts = BatchOptions(empty_text="null", stage_format="parquet")
    state = run_batch(spark, store, tb.ctx, stage_root, opts, clock=lambda: tb.ctx.run_ts)
    assert [tuple(r)[:3] for r in state.collect()] == [(49, tb.ctx.batch_date, "C")]

    for name, attr in (("offices", "wh_offices"), ("employees", "wh_employees"),
                       ("customers", "wh_customers"), ("products", "wh_products"),
                       ("orders", "wh_orders"), ("orderdetails", "wh_orderdetails"),
                       ("payments", "wh_payments")):
        _same(store.read(name), getattr(tb, attr))
        keys = [SPECS[name].wh(k) for k in SPECS[name].update_keys]
        assert store.read(name).groupBy(*keys).count().where("count > 1").count() == 0
    _same(store.read("customer_history"),
          scd2(tb.prior_history("customers"), tb.mat("wh_customers"), "dw_customer_id", "creditLimit", tb.ctx))
    parts = store.head().tables["daily_customer_summary"]
    new_daily = store.load(tuple(p for p in parts if p.value is not None), store.read("daily_customer_summary").schema)
    _same(new_daily, tb.daily_customer())
    daily, monthly = tb.daily_tables("customer")
    _same(store.read("monthly_customer_summary"),
          M.monthly_rollup(monthly, daily, M.CUSTOMER_ROLLUP, tb.ctx))

    # A second batch over the same sources: the SCD1 tables do not change
    # (equal timestamps never update, known keys never insert).
    before = {n: store.read(n).drop("etl_batch_no", "etl_batch_date") for n in ("customers", "orders")}
    ctx2 = dataclasses.replace(tb.ctx, batch_no=50)
    extract_deltas({n: tb.source(n) for n in LOAD_ORDER}, f"{scratch}/stage2", ctx2)
    state2 = run_batch(spark, store, ctx2, f"{scratch}/stage2",
                       BatchOptions(monthly_mode="recompute", empty_text="null"), clock=lambda: ctx2.run_ts)
    assert {r["etl_batch_no"]: r["etl_batch_status"] for r in state2.collect()} == {49: "C", 50: "C"}
    for n, df in before.items():
        _same(store.read(n).drop("etl_batch_no", "etl_batch_date"), df)
    assert store.read("customer_history").where("dw_active_record_ind = 1") \
        .groupBy("dw_customer_id").count().where("count > 1").count() == 0


def test_failed_batch_logs_f_and_does_not_publish(spark, scratch):
    # Q25: the first error stops the batch, logs 'F', raises; Q30: nothing
    # destructive happened, the published version is unchanged.
    import os
    import pytest
    from tallyhouse.sources.csv_stage import delta_path
    tb = Testbed(spark, SF)
    store = TableStore(spark, f"{scratch}/wh")
    store.publish("customers", store.write("customers", tb.prior("customers")))
    before = store.head()
    path = delta_path(f"{scratch}/stage", "customers", tb.ctx.batch_date)
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w") as f:
        f.write(",".join(SPECS["customers"].source_names) + "\n")
        f.write("not-a-number,x,,,,,,,,,,1,10.00,2024-01-01 00:00:00,2024-01-01 00:00:00\n")
    with pytest.raises(Exception):
        run_batch(spark, store, tb.ctx, f"{scratch}/stage", BatchOptions(tables=("customers",)),
                  clock=lambda: tb.ctx.run_ts)
    events = [r["event"] for r in BatchLog(store).events().orderBy("seq").collect()]
    assert events == ["R", "F"]
    assert store.head() == before
