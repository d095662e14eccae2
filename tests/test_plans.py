"""Plan shape checks: pushdown, pruning and size-checked broadcasts."""

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.refs import resolve_ref
from tallyhouse.operators.upsert import upsert_updates
from tallyhouse.schemas import PRODUCTLINES
from tallyhouse.sources.csv_stage import read_stage, write_delta_csv
from tallyhouse.sources.extract import delta_extract

from helpers import CTX, ts


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_delta_extract_pushes_watermark_and_prunes(spark, scratch):
    src = spark.range(1000).select(
        F.col("id").cast("int").alias("productLine"), F.lit("x").alias("textDescription"),
        F.lit("unused").alias("wide_column"),
        F.lit(ts("2024-01-01 00:00:00")).cast("timestamp_ntz").alias("create_timestamp"),
        (F.lit(ts("2024-03-01 00:00:00")).cast("timestamp_ntz") + F.make_interval(days=F.col("id").cast("int") % 20))
        .alias("update_timestamp"))
    src.write.parquet(f"{scratch}/src")
    df = delta_extract(spark.read.parquet(f"{scratch}/src"),
                       ["productLine", "textDescription", "update_timestamp"], CTX)
    plan = _plan(df)
    assert "GreaterThanOrEqual(update_timestamp" in plan
    assert "wide_column" not in plan and "create_timestamp" not in plan
    assert df.count() == 1000 * 11 // 20


def test_small_parent_is_broadcast(spark):
    child = spark.range(10000).select(F.col("id"), (F.col("id") % 7).alias("k"),
                                      F.lit(None).cast("long").alias("pid"))
    parent = spark.range(7).select(F.col("id").alias("k"), (F.col("id") + 100).alias("pid"))
    out = resolve_ref(child, parent, "k", "k", "pid", "pid")
    assert "BroadcastHashJoin" in _plan(out)
    assert out.where("pid is null").count() == 0


def test_small_delta_is_broadcast_into_target(spark, scratch):
    target = spark.range(200000).select(
        F.concat(F.lit("L"), F.col("id").cast("string")).alias("productLine"),
        F.lit("t").alias("textDescription"), F.col("id").alias("dw_product_line_id"),
        F.lit(ts("2024-01-01 00:00:00")).cast("timestamp_ntz").alias("src_create_timestamp"),
        F.lit(ts("2024-01-01 00:00:00")).cast("timestamp_ntz").alias("src_update_timestamp"),
        F.lit(1).alias("etl_batch_no"), F.lit(None).cast("date").alias("etl_batch_date"))
    rows_ = spark.createDataFrame([("L5", "new", None, ts("2024-03-10 00:00:00"))],
                                  PRODUCTLINES.stage_schema())
    # as in the pipeline: the stage is a CSV delta folder (file statistics)
    stage = read_stage(spark, write_delta_csv(rows_, scratch, "productlines", CTX.batch_date),
                       PRODUCTLINES)
    out = upsert_updates(target, stage, PRODUCTLINES, CTX)
    assert out.where("textDescription = 'new'").count() == 1
    assert "BroadcastHashJoin" in _plan(out) and "SortMergeJoin" not in _plan(out)


def test_selective_side_is_measured_then_broadcast(spark, scratch):
    from tallyhouse.operators.joins import broadcast_if_measured_small
    from tallyhouse.session import estimated_size_bytes
    spark.range(200000).select(F.col("id").alias("o_id"), (F.col("id") % 1000).alias("day"),
                               F.sha2(F.col("id").cast("string"), 256).alias("pad")) \
        .write.parquet(f"{scratch}/orders")
    orders = spark.read.parquet(f"{scratch}/orders").where("day = 7")
    limit = 64 * 1024
    assert estimated_size_bytes(orders) > limit          # the estimate cannot prove it small
    side = broadcast_if_measured_small(orders, "t", limit_bytes=limit)
    lines = spark.range(1000000).select((F.col("id") % 200000).alias("o_id"))
    j = lines.join(side, "o_id")
    assert "BroadcastHashJoin" in _plan(j) and "SortMergeJoin" not in _plan(j)
    assert j.count() == 1000000 // 1000


def test_insert_side_streams_target_keys(spark, scratch):
    from tallyhouse.operators.upsert import absent_rows, stage_to_warehouse, upsert_inserts
    spark.range(300000).select(
        F.concat(F.lit("L"), F.col("id").cast("string")).alias("productLine"),
        F.lit("t").alias("textDescription"), F.col("id").alias("dw_product_line_id"),
        F.lit(ts("2024-01-01 00:00:00")).cast("timestamp_ntz").alias("src_create_timestamp"),
        F.lit(ts("2024-01-01 00:00:00")).cast("timestamp_ntz").alias("src_update_timestamp"),
        F.lit(1).alias("etl_batch_no"), F.lit(None).cast("date").alias("etl_batch_date")) \
        .write.parquet(f"{scratch}/target")
    target = spark.read.parquet(f"{scratch}/target")
    rows_ = spark.createDataFrame([("L5", "x", None, ts("2024-03-10 00:00:00")),
                                   ("NEW", "y", None, ts("2024-03-10 00:00:00"))], PRODUCTLINES.stage_schema())
    stage = read_stage(spark, write_delta_csv(rows_, scratch, "productlines", CTX.batch_date), PRODUCTLINES)
    ins = upsert_inserts(target, stage, PRODUCTLINES, CTX)
    # numbering the new rows cuts the plan; the join stands before it
    plan = _plan(absent_rows(target, stage_to_warehouse(stage, PRODUCTLINES), PRODUCTLINES))
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan
    got = [(r["productLine"], r["dw_product_line_id"]) for r in ins.collect()]
    assert got == [("NEW", 300000)]


def test_a_few_touched_rows_cut_the_parent_without_an_exchange(spark, scratch, monkeypatch):
    from tallyhouse.operators import refs
    spark.range(200_000).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dw"), F.sha2(F.col("id").cast("string"), 256).alias("pad")) \
        .write.parquet(f"{scratch}/parent")
    spark.range(400_000).select(
        F.when(F.col("id") % 5 != 0, F.col("id") % 250_000).alias("k"), F.lit(None).cast("long").alias("pid"),
        F.when(F.col("id") % 2000 == 1, 7).otherwise(6).alias("etl_batch_no")).write.parquet(f"{scratch}/child")
    child, parent = spark.read.parquet(f"{scratch}/child"), spark.read.parquet(f"{scratch}/parent")
    cut = []
    measured = refs.broadcast_if_measured_small
    monkeypatch.setattr(refs, "broadcast_if_measured_small", lambda df, label: cut.append(df) or measured(df, label))
    spark.conf.set("spark.tallyhouse.broadcastMaxBytes", "100000")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = resolve_ref(child, parent, "k", "src", "dw", "pid", F.col("etl_batch_no") == 7)
        plan, of_parent = _plan(out), _plan(cut[0])
        got = {(r["k"], r["pid"]) for r in out.where("etl_batch_no = 7").collect()}
        # all rows asked: the parent is not cut but joined as it is
        whole = resolve_ref(child, parent, "k", "src", "dw", "pid", F.lit(True))
        assert "SortMergeJoin" in _plan(whole) and len(cut) == 1
        assert whole.where("pid = k + 1").count() == whole.where("k < 200000").count()
    finally:
        spark.conf.unset("spark.tallyhouse.broadcastMaxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for p in (plan, of_parent):
        assert "BroadcastHashJoin" in p and "hashpartitioning" not in p and "SortMergeJoin" not in p
    assert "LeftSemi" in of_parent
    want = {i % 250_000 for i in range(1, 400_000, 2000) if i % 5}
    assert got == {(k, k + 1 if k < 200_000 else None) for k in want}
    assert out.count() == 400_000 and out.where("etl_batch_no = 6 and pid is not null").count() == 0


# ---- plans when nothing is small enough to broadcast

@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.tallyhouse.broadcastMaxBytes", "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.tallyhouse.broadcastMaxBytes")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().sparkPlan().toString()


def _count(plan, *names):
    return sum(line.lstrip(" +-:*()0123456789").startswith(names) for line in plan.splitlines())


def test_large_upsert_is_one_join_and_one_stage_scan(no_broadcast, scratch):
    from tallyhouse.operators.upsert import upsert
    spark = no_broadcast
    spark.range(3000).select(
        F.concat(F.lit("L"), F.col("id").cast("string")).alias("productLine"),
        F.lit("t").alias("textDescription"), F.col("id").alias("dw_product_line_id"),
        F.lit(ts("2024-01-01 00:00:00")).cast("timestamp_ntz").alias("src_create_timestamp"),
        F.lit(ts("2024-01-01 00:00:00")).cast("timestamp_ntz").alias("src_update_timestamp"),
        F.lit(1).alias("etl_batch_no"), F.lit(None).cast("date").alias("etl_batch_date")) \
        .write.parquet(f"{scratch}/target")
    target = spark.read.parquet(f"{scratch}/target")
    data = [(f"L{i}", "new", ts("2024-01-01 00:00:00"), ts("2024-03-10 00:00:00")) for i in range(2990, 3010)] + \
        [(None, "no key", ts("2024-01-01 00:00:00"), ts("2024-03-10 00:00:00"))]
    stage = read_stage(spark, write_delta_csv(spark.createDataFrame(data, PRODUCTLINES.stage_schema()), scratch,
                                              "productlines", CTX.batch_date), PRODUCTLINES, empty_text="null")
    out = upsert(target, stage, PRODUCTLINES, CTX)
    plan = _final_plan(out)
    assert _count(plan, "SortMergeJoin") == 1 and "Scan csv" not in plan
    got = out.collect()
    assert len(got) == 3011 and sum(r["textDescription"] == "new" for r in got) == 20
    fresh = sorted((r["dw_product_line_id"], r["productLine"]) for r in got if r["etl_batch_no"] == CTX.batch_no and r["dw_product_line_id"] >= 3000)
    assert fresh == [(3000, None), *[(3001 + i, f"L{3000 + i}") for i in range(10)]]
    # the same rows as the two steps with broadcasts
    spark.conf.unset("spark.tallyhouse.broadcastMaxBytes")
    both = upsert(target, stage, PRODUCTLINES, CTX)
    assert "SortMergeJoin" not in _final_plan(both)
    assert sorted(map(str, both.collect())) == sorted(map(str, got))


def test_history_is_one_join(no_broadcast, scratch):
    from tallyhouse.operators.scd2 import scd2
    from tallyhouse.schemas import history_schema
    spark = no_broadcast
    schema = history_schema("dw_customer_id", "creditLimit")
    spark.createDataFrame([], schema).write.parquet(f"{scratch}/h")
    dim = spark.range(100).select(F.col("id").alias("dw_customer_id"), F.lit(1).cast("decimal(10,2)").alias("creditLimit"))
    dim.write.parquet(f"{scratch}/d")
    out = scd2(spark.read.schema(schema).parquet(f"{scratch}/h"), spark.read.parquet(f"{scratch}/d"), "dw_customer_id", "creditLimit", CTX)
    assert _count(_final_plan(out), "SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin") == 1
    assert out.count() == 100


def test_monthly_insert_aggregates_before_the_join(no_broadcast, scratch):
    from tallyhouse.operators import monthly as M
    spark = no_broadcast
    from pyspark.sql import types as T
    from tallyhouse.operators.daily import PRODUCT_COLUMNS
    daily_schema = T.StructType([T.StructField(c, t, True) for c, t in PRODUCT_COLUMNS])
    spark.createDataFrame([], daily_schema).write.parquet(f"{scratch}/daily")
    spark.createDataFrame([], M.monthly_schema(M.PRODUCT_ROLLUP)).write.parquet(f"{scratch}/monthly")
    daily = spark.read.parquet(f"{scratch}/daily").where("dw_product_id is not null")
    monthly = spark.read.parquet(f"{scratch}/monthly")
    plan = M.monthly_insert(monthly, daily, M.PRODUCT_ROLLUP, CTX)._jdf.queryExecution().executedPlan().toString()
    assert _count(plan, "Exchange") == 2  # the aggregate's and the monthly side's
    assert plan.index("SortMergeJoin") < plan.index("HashAggregate")
