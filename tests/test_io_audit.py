import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.context import BatchContext, latest_batch, snapshot_name
from tallyhouse.operators.audit import batch_state, log_event
from tallyhouse.schemas import CONTROL_SCHEMA, CUSTOMERS, PRODUCTLINES
from tallyhouse.sources.csv_stage import (delta_path, parse_auto_date, parse_auto_timestamp,
                                          read_stage, truncate_columns, write_delta_csv)
from tallyhouse.sources.extract import delta_extract

from helpers import CTX, d, m, rows, ts


def test_watermark_is_inclusive(spark):
    # Q1: update_timestamp at batch-date midnight is in, a microsecond
    # before is out, NULL is out; no upper bound.
    src = spark.createDataFrame([("a", "x", None, ts("2024-03-10 00:00:00")),
                                 ("b", "x", None, ts("2024-03-09 23:59:59.999999")),
                                 ("c", "x", None, None), ("d", "x", None, ts("2031-01-01 00:00:00"))],
                                PRODUCTLINES.stage_schema())
    out = delta_extract(src, PRODUCTLINES.source_names, CTX)
    assert rows(out, "productLine") == [("a",), ("d",)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "update_timestamp" in plan


def test_empty_and_missing_delta(spark, scratch):
    # Q2: an empty delta still writes a folder that reads as 0 rows; a
    # missing folder means that the extract did not run: an error unless
    # asked for.
    empty = spark.createDataFrame([], PRODUCTLINES.stage_schema())
    path = write_delta_csv(empty, scratch, "productlines", CTX.batch_date)
    assert path.endswith("PRODUCTLINES/2024-03-10")
    assert read_stage(spark, path, PRODUCTLINES).count() == 0
    nothing = delta_path(scratch, "nothing", CTX.batch_date)
    assert read_stage(spark, nothing, PRODUCTLINES, missing="empty").count() == 0
    with pytest.raises(FileNotFoundError):
        read_stage(spark, nothing, PRODUCTLINES)


def test_csv_text_round_trip(spark, scratch):
    # Quotes, commas, newlines, backslashes and outer spaces survive;
    # '' reads back as NULL (Q4) unless empty_text='empty' turns NULL text into ''.
    texts = ['say "hi", ok', "two\nlines", "back\\slash", "  padded  ", "", None, "plain"]
    data = [(f"k{i}", t, ts("2024-01-01 10:11:12.123456"), ts("2024-03-10 00:00:00"))
            for i, t in enumerate(texts)]
    src = spark.createDataFrame(data, PRODUCTLINES.stage_schema()).repartition(3)
    path = write_delta_csv(src, scratch, "productlines", CTX.batch_date)
    back = read_stage(spark, path, PRODUCTLINES, empty_text="null")
    got = dict(rows(back, "productLine", "textDescription"))
    want = {f"k{i}": (None if t == "" else t) for i, t in enumerate(texts)}
    assert got == want
    assert {r["create_timestamp"] for r in back.collect()} == {ts("2024-01-01 10:11:12.123456")}
    filled = dict(rows(read_stage(spark, path, PRODUCTLINES),
                       "productLine", "textDescription"))
    assert filled["k5"] == "" and filled["k4"] == ""


def test_truncate_columns(spark):
    df = spark.createDataFrame([("abcdefgh", "xy")], "customerName string, city string")
    assert truncate_columns(df, {"customerName": 3}).collect()[0] == ("abc", "xy")
    # widths count bytes and never cut a character
    texts = ["ééééé", "aé", "日本語", "😀x", "", None, "abc", "a😀"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for width in range(0, 9):
        got = [r[0] for r in truncate_columns(df, {"t": width}).collect()]
        want = [None if t is None else max((t[:i] for i in range(len(t) + 1) if len(t[:i].encode()) <= width), key=len) for t in texts]
        assert got == want, width


def test_parse_auto(spark):
    df = spark.createDataFrame([("2024-03-10 01:02:03",), ("2024/03/10 01:02:03",), ("03/10/2024",),
                                ("2024-03-10",), ("garbage",)], "t string")
    got = [r[0] for r in df.select(parse_auto_timestamp(F.col("t"))).collect()]
    assert got == [ts("2024-03-10 01:02:03"), ts("2024-03-10 01:02:03"), ts("2024-03-10 00:00:00"),
                   ts("2024-03-10 00:00:00"), None]
    days = [r[0] for r in df.select(parse_auto_date(F.col("t"))).collect()]
    assert days == [d("2024-03-10")] * 4 + [None]
    more = {"2005-06-09T10:11:12.123": "2005-06-09 10:11:12.123", "2005-06-09T10:11:12Z": "2005-06-09 10:11:12",
            "6/9/2005": "2005-06-09 00:00:00", "2005-06-09 10:11": "2005-06-09 10:11:00", "2005-06-09 10:11:12+02:00": "2005-06-09 10:11:12",
            "2005-06-09 10:11:12.12345678": "2005-06-09 10:11:12.123456", "2005-6-9": "2005-06-09 00:00:00", "20050609": "2005-06-09 00:00:00",
            "20050609101112": "2005-06-09 10:11:12", "9-Jun-2005": "2005-06-09 00:00:00", " 6/9/2005 10:11 ": "2005-06-09 10:11:00",
            "2005": None, "2005-13-01": None, "10:11": None}
    df = spark.createDataFrame([(t,) for t in more], "t string")
    got = [tuple(r) for r in df.select("t", parse_auto_timestamp(F.col("t")), parse_auto_date(F.col("t"))).collect()]
    assert got == [(t, ts(x), ts(x).date() if x else None) for t, x in more.items()]


def test_control_and_snapshot(spark):
    # Newest batch by number (not by order of rows); Q33 sentinel date.
    c = spark.createDataFrame([(3, d("2024-03-10")), (5, d("2024-03-12")), (4, d("2024-03-11"))],
                              CONTROL_SCHEMA)
    assert latest_batch(c).collect()[0] == (5, d("2024-03-12"))
    assert snapshot_name(dt.date(2001, 1, 1)) == "CM_20050609"
    assert snapshot_name(dt.date(2024, 3, 10)) == "CM_20240310"


def test_batch_log_cycles(spark):
    # Start, fail, restart, complete; end time reset on restart;
    # date from the first start; events without a start make no row.
    ev = [log_event(spark, 1, d("2024-03-10"), "R", ts("2024-03-10 01:00:00"), 1),
          log_event(spark, 1, None, "F", ts("2024-03-10 02:00:00"), 2),
          log_event(spark, 2, d("2024-03-11"), "R", ts("2024-03-10 02:30:00"), 3),
          log_event(spark, 1, d("2024-03-99".replace("99", "12")), "R", ts("2024-03-10 03:00:00"), 4),
          log_event(spark, 1, None, "C", ts("2024-03-10 04:00:00"), 5),
          log_event(spark, 3, None, "C", ts("2024-03-10 04:00:00"), 6)]
    events = ev[0]
    for e in ev[1:]:
        events = events.unionByName(e)
    st = rows(batch_state(events), "etl_batch_no", "etl_batch_date", "etl_batch_status",
              "etl_batch_start_time", "etl_batch_end_time", "event_count")
    assert st == [(1, d("2024-03-10"), "C", ts("2024-03-10 03:00:00"), ts("2024-03-10 04:00:00"), 4),
                  (2, d("2024-03-11"), "R", ts("2024-03-10 02:30:00"), None, 1)]


def test_date_with_time_part_is_cast_at_staging(spark, scratch):
    # Q29: a business date carrying a time part lands as a date, so the
    # daily groups are not split by time of day; S7 formats are accepted.
    import os
    from tallyhouse.schemas import ORDERS
    path = delta_path(scratch, "orders", CTX.batch_date)
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w") as f:
        f.write(",".join(ORDERS.source_names) + "\n")
        f.write("1,2024-03-10 10:30:00,2024/03/17,,In Process,,5,03/10/2024 10:30:00,2024-03-10 10:30:00,\n")
    r = read_stage(spark, path, ORDERS).collect()[0]
    assert (r["orderDate"], r["requiredDate"], r["shippedDate"]) == (d("2024-03-10"), d("2024-03-17"), None)
    assert r["create_timestamp"] == ts("2024-03-10 10:30:00")


def test_unparseable_date_fails_the_load(spark, scratch):
    import os
    import pytest
    from tallyhouse.schemas import ORDERS
    path = delta_path(scratch, "orders", CTX.batch_date)
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w") as f:
        f.write(",".join(ORDERS.source_names) + "\n")
        f.write("1,not a date,,,In Process,,5,,,\n")
    with pytest.raises(Exception):
        read_stage(spark, path, ORDERS).collect()
    assert read_stage(spark, path, ORDERS, mode="PERMISSIVE").collect()[0]["orderDate"] is None


def test_sources_are_read_with_and_without_dated_snapshots(spark, scratch):
    from tallyhouse.sources.extract import read_delta, read_source
    spec = PRODUCTLINES

    def lines(*days):
        rows_ = [(f"L{day}", "x", ts("2024-01-01 00:00:00"), ts(f"2024-03-{day:02d} 00:00:00")) for day in days]
        return spark.createDataFrame(rows_, spec.stage_schema()).withColumn("more", F.lit(1))

    lines(9, 10, 11).write.parquet(f"{scratch}/src/productlines")
    lines(1, 12).write.parquet(f"{scratch}/src/CM_20240310/productlines")
    lines(7).write.option("header", True).csv(f"{scratch}/src/CM_20050609/productlines")
    assert rows(read_delta(spark, f"{scratch}/src/", "productlines", CTX), "productLine") == [("L10",), ("L11",)]
    dated = read_delta(spark, f"{scratch}/src", "productlines", CTX, snapshot=True)
    assert dated.columns == spec.source_names and rows(dated, "productLine") == [("L12",)]
    first = BatchContext(1, dt.date(2001, 1, 1), ts("2001-01-01 05:00:00"))
    assert rows(read_source(spark, f"{scratch}/src", "productlines", first.batch_date, "csv", header="true"), "productLine") == [("L7",)]
