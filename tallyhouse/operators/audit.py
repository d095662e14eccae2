"""Batch log as an append-only event table folded to a state.

The original keeps one mutable row per batch: start inserts 'R' (or, when
the row exists, resets it to 'R' with a new start time and a NULL end
time, leaving the batch date), success sets 'C' and the end time, failure
'F' and the end time; success/failure on a missing row change nothing.
Here each call appends an event and the state is a grouped fold: one
aggregate per batch number, combined map-side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNNING, COMPLETED, FAILED = "R", "C", "F"

EVENT_SCHEMA = T.StructType([
    T.StructField("etl_batch_no", T.IntegerType()),
    T.StructField("etl_batch_date", T.DateType()),
    T.StructField("event", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])


# Rows that each step of a batch read or wrote.
STEP_SCHEMA = T.StructType([
    T.StructField("etl_batch_no", T.IntegerType()),
    T.StructField("step", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("logged_at", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])


def log_step(spark: SparkSession, batch_no: int, rows: list[tuple[str, int]], at: dt.datetime,
             seq: int = 0) -> DataFrame:
    """Row counts of a batch's steps (append them to the step log)."""
    return spark.createDataFrame([(batch_no, step, n, at, seq) for step, n in rows], STEP_SCHEMA)


def log_event(spark: SparkSession, batch_no: int, batch_date: dt.date | None, event: str,
              at: dt.datetime, seq: int = 0) -> DataFrame:
    """One audit event row (append it to the log table)."""
    return spark.createDataFrame([(batch_no, batch_date, event, at, seq)], EVENT_SCHEMA)


def batch_state(events: DataFrame) -> DataFrame:
    """Current batch_control_log rows from the events.

    Per batch: status is the last event's; start time the last 'R';
    end time NULL when the last event is 'R', else the last event's time;
    batch date from the first 'R'. Batches without an 'R' have no row.
    ``event_count`` is the existence count of the original check.
    """
    order = F.struct(F.col("event_time"), F.col("seq"))
    is_r = F.col("event") == RUNNING
    g = events.groupBy("etl_batch_no").agg(
        F.max(F.struct(order.alias("o"), F.col("event").alias("e"))).alias("_last"),
        F.max(F.when(is_r, F.col("event_time"))).alias("etl_batch_start_time"),
        F.min(F.when(is_r, F.struct(order.alias("o"), F.col("etl_batch_date").alias("d")))).alias("_first_r"),
        F.count(F.lit(1)).alias("event_count"),
    )
    last_e = F.col("_last.e")
    return g.where(F.col("_first_r").isNotNull()).select(
        F.col("etl_batch_no"),
        F.col("_first_r.d").alias("etl_batch_date"),
        last_e.alias("etl_batch_status"),
        F.col("etl_batch_start_time"),
        F.when(last_e == RUNNING, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("_last.o.event_time")).alias("etl_batch_end_time"),
        F.col("event_count"),
    )
