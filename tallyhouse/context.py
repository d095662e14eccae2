"""Batch identity: the control table lookup (S8) and snapshot paths."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BatchContext:
    """Immutable identity of one batch, passed explicitly to every step.

    ``run_ts`` stands for the wall clock of the run (GETDATE() in the
    original statements); injecting it makes reruns reproducible.
    """

    batch_no: int
    batch_date: dt.date
    run_ts: dt.datetime = field(default_factory=lambda: dt.datetime(1970, 1, 1))

    def no_col(self) -> Column:
        return F.lit(self.batch_no).cast("int")

    def date_col(self) -> Column:
        return F.lit(self.batch_date).cast("date")

    def run_ts_col(self) -> Column:
        return F.lit(self.run_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")

    def watermark_ts(self) -> Column:
        """Midnight of the batch date, for ``update_timestamp >= date``."""
        return self.date_col().cast("timestamp_ntz")


def latest_batch(control: DataFrame) -> DataFrame:
    """The newest control row (ORDER BY etl_batch_no DESC LIMIT 1).

    Planned as TakeOrderedAndProject: each partition keeps its top row,
    the driver merges one row per partition.
    """
    return (control.select(F.col("etl_batch_no").cast("int").alias("etl_batch_no"),
                           F.col("etl_batch_date").cast("date").alias("etl_batch_date"))
            .orderBy(F.col("etl_batch_no").desc_nulls_last())
            .limit(1))


def context_from_control(control: DataFrame, run_ts: dt.datetime) -> BatchContext:
    rows = latest_batch(control).collect()  # at most one row
    if not rows:
        raise LookupError("control table is empty: no batch to run")
    return BatchContext(int(rows[0]["etl_batch_no"]), rows[0]["etl_batch_date"], run_ts)


# Fixed values of the source system: the initial-load sentinel batch date
# reads the snapshot taken on a fixed day; snapshots are named by date.
SNAPSHOT_SENTINELS = {dt.date(2001, 1, 1): dt.date(2005, 6, 9)}
SNAPSHOT_NAME_FORMAT = "CM_%Y%m%d"


def snapshot_name(batch_date: dt.date, sentinels: dict | None = None,
                  fmt: str = SNAPSHOT_NAME_FORMAT) -> str:
    """Name of the dated source snapshot to read for a batch date."""
    sentinels = SNAPSHOT_SENTINELS if sentinels is None else sentinels
    return sentinels.get(batch_date, batch_date).strftime(fmt)


def source_path(root: str, table: str, batch_date: dt.date | None = None) -> str:
    """Where a source table is read: ``<root>/<table>``, or in the dated
    snapshot of the batch, ``<root>/<snapshot>/<table>``."""
    parts = [root.rstrip("/")] + ([snapshot_name(batch_date)] if batch_date else []) + [table]
    return "/".join(parts)


def snapshot_date_col(batch_date: Column, sentinels: dict | None = None) -> Column:
    """Column form of :func:`snapshot_name`'s date mapping."""
    sentinels = SNAPSHOT_SENTINELS if sentinels is None else sentinels
    out = batch_date
    for src, dst in sentinels.items():
        out = F.when(batch_date == F.lit(src), F.lit(dst)).otherwise(out)
    return out
