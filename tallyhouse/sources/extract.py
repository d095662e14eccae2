"""Sources (S2) and their delta extract (S1): explicit projection and
inclusive watermark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.context import BatchContext, source_path
from tallyhouse.schemas import SPECS


def delta_extract(src: DataFrame, columns: Sequence[str], ctx: BatchContext,
                  ts_col: str = "update_timestamp") -> DataFrame:
    """Rows changed on or after the batch date (no upper bound).

    The projection and the ``>=`` predicate reach the scan (parquet
    ``PushedFilters`` / JDBC WHERE), so only the delta and its columns
    are read.
    """
    return src.select(*columns).where(F.col(ts_col) >= ctx.watermark_ts())


def read_source(spark: SparkSession, root: str, table: str, snapshot_of: dt.date | None = None,
                data_format: str = "parquet", **options: str) -> DataFrame:
    """A source table ``<root>/<table>`` in any Spark format or, with a
    date, that of the dated snapshot ``<root>/CM_<date>/<table>`` (S2; the
    initial load's sentinel date reads its fixed snapshot)."""
    return spark.read.format(data_format).options(**options).load(source_path(root, table, snapshot_of))


def read_delta(spark: SparkSession, root: str, table: str, ctx: BatchContext, snapshot: bool = False,
               data_format: str = "parquet", **options: str) -> DataFrame:
    """The rows of a source table that changed on or after the batch date,
    with the columns of its specification."""
    source = read_source(spark, root, table, ctx.batch_date if snapshot else None, data_format, **options)
    return delta_extract(source, SPECS[table].source_names, ctx)
