"""Join helpers: size-checked broadcast and NULL-key split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import estimated_size_bytes, write_through

# Ceiling for an explicit broadcast hint, compared with Catalyst's size
# estimate (which for parquet is the compressed file size, so the table
# in memory can be several times larger). Above it the join is left to
# Catalyst/AQE: sort-merge with runtime skew splitting, or a runtime
# broadcast when the measured shuffle output turns out small. A session
# can set its own ceiling with ``spark.tallyhouse.broadcastMaxBytes``.
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_CONF = "spark.tallyhouse.broadcastMaxBytes"


def broadcast_limit(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(BROADCAST_CONF, None)
    return int(value) if value else DEFAULT_BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, limit_bytes: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when its estimated size is known and under the
    limit; an unknown size (e.g. an RDD scan) is never broadcast."""
    limit = broadcast_limit(df) if limit_bytes is None else limit_bytes
    size = estimated_size_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df


def broadcast_if_measured_small(df: DataFrame, label: str = "side",
                                limit_bytes: int | None = None) -> DataFrame:
    """For a selective side (e.g. this batch's orders, a daily delta) whose
    size the optimizer cannot bound without statistics: if the estimate
    does not prove it small, write it once (shared checkpoint folder) and
    decide on its real file size. Small -> broadcast, so the large other
    side is streamed without a shuffle; large -> the written copy feeds a
    sort-merge join as before."""
    limit = broadcast_limit(df) if limit_bytes is None else limit_bytes
    size = estimated_size_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    written = write_through(df, label)
    size = estimated_size_bytes(written)
    if size is not None and size <= limit:
        return F.broadcast(written)
    return written
