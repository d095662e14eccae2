"""Stable surrogate keys without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import estimated_size_bytes, write_through

# Input bytes per range partition when numbering rows. The number of
# partitions changes no id: every input is numbered in one total order.
BYTES_PER_PARTITION = 16 * 1024 * 1024

_PID = "_sk_pid"
_POS = "_sk_pos"


def _partitions_for(df: DataFrame) -> int:
    size = estimated_size_bytes(df)
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return most if size is None else max(1, min(most, -(-size // BYTES_PER_PARTITION)))


def assign_surrogate_keys(df: DataFrame, keys: Sequence[str], id_col: str,
                          start_after: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Number the rows of ``df`` as ``start_after + 1 ...`` in key order.

    Rows are ordered by the keys and, where keys repeat, by all other
    columns, so ids depend on the rows alone. Recipe: range-partition in
    that order, sort within partitions, tag each row with its partition
    and position (``monotonically_increasing_id`` is ``partition << 33 |
    position``), write so the tags are fixed, count rows per partition
    (one small row per partition), turn the counts into offsets on the
    driver and broadcast them back. The driver only sees one number per
    partition. A small input has one partition, whose positions are the ids:
    it is sorted and written in one job.
    """
    spark = df.sparkSession
    keys = list(keys)
    order = [F.col(c).asc_nulls_first() for c in keys + [c for c in df.columns if c not in keys]]
    n = num_partitions or _partitions_for(df)
    if n == 1:
        first = F.lit(start_after).cast("long") + 1
        numbered = df.repartition(1).sortWithinPartitions(*order).select((first + F.monotonically_increasing_id()).alias(id_col), "*")
        return write_through(numbered, "numbered")
    tagged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_POS, F.monotonically_increasing_id()))
    tagged = write_through(tagged, "tagged")
    counts = sorted((r[_PID], r["count"]) for r in tagged.groupBy(_PID).count().collect())
    offsets, running = [], 0
    for pid, cnt in counts:
        offsets.append((pid, running))
        running += cnt
    off_df = spark.createDataFrame(offsets, f"{_PID} int, _sk_off long")
    within = F.col(_POS) - F.shiftleft(F.col(_PID).cast("long"), 33)
    out = (tagged.join(F.broadcast(off_df), _PID)
           .withColumn(id_col, (F.lit(start_after).cast("long") + F.col("_sk_off") + within + 1)))
    return out.select(id_col, *df.columns)


def max_id(df: DataFrame, id_col: str) -> int:
    """Largest id already given out (0 for an empty table); one value."""
    row = df.agg(F.max(id_col).alias("m")).collect()[0]
    return int(row["m"] or 0)
