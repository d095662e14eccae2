"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.joins import broadcast_if_small
from tallyhouse.session import ensure_checkpoint_dir

#: Entries of each of the two generations of a worker's memo.
MEMO_ENTRIES = 120_000


class Memo:
    """Bounded memo of computed values. Entries that are not asked for while
    a generation fills up are forgotten; results do not depend on it. A
    generation is only exceeded by the distinct keys of one request."""

    def __init__(self, limit: int = MEMO_ENTRIES):
        self.limit, self.now, self.before = limit, {}, {}

    def missing(self, keys: Iterable) -> list:
        """The distinct keys to be computed; the others are in ``now``."""
        if len(self.now) >= self.limit:
            self.now, self.before = {}, self.now
        now, before, new = self.now, self.before, []
        for k in dict.fromkeys(keys):
            if k not in now:
                if k in before:
                    now[k] = before[k]
                else:
                    new.append(k)
        return new


#: Bounds of a batch that a task hands to Python: whole texts are rows here,
#: and Spark's default of 10,000 rows is made for narrow ones.
BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
                "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def bound_batches(spark: SparkSession) -> None:
    """Apply BATCH_LIMITS, once per session; a user's later setting stays."""
    done = "spark.tallyhouse.boundedBatches"
    if spark.conf.get(done, None) is None:
        for name, value in BATCH_LIMITS.items():
            spark.conf.set(name, value)
        spark.conf.set(done, "true")


#: Written size up to which a join side is broadcast beside whole texts; in
#: memory it is a few times that.
BROADCAST_BYTES = 8 << 20


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for a broadcast if its measured size allows."""
    return broadcast_if_small(df, BROADCAST_BYTES)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the session's shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tallyhouse-llm/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back with
    the same schema: cuts lineage and survives the loss of executors."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str) -> Column:
    """A string column as text; null counts as the empty text."""
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def crc32_of(col: str) -> Column:
    """Unsigned crc32 of a value's text form; null counts as empty text."""
    return F.crc32(text_or_empty(col).cast("binary"))
