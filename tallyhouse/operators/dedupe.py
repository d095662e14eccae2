"""Stage de-duplication: one row per key, newest first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Keep, per key, the row with the greatest ``order_col``.

    Ties are broken by the remaining columns in schema order, so the
    choice is total and repeatable. Implemented as ``max(struct(...))`` in
    a grouped aggregate rather than a window: the aggregate combines
    map-side, so a key that holds a third of the stage collapses to one
    row per map task before the shuffle. NULL sorts lowest.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c != order_col]
    picked = F.max(F.struct(F.col(order_col), *[F.col(c) for c in rest])).alias("_latest")
    out = df.groupBy(*keys).agg(picked)
    return out.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in [order_col] + rest]) \
        .select(*df.columns)
