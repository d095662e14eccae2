"""Which parts of a stored table a delta touches.

A part knows its smallest and largest leading key. The delta's keys first
leave out the parts whose range holds none of them; of the others the key
columns alone are read and met with the delta, which gives, for each key of
the delta that the table has, its part and whether the delta changes it.
Parts without a change are neither read whole nor written.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.joins import broadcast_if_small, broadcast_limit
from tallyhouse.schemas import TableSpec
from tallyhouse.session import estimated_size_bytes, write_through
from tallyhouse.sources.store import Part, TableStore

PATH, NEWER, CHANGED, NEW_VALUE = "_path", "_newer", "_changed", "_new_value"


def part_path() -> Column:
    """Path of a row's part (table, folder and value), from its file."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+/[^/]+)/[^/]+$", 1)


def overlapping(parts: Sequence[Part], keys: DataFrame, key: str) -> list[Part]:
    """Parts whose range of leading keys holds a key of ``keys``; a part
    without a range is among them. Keys beyond the broadcast limit leave out
    only what lies outside their whole range."""
    if not parts:
        return []
    ends = keys.agg(F.min(key), F.max(key)).first()
    if ends[0] is None:
        return [p for p in parts if p.low is None and p.rows is None]
    held = [p for p in parts if p.rows is None or p.low is not None and p.low <= ends[1] and ends[0] <= p.high]
    ranged = [p for p in held if p.low is not None]
    size = estimated_size_bytes(keys)
    if len(ranged) < 2 or size is None or size > broadcast_limit(keys):
        return held
    text = keys.schema[key].dataType
    table = keys.sparkSession.createDataFrame([(p.path, p.low, p.high) for p in ranged], T.StructType([
        T.StructField(PATH, T.StringType()), T.StructField("_low", text), T.StructField("_high", text)]))
    asked = F.broadcast(keys.select(F.col(key).alias("_key")).distinct())
    hit = {r[0] for r in table.join(asked, F.col("_key").between(F.col("_low"), F.col("_high")), "left_semi").select(PATH).collect()}
    return [p for p in held if p.low is None or p.path in hit]


def located(store: TableStore, parts: Sequence[Part], delta: DataFrame, spec: TableSpec,
            tracked: str | None = None) -> DataFrame:
    """Rows of the table whose insert key the de-duplicated ``delta``
    (warehouse names) holds: the insert key, the row's part, whether the
    delta row of its update key is strictly newer and, for a tracked column,
    its id, whether the update changes that column and to what."""
    keys = [spec.wh(k) for k in spec.insert_keys]
    updates = [spec.wh(k) for k in spec.update_keys]
    wanted = list(dict.fromkeys([*keys, *updates, "src_update_timestamp", *([spec.id_col] if tracked and spec.id_col else []),
                                 *([tracked] if tracked else [])]))
    used = [c for c in wanted if c in delta.columns]
    small = broadcast_if_small(delta.select(*[F.col(c).alias(f"_s_{c}") for c in used]))
    schema = spec.warehouse_schema()
    rows = store.load(tuple(parts), schema)
    rows = rows.select(*wanted, (part_path() if parts else F.lit("")).alias(PATH))
    met = rows.join(small, [F.col(k) == F.col(f"_s_{k}") for k in keys])
    newer = F.col("_s_src_update_timestamp") > F.col("src_update_timestamp")
    for k in updates:
        newer = newer & (F.col(k) == F.col(f"_s_{k}"))
    newer = F.coalesce(newer, F.lit(False))
    out = [*keys, PATH, newer.alias(NEWER)]
    if tracked:
        out += [*([spec.id_col] if spec.id_col else []),
                (newer & ~F.col(tracked).eqNullSafe(F.col(f"_s_{tracked}"))).alias(CHANGED), F.col(f"_s_{tracked}").alias(NEW_VALUE)]
    return write_through(met.select(*out), f"located-{spec.name}")


def absent(delta: DataFrame, found: DataFrame, spec: TableSpec) -> DataFrame:
    """Delta rows whose insert key the table lacks; NULL keys are among
    them, as they equal none."""
    keys = [spec.wh(k) for k in spec.insert_keys]
    have = broadcast_if_small(found.select(*[F.col(k).alias(f"_t_{k}") for k in keys]).distinct())
    rows = delta.join(have, [F.col(k) == F.col(f"_t_{k}") for k in keys], "left_anti")
    return write_through(rows, f"absent-{spec.name}")


def paths(df: DataFrame) -> set[str]:
    """Distinct part paths of ``df``: at most one for each part."""
    return {r[0] for r in df.select(PATH).distinct().collect()}


def crowded(parts: Iterable[Part], values: set[str], most: int) -> set[str]:
    """Paths of the parts of those ``values`` that have more than ``most``
    parts: rows that go there are written together with them."""
    by_value: dict[str | None, list[str]] = {}
    for p in parts:
        by_value.setdefault(p.value, []).append(p.path)
    return {path for v, group in by_value.items() if v in values and len(group) > most for path in group}
