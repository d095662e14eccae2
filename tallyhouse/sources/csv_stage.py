"""CSV delta files: sink (S3), typed stage read (S4, S5), column width
truncation (S6) and automatic date/time parsing (S7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schemas import TableSpec

# Options that make Spark's CSV writer and reader round-trip quotes,
# commas, embedded newlines, backslashes and outer spaces.
WRITE_OPTIONS = {"header": "true", "escape": '"', "quote": '"',
                 "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                 "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
                 "dateFormat": "yyyy-MM-dd"}
READ_OPTIONS = {"header": "true", "escape": '"', "quote": '"', "multiLine": "true",
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
                "dateFormat": "yyyy-MM-dd"}


def delta_path(root: str, table: str, batch_date: dt.date) -> str:
    """``{TABLE}/{yyyy-mm-dd}/`` under root: upper-case table folder."""
    return f"{root.rstrip('/')}/{table.upper()}/{batch_date.isoformat()}"


def write_delta_csv(df: DataFrame, root: str, table: str, batch_date: dt.date,
                    max_records_per_file: int = 500_000) -> str:
    """Overwrite the table's delta folder for the date with CSV parts.

    Always writes (an empty delta gives a header-only part), so the stage
    read never meets a missing folder for a table that ran. Many part
    files, because a multiLine CSV file cannot be split on read.
    """
    path = delta_path(root, table, batch_date)
    (df.write.mode("overwrite").options(**WRITE_OPTIONS)
     .option("maxRecordsPerFile", max_records_per_file).csv(path))
    return path


def write_delta(df: DataFrame, root: str, table: str, batch_date: dt.date, stage_format: str = "csv") -> str:
    """The delta folder as CSV (for exchange) or Parquet (typed, split on
    read, no parsing)."""
    if stage_format == "csv":
        return write_delta_csv(df, root, table, batch_date)
    path = delta_path(root, table, batch_date)
    df.write.mode("overwrite").parquet(path)
    return path


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def read_stage(spark: SparkSession, path: str, spec: TableSpec, empty_text: str = "empty",
               mode: str = "FAILFAST", widths: dict | None = None, stage_format: str = "csv",
               missing: str = "raise") -> DataFrame:
    """Typed read of one delta folder: the stage table.

    Replacing the DataFrame is the truncate-and-reload; nothing is
    destroyed before the new data is readable. ``empty_text='empty'``
    reads NULL text as '' (what the original bulk load yields for empty
    fields); ``'null'`` keeps Spark's NULL. ``mode='FAILFAST'`` fails on
    a malformed row, as the original load does. The extract always writes
    the folder, so a missing one is an error unless ``missing='empty'``.
    """
    schema = spec.stage_schema()
    if not _exists(spark, path):
        if missing != "empty":
            raise FileNotFoundError(f"no delta folder {path}: the extract of {spec.name} did not run")
        return spark.createDataFrame([], schema)
    df = _read_csv(spark, path, schema, mode) if stage_format == "csv" else spark.read.schema(schema).parquet(path)
    if empty_text == "empty":
        df = df.select(*[(F.coalesce(F.col(f.name), F.lit("")) if isinstance(f.dataType, T.StringType)
                          else F.col(f.name)).alias(f.name) for f in schema.fields])
    widths = spec.widths if widths is None else widths
    if widths:
        df = truncate_columns(df, widths)
    return df


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, mode: str) -> DataFrame:
    # Date and time columns are read as text and parsed with the automatic
    # format chain (a date written with a time part becomes its date);
    # under FAILFAST, text that parses in no format stops the load.
    timed = {f.name for f in schema.fields
             if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))}
    as_text = T.StructType([T.StructField(f.name, T.StringType() if f.name in timed else f.dataType, True)
                            for f in schema.fields])
    raw = spark.read.options(**READ_OPTIONS).option("mode", mode).schema(as_text).csv(path)
    cols = []
    for f in schema.fields:
        if f.name not in timed:
            cols.append(F.col(f.name))
            continue
        text = F.col(f.name)
        parsed = parse_auto_date(text) if isinstance(f.dataType, T.DateType) else parse_auto_timestamp(text)
        if mode == "FAILFAST":
            bad = text.isNotNull() & (F.trim(text) != "") & parsed.isNull()
            parsed = F.when(bad, F.raise_error(F.concat(F.lit(f"unparseable {f.name}: "), text))) \
                .otherwise(parsed)
        cols.append(parsed.cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def cut_to_bytes(text: Column, width: int) -> Column:
    """Longest prefix of whole characters of at most ``width`` UTF-8 bytes."""
    raw = text.cast("binary")
    # A cut before byte k + 1 is inside a character if that byte continues
    # one (80 to BF); at most three bytes back one starts.
    end = F.lit(max(width - 3, 0))
    for k in range(max(width - 2, 0), width + 1):
        inside = F.hex(F.substring(raw, k + 1, 1)).between("80", "BF")
        end = F.when(~inside, F.lit(k)).otherwise(end)
    prefix = F.decode(F.substr(raw, F.lit(1), end), "UTF-8")
    return F.when(F.octet_length(text) > width, prefix).otherwise(text)


def truncate_columns(df: DataFrame, widths: dict) -> DataFrame:
    """Cut text to its column width (in bytes, between characters)."""
    return df.select(*[(cut_to_bytes(F.col(c), widths[c]) if c in widths else F.col(c)).alias(c)
                       for c in df.columns])


# Formats tried, in order, for text that does not start like an ISO date.
# Fixed values of this library (the original relies on its loader's 'auto').
AUTO_FORMATS = (
    "yyyy/M/d H:m:s", "yyyy/M/d H:m", "yyyy/M/d", "M/d/yyyy H:m:s", "M/d/yyyy H:m", "M/d/yyyy",
    "d-MMM-yyyy H:m:s", "d-MMM-yyyy", "yyyyMMddHHmmss", "yyyyMMdd",
)
_ISO = r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"


def parse_auto_timestamp(text: Column) -> Column:
    """Wall-clock time of a text in ISO form (``T`` or space, seconds and
    fraction optional, an offset is ignored) or one of AUTO_FORMATS."""
    t = F.trim(text)
    iso = F.when(t.rlike(_ISO), t.try_cast("timestamp_ntz"))
    return F.coalesce(iso, *[F.try_to_timestamp(t, F.lit(f)).cast("timestamp_ntz") for f in AUTO_FORMATS])


def parse_auto_date(text: Column) -> Column:
    return parse_auto_timestamp(text).cast("date")
