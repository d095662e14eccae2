"""Run one batch from the command line.

    python -m tallyhouse.plans.cli --control <path> --sources <root> \\
        --stage <root> --store <root> [--format parquet] [--tables a,b]

The newest control row gives the batch (S8); every source table
``<sources>/<table>`` (any Spark format), or with ``--snapshots`` that of
the batch's dated snapshot (S2), is delta-extracted into the stage folder
(S1, S3); ``run_batch`` loads the warehouse, history and summaries and
prints the batch log state. The extract is part of the logged batch.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from tallyhouse.context import context_from_control
from tallyhouse.plans.retail import BatchOptions, run_batch
from tallyhouse.schemas import LOAD_ORDER
from tallyhouse.session import configure
from tallyhouse.sources.extract import read_source
from tallyhouse.sources.store import TableStore

# Option, choices (first is the default) of the switches of BatchOptions.
SWITCHES = {
    "empty_text": ("empty", "null"),
    "additive": ("reference", "sum", "exact"),
    "new_customer": ("reference", "customers_only"),
    "daily_write": ("append", "replace_dates"),
    "monthly_mode": ("incremental", "recompute"),
    "ref_scope": ("touched", "all"),
    "history_scope": ("changed", "all"),
    "stage_format": ("csv", "parquet"),
    "missing_stage": ("raise", "empty"),
}


def arguments() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--control", required=True, help="control table (etl_batch_no, etl_batch_date)")
    ap.add_argument("--sources", required=True, help="folder with one source table per name")
    ap.add_argument("--stage", required=True, help="root of the delta folders")
    ap.add_argument("--store", required=True, help="root of the warehouse tables")
    ap.add_argument("--format", default="parquet", help="Spark format of control and sources")
    ap.add_argument("--reader", default=[], action="append", metavar="NAME=VALUE",
                    help="reader option of the sources (may be repeated)")
    ap.add_argument("--snapshots", action="store_true", help="read the dated snapshot of the batch")
    ap.add_argument("--tables", default=",".join(LOAD_ORDER))
    for name, choices in SWITCHES.items():
        ap.add_argument(f"--{name.replace('_', '-')}", default=choices[0], choices=choices)
    ap.add_argument("--monthly", dest="monthly_mode", choices=SWITCHES["monthly_mode"], help=argparse.SUPPRESS)
    ap.add_argument("--null-safe-scd2", action="store_true")
    ap.add_argument("--null-safe-keys", action="store_true")
    ap.add_argument("--widths", default="{}", help='JSON: {"table": {"column": bytes}}')
    ap.add_argument("--keep-commits", type=int, default=0, help="remove what older commits alone name")
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = arguments().parse_args(argv)
    spark = configure(spark or SparkSession.builder.appName("tallyhouse-batch").getOrCreate())
    ctx = context_from_control(spark.read.format(args.format).load(args.control), dt.datetime.now())
    tables = tuple(t for t in args.tables.split(",") if t)
    reader = dict(x.split("=", 1) for x in args.reader)

    def sources():
        day = ctx.batch_date if args.snapshots else None
        return {t: read_source(spark, args.sources, t, day, args.format, **reader) for t in tables}

    opts = BatchOptions(tables=tables, null_safe_scd2=args.null_safe_scd2, null_safe_keys=args.null_safe_keys,
                        widths=json.loads(args.widths), **{name: getattr(args, name) for name in SWITCHES})
    store = TableStore(spark, args.store)
    state = run_batch(spark, store, ctx, args.stage, opts, sources=sources)
    if args.keep_commits:
        store.vacuum(args.keep_commits)
    state.orderBy("etl_batch_no").show(truncate=False)
    return state


if __name__ == "__main__":
    main()
