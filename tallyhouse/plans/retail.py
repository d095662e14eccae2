"""The retail batch: extract -> stage -> warehouse -> history -> summaries.

``run_batch`` composes the operators in dependency order. A batch reads and
writes what its delta touches: warehouse tables lie in parts by the month
of a row's creation, each with the range of its keys, histories in active
rows by blocks of ids and closed rows, daily summaries by date and monthly
ones by month. Parts that do not change are named again by the batch's
commit. That one commit publishes all tables or none. The audit log gets
'R' first, before the extract, and 'C' or 'F' last; the first error stops
the batch.

Beside the tables a commit names what later batches need so that they need
not look at old parts again:

* ``<table>_waiting``: natural keys of rows whose parent is not there yet,
  a ledger part for each part of the table. Keys of new parents are met
  with it; what they resolve is noted in ``<table>_due``, and the table's
  next load touches those parts.
* ``<monthly table>_rolled``: the daily parts that the monthly table holds.
* ``first_payments``: first payment date of each customer.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.context import BatchContext
from tallyhouse.functions.columns import month_start, on_or_after
from tallyhouse.operators import daily as D
from tallyhouse.operators import delta_parts as P
from tallyhouse.operators import monthly as M
from tallyhouse.operators.audit import (COMPLETED, EVENT_SCHEMA, FAILED, RUNNING, STEP_SCHEMA, batch_state,
                                        log_event, log_step)
from tallyhouse.operators.joins import broadcast_if_measured_small
from tallyhouse.operators.refs import resolve_ref, touched_or_unresolved
from tallyhouse.operators.scd2 import scd2_active
from tallyhouse.operators.upsert import inserted_rows, stage_to_warehouse, updated_rows, upsert
from tallyhouse.schemas import LOAD_ORDER, SPECS, TableSpec, history_schema
from tallyhouse.session import configured, scratch_folder, write_through
from tallyhouse.sources.csv_stage import delta_path, read_stage, write_delta
from tallyhouse.sources.extract import delta_extract
from tallyhouse.sources.store import Commit, ConcurrentCommit, Part, TableStore

# Reference resolution steps, in the order they run after each upsert:
# (child table, child key, parent table, parent key, parent id, child column)
REFS = {
    "employees": [("officeCode", "offices", "officeCode", "dw_office_id", "dw_office_id"),
                  ("reportsTo", "employees", "employeeNumber", "dw_employee_id",
                   "dw_reporting_employee_id")],
    "customers": [("salesRepEmployeeNumber", "employees", "employeeNumber", "dw_employee_id",
                   "dw_employee_id")],
    "products": [("productLine", "productlines", "productLine", "dw_product_line_id",
                  "dw_product_line_id")],
    "orders": [("src_customerNumber", "customers", "src_customerNumber", "dw_customer_id",
                "dw_customer_id")],
    "orderdetails": [("src_orderNumber", "orders", "src_orderNumber", "dw_order_id", "dw_order_id"),
                     ("src_productCode", "products", "src_productCode", "dw_product_id",
                      "dw_product_id")],
    "payments": [("src_customerNumber", "customers", "src_customerNumber", "dw_customer_id",
                  "dw_customer_id")],
}

HISTORIES = {"customer_history": ("customers", "dw_customer_id", "creditLimit"),
             "product_history": ("products", "dw_product_id", "MSRP")}

# What the parts of a table are by the creation time of its rows; other
# tables, which stay small, are one part ("all").
UNITS = {"customers": "month", "products": "month", "orders": "month", "orderdetails": "month", "payments": "month"}
UNIT_FORMATS = {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd"}

# Surrogate ids of a block of active history rows.
BLOCK_IDS = 1_000_000
# Parts of one value beyond which a batch that writes there joins them.
MOST_PARTS = 8

# Column whose changes later steps follow.
TRACKED = {dim: tracked for dim, _, tracked in HISTORIES.values()} | {"payments": "paymentDate"}
# Last business date of a row, by which summaries leave out old parts.
LAST_DATE = {"orders": ("orderDate", "cancelledDate", "shippedDate"), "payments": ("paymentDate",)}

ACTIVE, CLOSED = "active", "closed"
NO_DATE, NO_ID = "none", "~"
EVENTS, STEPS = "batch_log_events", "batch_log_steps"


@dataclass
class BatchOptions:
    empty_text: str = "empty"         # Q4: 'empty' (as the original load) or 'null'
    null_safe_scd2: bool = False      # Q12
    additive: str = "reference"       # Q15: 'reference', 'sum' or 'exact'
    new_customer: str = "reference"   # Q16: 'reference' or 'customers_only'
    daily_write: str = "append"       # Q18: 'append' or 'replace_dates'
    monthly_mode: str = "incremental"  # Q23: 'incremental' or 'recompute'
    null_safe_keys: bool = False      # Q28
    ref_scope: str = "touched"        # 'touched' (rows written this batch or still
                                      # unresolved) or 'all' (every row, as the original)
    stage_format: str = "csv"         # delta folders: 'csv' or 'parquet'
    missing_stage: str = "raise"      # a delta folder that is not there: 'raise' or 'empty'
    widths: dict = field(default_factory=dict)   # S6: table -> column -> bytes
    history_scope: str = "changed"    # 'changed' or 'all' (every active row; needed once
                                      # when null_safe_scd2 changes between batches)
    units: dict = field(default_factory=lambda: dict(UNITS))  # table -> 'year', 'month', 'day' or 'all'
    block_ids: int = BLOCK_IDS
    most_parts: int = MOST_PARTS
    tables: tuple = field(default=LOAD_ORDER)


def extract_deltas(sources: dict[str, DataFrame], stage_root: str, ctx: BatchContext,
                   stage_format: str = "csv") -> dict[str, str]:
    """S1 + S3: delta of every source written as the batch's stage folder."""
    out = {}
    for name, src in sources.items():
        out[name] = write_delta(delta_extract(src, SPECS[name].source_names, ctx),
                                stage_root, name, ctx.batch_date, stage_format)
    return out


def _schema(cols) -> T.StructType:
    return T.StructType([T.StructField(c, t, True) for c, t in cols])


def _day(part: Part) -> str | None:
    """Date of a daily part."""
    return part.value.removesuffix(NO_ID) if part.value is not None else None


def _month(part: Part) -> str:
    """Value of the monthly part that a daily part goes to."""
    return NO_DATE if _day(part) == NO_DATE else f"{_day(part)[:7]}-01"


def _unit(unit: str) -> Column:
    """Part value of a warehouse row: when it was created."""
    if unit == "all":
        return F.lit("all")
    return F.coalesce(F.date_format("src_create_timestamp", UNIT_FORMATS[unit]), F.lit("none"))


WAITING_SCHEMA = _schema([("ref", T.StringType()), ("waits_for", T.StringType())])
FIRST_PAYMENTS = "first_payments"
FIRST_SCHEMA = _schema([("dw_customer_id", T.LongType()), ("first_payment_date", T.DateType())])


class Batch:
    """One batch on top of a commit: ``pending`` holds the part lists of
    the tables it has written so far."""

    def __init__(self, spark: SparkSession, store: TableStore, ctx: BatchContext,
                 opts: BatchOptions | None = None):
        self.spark = spark
        self.store = store
        self.base = store.begin()
        self.ctx = ctx
        self.opts = opts or BatchOptions()
        self.pending: dict[str, tuple[Part, ...]] = {}
        self.rows: list[tuple[str, int]] = []  # (step, rows) for the audit
        # Table -> (id, tracked column) of rows whose tracked column is new
        # or changed in this batch; None: not known.
        self.feed: dict[str, DataFrame | None] = {}

    # ------------------------------------------------------------- tables
    def parts(self, table: str) -> tuple[Part, ...]:
        return self.pending.get(table, self.base.tables.get(table, ()))

    def current(self, table: str, schema: T.StructType) -> DataFrame:
        """Table as this batch sees it: its own new parts, else published."""
        return self.store.load(self.parts(table), schema)

    def _warehouse_table(self, name: str) -> DataFrame:
        return self.current(name, SPECS[name].warehouse_schema())

    def _write(self, step: str, table: str, df: DataFrame, value: Column, **stats) -> tuple[Part, ...]:
        """New parts of a table; the write itself counts the step's rows."""
        seen = Observation()
        parts = self.store.write_parts(table, df, value, seen=seen, **stats)
        self.rows.append((step, seen.get["rows"]))
        return parts

    # -------------------------------------------------------------- steps
    def warehouse(self, stage_root: str) -> None:
        for name in self.opts.tables:
            self._load_table(SPECS[name], stage_root)

    def _load_table(self, spec: TableSpec, stage_root: str) -> None:
        name, opts = spec.name, self.opts
        stage = read_stage(self.spark, delta_path(stage_root, name, self.ctx.batch_date), spec,
                           empty_text=opts.empty_text, widths=opts.widths.get(name),
                           stage_format=opts.stage_format, missing=opts.missing_stage)
        seen = Observation()
        stage = write_through(stage.observe(seen, F.count(F.lit(1)).alias("rows")), f"stage-{name}")  # parsed once
        self.rows.append((f"stage {name}", seen.get["rows"]))
        # Rows that were not written by a batch get a full pass: their
        # references may never have been resolved and their keys are unknown.
        if opts.ref_scope == "all" or any(p.rows is None for p in self.parts(name)):
            self._load_whole(spec, stage)
        else:
            self._load_delta(spec, stage)

    def _new_parts(self, spec: TableSpec, rows: DataFrame) -> tuple[Part, ...]:
        dates = [F.col(c) for c in LAST_DATE.get(spec.name, ())]
        last = F.greatest(*dates) if len(dates) > 1 else dates[0] if dates else None
        return self._write(f"warehouse {spec.name}", spec.name, rows, _unit(self.opts.units.get(spec.name, "all")),
                           key=spec.wh(spec.insert_keys[0]), id_col=spec.id_col, last=last)

    def _resolved(self, spec: TableSpec, rows: DataFrame, kept: tuple[Part, ...], every: bool) -> DataFrame:
        """Upsert and reference steps form one plan and the table is written
        once per batch. Parents are earlier tables already written this
        batch, or (self reference) this same plan and the kept parts."""
        for ckey, parent, pkey, pid, col in REFS.get(spec.name, []):
            if parent == spec.name:
                par = rows.unionByName(self.store.load(kept, spec.warehouse_schema())) if kept else rows
            else:
                par = self._warehouse_table(parent)
            only = None if every else touched_or_unresolved(col, self.ctx.no_col())
            rows = resolve_ref(rows, par, ckey, pkey, pid, col, only)
        return rows

    def _load_whole(self, spec: TableSpec, stage: DataFrame) -> None:
        """Every row of the table is read, resolved and written."""
        name, old = spec.name, self.parts(spec.name)
        target = self.store.load(old, spec.warehouse_schema())
        nxt = self._resolved(spec, upsert(target, stage, spec, self.ctx), (), True)
        self.pending[name] = self._new_parts(spec, nxt)
        self.pending[f"{name}_due"] = ()
        self.feed[name] = None
        self._note_waiting(spec, (), self.pending[name])
        self._announce(name, self._warehouse_table(name))

    def _load_delta(self, spec: TableSpec, stage: DataFrame) -> None:
        """The parts that the delta changes, or whose rows wait for a parent
        that has arrived, are read and written; new rows get parts of their
        own beside the others of their month."""
        name, schema, old = spec.name, spec.warehouse_schema(), self.parts(spec.name)
        delta = write_through(stage_to_warehouse(stage, spec), f"delta-{name}")
        key, tracked = spec.wh(spec.insert_keys[0]), TRACKED.get(name)
        near = P.overlapping(old, delta, key)
        found = P.located(self.store, near, delta, spec, tracked)
        fresh = P.absent(delta, found, spec)
        arrived = not fresh.isEmpty()
        if arrived:
            self._announce(name, fresh)
        due = {p.path for p in self.parts(f"{name}_due")}
        touched = P.paths(found.where(P.NEWER)) | (due & {p.path for p in old})
        if arrived and any(n > self.opts.most_parts for n in Counter(p.value for p in old).values()):
            months = {r[0] for r in fresh.select(_unit(self.opts.units.get(name, "all"))).distinct().collect()}
            touched |= P.crowded(old, months, self.opts.most_parts)
        start = max((p.top or 0 for p in old), default=0)
        kept, new = tuple(p for p in old if p.path not in touched), ()
        if touched or arrived:
            nxt = updated_rows(self.store.load(tuple(p for p in old if p.path in touched), schema), delta, spec, self.ctx)
            if arrived:
                nxt = nxt.unionByName(inserted_rows(fresh, spec, self.ctx, start))
            new = self._new_parts(spec, self._resolved(spec, nxt, kept, False))
        else:
            self.rows.append((f"warehouse {name}", 0))
        self.pending[name] = kept + new
        self.pending[f"{name}_due"] = ()
        if tracked and spec.id_col:
            changes = found.where(P.CHANGED).select(spec.id_col, F.col(P.NEW_VALUE).alias(tracked))
            added = self.store.load(new, schema).where(F.col(spec.id_col) > start).select(spec.id_col, tracked)
            self.feed[name] = write_through(changes.unionByName(added), f"feed-{name}")
        elif tracked:
            self.feed[name] = found
        self._note_waiting(spec, kept, new)

    # ------------------------------------------------------- late parents
    def _note_waiting(self, spec: TableSpec, kept: tuple[Part, ...], new: tuple[Part, ...]) -> None:
        """Ledger of the new parts; that of the kept ones stays. The value
        of a ledger part is the path of its part."""
        refs, ledger = REFS.get(spec.name, []), f"{spec.name}_waiting"
        if not refs:
            return
        waits = F.array(*[F.when(F.col(col).isNull() & F.col(ckey).isNotNull(),
                                 F.struct(F.lit(col).alias("ref"), F.col(ckey).cast("string").alias("waits_for")))
                          for ckey, _, _, _, col in refs])
        alive = {p.path for p in kept}
        parts = tuple(p for p in self.parts(ledger) if p.value in alive)
        if new:
            rows = self.store.load(new, spec.warehouse_schema()).select(F.explode(waits).alias("w"), P.part_path().alias(P.PATH))
            rows = rows.where("w is not null").select("w.*", P.PATH).distinct()
            by_value = {p.value: p.path for p in new}  # one part a value and batch
            value = F.regexp_extract(P.PATH, "=([^=]*)$", 1)
            parts += tuple(replace(p, value=by_value[p.value])
                           for p in self.store.write_parts(ledger, rows.select("ref", "waits_for", P.PATH), value))
        self.pending[ledger] = parts

    def _announce(self, parent: str, arrived: DataFrame) -> None:
        """Note the parts of child tables that wait for a key of ``arrived``
        (new rows of the parent)."""
        for child, refs in REFS.items():
            mine = [(col, pkey) for _, p, pkey, _, col in refs if p == parent]
            ledger = self.parts(f"{child}_waiting")
            if not mine or not ledger:
                continue
            keys = [arrived.select(F.lit(col).alias("_ref"), F.col(pkey).cast("string").alias("_key")) for col, pkey in mine]
            for more in keys[1:]:
                keys[0] = keys[0].unionByName(more)
            here = broadcast_if_measured_small(keys[0], "arrived-keys")
            rows = self.store.load(ledger, WAITING_SCHEMA).select("ref", "waits_for", P.part_path().alias(P.PATH))
            hit = P.paths(rows.join(here, (F.col("ref") == F.col("_ref")) & (F.col("waits_for") == F.col("_key")), "left_semi"))
            due = {p.value for p in ledger if p.path in hit} | {p.path for p in self.parts(f"{child}_due")}
            self.pending[f"{child}_due"] = tuple(p for p in self.parts(child) if p.path in due)

    # ------------------------------------------------------------ history
    def _block(self, key: str) -> Column:
        return F.floor((F.col(key) - 1) / F.lit(self.opts.block_ids)).cast("string")

    def histories(self) -> None:
        for table, (dim, key, tracked) in HISTORIES.items():
            schema, old = history_schema(key, tracked), self.parts(table)
            if old and self.parts(dim) == self.base.tables.get(dim, ()):
                continue  # the dimension did not change
            is_active = F.coalesce(F.col("dw_active_record_ind") == 1, F.lit(False))
            value = F.when(is_active, F.concat(F.lit(f"{ACTIVE}-{self.opts.block_ids}-"), self._block(key))).otherwise(CLOSED)
            ours = f"{ACTIVE}-{self.opts.block_ids}-"
            known = all(p.value is not None and p.value.startswith((ours, CLOSED)) for p in old)
            feed = self.feed.get(dim)
            if old and known and feed is not None and self.opts.history_scope == "changed":
                if feed.isEmpty():
                    continue
                # Only blocks of changed ids are read; ids that the feed does
                # not hold go past the join, and new ids have no active row.
                feed = broadcast_if_measured_small(feed, f"feed-{dim}")
                asked = {ours + r[0] for r in feed.select(self._block(key)).distinct().collect()}  # one row a block
                near = tuple(p for p in old if p.value in asked)
                active = self.store.load(near, schema)
                ids = feed.select(F.col(key).alias("_f_key"))
                met = write_through(active.select(*schema.names, P.part_path().alias(P.PATH)).join(
                    ids, F.col(key) == F.col("_f_key"), "left_semi"), f"met-{table}") if near else None
                touched = P.paths(met) if near else set()
                touched |= P.crowded(old, asked, self.opts.most_parts)
                hit = met.select(*schema.names) if near else active
                rest = self.store.load(tuple(p for p in old if p.path in touched), schema).join(
                    ids, F.col(key) == F.col("_f_key"), "left_anti")
                nxt = rest.unionByName(scd2_active(hit, feed, key, tracked, self.ctx, self.opts.null_safe_scd2))
            else:
                mixed = tuple(p for p in old if p.value != CLOSED)  # also loaded from elsewhere
                touched = {p.path for p in mixed}
                active = self.store.load(mixed, schema)
                nxt = scd2_active(active, self._warehouse_table(dim), key, tracked, self.ctx, self.opts.null_safe_scd2)
                if mixed:
                    nxt = nxt.unionByName(active.where(~is_active))
            new = self._write(f"history {table}", table, nxt, value)
            self.pending[table] = tuple(p for p in old if p.path not in touched) + new

    # ---------------------------------------------------------- summaries
    def summaries(self) -> None:
        products = self._warehouse_table("products")
        orders, lines = self._batch_sales()
        payments, first = self._batch_payments()
        dc = D.daily_customer_summary(self._created("customers"), orders, lines, products, payments, self.ctx,
                                      self.opts.additive, self.opts.new_customer, first)
        dp = D.daily_product_summary(orders, lines, products, self.ctx)
        for table, new, cols in (("daily_customer_summary", dc, D.CUSTOMER_COLUMNS),
                                 ("daily_product_summary", dp, D.PRODUCT_COLUMNS)):
            self._add_daily(table, new, _schema(cols))
        for table, daily, spec in (("monthly_customer_summary", "daily_customer_summary", M.CUSTOMER_ROLLUP),
                                   ("monthly_product_summary", "daily_product_summary", M.PRODUCT_ROLLUP)):
            cols = D.CUSTOMER_COLUMNS if daily.startswith("daily_customer") else D.PRODUCT_COLUMNS
            self._roll_up(table, daily, _schema(cols), spec)

    def _recent(self, table: str) -> tuple[Part, ...]:
        """Parts that may hold a business date on or after the batch's."""
        day = self.ctx.batch_date.isoformat()
        return tuple(p for p in self.parts(table) if p.rows is None or p.last is not None and p.last >= day)

    def _created(self, table: str) -> DataFrame:
        """Rows of the parts that may have been created on or after the
        batch date."""
        day = self.ctx.batch_date.isoformat()
        parts = (p for p in self.parts(table) if p.value is None or p.value[:1].isalpha() or p.value >= day[:len(p.value)])
        return self.store.load(tuple(p for p in parts if p.value != NO_DATE), SPECS[table].warehouse_schema())

    def _batch_sales(self) -> tuple[DataFrame, DataFrame]:
        """Orders with a date on or after the batch date, and the order lines
        of the parts that can hold theirs."""
        day = self.ctx.date_col()
        dates = [on_or_after(c, day) for c in LAST_DATE["orders"]]
        orders = self.store.load(self._recent("orders"), SPECS["orders"].warehouse_schema()).where(dates[0] | dates[1] | dates[2])
        orders = write_through(orders, "batch-orders")
        parts = P.overlapping(self.parts("orderdetails"), orders, "src_orderNumber")
        return orders, self.store.load(tuple(parts), SPECS["orderdetails"].warehouse_schema())

    def _batch_payments(self) -> tuple[DataFrame, DataFrame]:
        """Payments on or after the batch date, and first payment dates of
        all customers who pay in them."""
        schema = SPECS["payments"].warehouse_schema()
        recent = self.store.load(self._recent("payments"), schema).where(on_or_after("paymentDate", self.ctx.date_col()))
        return recent, self._first_payments(schema)

    def _first_payments(self, schema: T.StructType) -> DataFrame:
        """The kept first payment dates, brought up to date: payments of
        parts written by this batch can lower them; where an update moved a
        payment's date, the customer's payments are all looked at again."""
        old, now, block = self.parts(FIRST_PAYMENTS), self.parts("payments"), self._block("dw_customer_id")
        known = FIRST_PAYMENTS in self.base.tables and all(p.rows is not None for p in now)
        if known and now == self.base.tables.get("payments", ()):
            return self.store.load(old, FIRST_SCHEMA)
        columns = ["dw_customer_id", "paymentDate"]
        before = {p.path for p in self.base.tables.get("payments", ())}
        feed = self.feed.get("payments")
        kept: tuple[Part, ...] = ()
        if not known or feed is None:
            found = D.first_payment(self.store.load(now, schema).select(*columns))
        else:
            written = self.store.load(tuple(p for p in now if p.path not in before), schema)
            found, state = D.first_payment(written.select(*columns)), lambda parts: self.store.load(parts, FIRST_SCHEMA)
            moved = feed.where(P.CHANGED).select("checkNumber").distinct()
            if not moved.isEmpty():
                payers = written.join(broadcast_if_measured_small(moved, "moved"), "checkNumber", "left_semi")
                again = broadcast_if_measured_small(payers.select("dw_customer_id").distinct(), "moved-payers")
                whole = self.store.load(now, schema).select(*columns).join(again, "dw_customer_id", "left_semi")
                found = found.join(again, "dw_customer_id", "left_anti").unionByName(D.first_payment(whole))
                state = lambda parts: self.store.load(parts, FIRST_SCHEMA).join(again, "dw_customer_id", "left_anti")
            found = write_through(found.where("dw_customer_id is not null"), "first-payments")
            asked = {r[0] for r in found.select(block).distinct().collect()}  # one row a block
            kept = tuple(p for p in old if p.value not in asked)
            met = found.unionByName(state(tuple(p for p in old if p.value in asked)))
            found = met.groupBy("dw_customer_id").agg(F.min("first_payment_date").alias("first_payment_date"))
        parts = self.store.write_parts(FIRST_PAYMENTS, found.where("dw_customer_id is not null"), block)
        self.pending[FIRST_PAYMENTS] = kept + parts
        return self.store.load(self.parts(FIRST_PAYMENTS), FIRST_SCHEMA)

    def _add_daily(self, table: str, new: DataFrame, schema: T.StructType) -> None:
        """Daily rows by date, those without an id apart (``~``). Both write
        modes keep this layout and differ only in whether parts of the same
        dates stay."""
        by_date = F.coalesce(F.col("summary_date").cast("string"), F.lit("none"))
        value = F.concat(by_date, F.when(F.col(schema.names[1]).isNull(), NO_ID).otherwise(""))
        old = self.parts(table)
        written = self._write(f"daily {table}", table, new, value)
        if self.opts.daily_write == "replace_dates":
            dates = {_day(p) for p in written}
            undated = tuple(p for p in old if p.value is None)  # loaded without dates
            if undated:
                rest = self.store.load(undated, schema).where(~by_date.isin(*dates)) if dates else None
                again = self.store.write_parts(table, rest, value) if rest is not None else undated
                old = tuple(p for p in old if p.value is not None) + again
            old = tuple(p for p in old if _day(p) not in dates)
        self.pending[table] = self._joined(table, old, {p.value for p in written}, schema, value) + written

    def _joined(self, table: str, old: tuple[Part, ...], values: set, schema: T.StructType, value: Column) -> tuple[Part, ...]:
        """``old`` with the parts of dates that have many joined into one
        each, of those whose rows the monthly table holds."""
        rolled = f"monthly{table.removeprefix('daily')}_rolled"
        held = {p.path for p in self.parts(rolled)}
        crowd = P.crowded((p for p in old if p.path in held), values, self.opts.most_parts)
        if not crowd:
            return old
        parts = self.store.write_parts(table, self.store.load(tuple(p for p in old if p.path in crowd), schema), value)
        self.pending[rolled] = tuple(p for p in self.parts(rolled) if p.path not in crowd) + parts
        return tuple(p for p in old if p.path not in crowd) + parts

    def _roll_up(self, table: str, daily_table: str, daily_schema: T.StructType, spec: M.RollupSpec) -> None:
        """Monthly rows by month; only months that get or change rows are
        written. Daily parts that the monthly table already holds cannot
        bring absent pairs, but for rows without id or date, which equal no
        monthly row and are inserted by every batch."""
        schema, old, opts, day = M.monthly_schema(spec), self.parts(table), self.opts, self.ctx.batch_date.isoformat()
        by_month = F.coalesce(F.col(M.MONTH).cast("string"), F.lit("none"))
        parts, rolled = self.parts(daily_table), f"{table}_rolled"
        load = lambda some: self.store.load(tuple(some), daily_schema)
        held = {p.path for p in self.parts(rolled)}
        if rolled in self.base.tables and all(p.value is not None for p in (*parts, *old)):
            later = [p for p in parts if _day(p) != NO_DATE and _day(p) >= day]
            coming = [p for p in parts if p.path not in held or p.value.endswith(NO_ID) or _day(p) == NO_DATE]
            delta, news = load(later), load(coming)
            months = {_month(p) for p in later}
            near = months | {_month(p) for p in coming}
        else:
            delta = news = load(parts)
            months = {r[0] for r in delta.where(on_or_after("summary_date", self.ctx.date_col())).select(
                month_start("summary_date").cast("string")).distinct().collect()}
            near = None
        of = lambda some: self.store.load(tuple(p for p in old if some is None or p.value is None or p.value in some), schema)
        if opts.monthly_mode == "recompute":
            # All daily rows of a pair lie in its month.
            whole = load(parts if near is None else [p for p in parts if _month(p) in near])
            again = write_through(M.recomputed_pairs(of(near), whole, spec, self.ctx), "monthly_again")
            months = {r[0] for r in again.select(by_month).distinct().collect()}  # one row a month
            pairs = again.select(F.col(M.MONTH).alias("_t_month"), F.col(spec.key).alias("_t_key"))
            rest = of(months).join(pairs, (F.col(M.MONTH) == F.col("_t_month"))
                                   & F.col(spec.key).eqNullSafe(F.col("_t_key")), "left_anti")
            nxt = rest.unionByName(again)
        else:
            nxt = M.monthly_update(of(months), delta, spec, self.ctx, opts.null_safe_keys).unionByName(
                M.monthly_insert(of(near), news, spec, self.ctx, opts.null_safe_keys))
        kept = tuple(p for p in old if p.value is not None and p.value not in months)
        self.pending[table] = kept + self._write(f"monthly {table}", table, nxt, by_month)
        self.pending[rolled] = parts

    def publish(self) -> Commit:
        """All tables of the batch become visible together."""
        return self.store.commit(self.pending, self.base)


LOG_PARTS = 64  # parts of the batch log that are joined


class BatchLog:
    """Append-only batch log in a store of its own, so that logging does
    not stand between a batch's start and its commit."""

    def __init__(self, store: TableStore):
        self.store = TableStore(store.spark, f"{store.root}/_log")

    def _append(self, table: str, schema: T.StructType, make: Callable[[int], DataFrame]) -> None:
        """``make`` gets the next sequence number. Every LOG_PARTS entries
        are joined into one part."""
        for _ in range(20):  # another batch may log at the same time
            base = self.store.begin()
            old = base.tables.get(table, ())
            seq = max([len(old), *(p.top for p in old if p.top is not None)]) + 1
            rows = make(seq)
            joined = len(old) >= LOG_PARTS
            if joined:
                rows = self.store.load(old, schema).unionByName(rows).coalesce(1)
            new = tuple(replace(p, top=seq) for p in self.store.write(table, rows))
            try:
                self.store.commit({table: new if joined else old + new}, base)
            except ConcurrentCommit:
                continue
            if joined:  # and what was joined goes, some commits later
                self.store.vacuum(2 * LOG_PARTS, running=True)
            return
        raise ConcurrentCommit("the batch log is busy")

    def event(self, ctx: BatchContext, event: str, at: dt.datetime) -> None:
        self._append(EVENTS, EVENT_SCHEMA, lambda seq: log_event(self.store.spark, ctx.batch_no, ctx.batch_date, event, at, seq))

    def steps(self, ctx: BatchContext, rows: list[tuple[str, int]], at: dt.datetime) -> None:
        if rows:
            self._append(STEPS, STEP_SCHEMA, lambda seq: log_step(self.store.spark, ctx.batch_no, rows, at, seq))

    def events(self) -> DataFrame:
        return self.store.read(EVENTS, EVENT_SCHEMA)

    def step_rows(self) -> DataFrame:
        return self.store.read(STEPS, STEP_SCHEMA)


def run_batch(spark: SparkSession, store: TableStore, ctx: BatchContext, stage_root: str,
              opts: BatchOptions | None = None, clock=dt.datetime.now,
              sources: Callable[[], dict[str, DataFrame]] | None = None) -> DataFrame:
    """Run one batch end to end; returns the batch log state. With
    ``sources`` the deltas are extracted first, inside the logged batch.
    The session's settings are as before when it returns."""
    log = BatchLog(store)
    log.event(ctx, RUNNING, clock())
    try:
        with configured(spark), scratch_folder(spark):  # steps read the store, not each other's scratch
            batch = Batch(spark, store, ctx, opts)
            if sources is not None:
                extract_deltas(sources(), stage_root, ctx, batch.opts.stage_format)
            batch.warehouse(stage_root)
            batch.histories()
            batch.summaries()
        log.steps(ctx, batch.rows, clock())
        batch.publish()
    except Exception:
        log.event(ctx, FAILED, clock())
        raise
    log.event(ctx, COMPLETED, clock())
    return batch_state(log.events())
