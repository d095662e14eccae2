"""Retail model derived from the driver's TPC-H-like tables.

The driver tables have no batch timestamps, statuses or payments, so they
are derived row by row with fixed rules (same rules in the DuckDB oracle):

* a source row's create/update timestamps come from its key and dates;
* the **prior warehouse** holds the rows created before the batch date,
  as they looked then (rows updated later carry an older value);
* the **stage** is the delta extract: rows updated on/after the batch date.

So one batch sees inserts (created after the date), updates (created
before, changed after) and untouched rows, over whole tables.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.context import BatchContext
from tallyhouse.operators import daily as D
from tallyhouse.operators import monthly as M
from tallyhouse.operators.dedupe import latest_per_key
from tallyhouse.operators.refs import resolve_ref
from tallyhouse.operators.surrogate import assign_surrogate_keys
from tallyhouse.operators.upsert import upsert, upsert_inserts, upsert_updates
from tallyhouse.schemas import SPECS, history_schema
from tallyhouse.session import configure, write_through
from tallyhouse.sources.extract import delta_extract

# The batch the registered queries run: batch 49 dated 1999-01-15 (mid
# month, so the monthly roll-up both updates and inserts).
TEST_CTX = BatchContext(49, dt.date(1999, 1, 15), dt.datetime(1999, 1, 16, 2, 0, 0))
PRIOR_CTX = BatchContext(48, dt.date(1999, 1, 14), dt.datetime(1999, 1, 15, 2, 0, 0))
# Daily rows before the batch date are computed with an open-ended date.
HISTORY_CTX = BatchContext(48, dt.date(1900, 1, 1), dt.datetime(1999, 1, 15, 2, 0, 0))


def _d(s: str) -> Column:
    return F.lit(s).cast("date")


def _ts_of_day(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def _plus_days(day: Column, n: Column) -> Column:
    return F.date_add(day, n.cast("int"))


def _hours(ts: Column, n: Column) -> Column:
    return F.timestamp_add("HOUR", n, ts)


def _days(ts: Column, n: Column) -> Column:
    return F.timestamp_add("DAY", n, ts)


def product_code(partkey: Column) -> Column:
    return F.concat(F.lit("P"), F.lpad(partkey.cast("string"), 9, "0"))


class Testbed:
    """Lazily built DataFrames of one batch over one driver folder."""

    __test__ = False  # not a pytest class

    _shared: dict = {}

    def __init__(self, spark: SparkSession, sf_dir: str, ctx: BatchContext = TEST_CTX):
        self.spark = configure(spark)
        self.sf_dir = str(sf_dir).rstrip("/")
        self.ctx = ctx
        self.prior_ctx = PRIOR_CTX

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "Testbed":
        """One testbed per Spark application and folder: like the batch
        pipeline, the warehouse tables of the batch are built (and
        written) once, and every summary reads those tables."""
        key = (spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
        if key not in cls._shared:
            cls._shared[key] = cls(spark, sf_dir)
        return cls._shared[key]

    WAREHOUSE = ("wh_offices", "wh_employees_office", "wh_employees", "wh_customers",
                 "wh_productlines", "wh_products", "wh_orders", "wh_orderdetails",
                 "wh_payments")

    def build(self) -> "Testbed":
        """Materialise every warehouse table of the batch."""
        for attr in self.WAREHOUSE:
            self.mat(attr)
        return self

    def _memo(self, key: str, make):
        if key not in self.__dict__:
            self.__dict__[key] = make()
        return self.__dict__[key]

    def table(self, name: str) -> DataFrame:
        return self._memo(f"_tab_{name}",
                          lambda: self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet"))

    # ------------------------------------------------------------ sources
    def source(self, name: str) -> DataFrame:
        return self._memo(f"_src_df_{name}", lambda: getattr(self, f"_src_{name}")()
                          .select(*SPECS[name].source_names))

    def _src_customers(self) -> DataFrame:
        c = self.table("customer")
        k = F.col("c_custkey")
        create = _hours(_ts_of_day(_plus_days(_d("1995-01-01"), (k * 7) % 2400)), k % 24)
        n = F.lit(None).cast("string")
        return c.select(
            k.cast("int").alias("customerNumber"), F.col("c_name").alias("customerName"),
            F.col("c_mktsegment").alias("contactLastName"), n.alias("contactFirstName"),
            n.alias("phone"), n.alias("addressLine1"), n.alias("addressLine2"), n.alias("city"),
            n.alias("state"), n.alias("postalCode"), n.alias("country"),
            (k % 97).cast("int").alias("salesRepEmployeeNumber"),
            F.col("c_acctbal").cast("decimal(10,2)").alias("creditLimit"),
            create.alias("create_timestamp"), _days(create, (k % 11) * 53).alias("update_timestamp"))

    def _src_employees(self) -> DataFrame:
        s = self.table("supplier")
        k = F.col("s_suppkey")
        create = _hours(_ts_of_day(_plus_days(_d("1993-01-01"), (k * 37) % 2400)), k % 24)
        n = F.lit(None).cast("string")
        return s.select(
            k.cast("int").alias("employeeNumber"), F.col("s_name").alias("lastName"),
            n.alias("firstName"), n.alias("extension"), n.alias("email"),
            F.col("s_nationkey").cast("string").alias("officeCode"),
            F.when(k >= 10, F.expr("s_suppkey div 10")).cast("int").alias("reportsTo"),
            F.when(k < 10, "Sales Manager").otherwise("Sales Rep").alias("jobTitle"),
            create.alias("create_timestamp"), _days(create, (k % 9) * 170).alias("update_timestamp"))

    def _src_offices(self) -> DataFrame:
        nt = self.table("nation")
        k = F.col("n_nationkey")
        create = _ts_of_day(_plus_days(_d("1994-01-01"), k * 90))
        n = F.lit(None).cast("string")
        return nt.select(
            k.cast("string").alias("officeCode"), F.col("n_name").alias("city"), n.alias("phone"),
            n.alias("addressLine1"), n.alias("addressLine2"), n.alias("state"),
            F.col("n_name").alias("country"), n.alias("postalCode"),
            F.col("n_regionkey").cast("string").alias("territory"),
            create.alias("create_timestamp"), _days(create, (k % 4) * 300).alias("update_timestamp"))

    def _src_productlines(self) -> DataFrame:
        p = self.table("part").select("p_type").distinct()
        return p.select(
            F.col("p_type").alias("productLine"), F.lower("p_type").alias("textDescription"),
            # lines of an even name length are new in this batch
            _ts_of_day(F.when(F.length("p_type") % 2 == 0, _d("1999-02-01")).otherwise(_d("1994-01-01")))
             .alias("create_timestamp"),
            _ts_of_day(F.when(F.length("p_type") % 2 == 0, _d("1999-02-02"))
                       .otherwise(_plus_days(_d("1997-01-01"), F.length("p_type") * 100))).alias("update_timestamp"))

    def _src_products(self) -> DataFrame:
        p = self.table("part")
        k = F.col("p_partkey")
        create = _hours(_ts_of_day(_plus_days(_d("1994-06-01"), (k * 3) % 2000)), k % 24)
        msrp = F.col("p_retailprice").cast("decimal(10,2)")
        return p.select(
            product_code(k).alias("productCode"), F.col("p_name").alias("productName"),
            F.col("p_type").alias("productLine"),
            F.concat(F.lit("1:"), F.col("p_size").cast("string")).alias("productScale"),
            F.col("p_brand").alias("productVendor"),
            F.lit(None).cast("string").alias("productDescription"),
            (F.col("p_size") * 10).cast("int").alias("quantityInStock"),
            (msrp * F.lit(0.6).cast("decimal(2,1)")).cast("decimal(10,2)").alias("buyPrice"),
            msrp.alias("MSRP"),
            create.alias("create_timestamp"), _days(create, (k % 13) * 90).alias("update_timestamp"))

    def _src_orders(self) -> DataFrame:
        o = self.table("orders")
        k = F.col("o_orderkey")
        od = F.col("o_orderdate").cast("date")
        st = F.col("o_orderstatus")
        shipped = F.when(st == "F", _plus_days(od, k % 7 + 1))
        cancelled = F.when(st == "P", _plus_days(od, k % 3))
        return o.select(
            k.cast("int").alias("orderNumber"), od.alias("orderDate"),
            _plus_days(od, F.lit(7)).alias("requiredDate"), shipped.alias("shippedDate"),
            # some orders have no status, an empty one, or no customer
            F.when((st == "O") & (k % 40 == 3), None).when((st == "O") & (k % 40 == 5), "")
             .when(st == "F", " Shipped").when(st == "P", "cancelled ").otherwise("In Process").alias("status"),
            F.col("o_orderpriority").alias("comments"),
            F.when(k % 50 != 7, F.col("o_custkey")).cast("int").alias("customerNumber"),
            _hours(_ts_of_day(od), k % 24).alias("create_timestamp"),
            _hours(_ts_of_day(F.coalesce(shipped, cancelled, od)), k % 24).alias("update_timestamp"),
            cancelled.alias("cancelledDate"))

    def _src_orderdetails(self) -> DataFrame:
        li = self.table("lineitem")
        create = F.col("l_shipdate").cast("timestamp_ntz")
        return li.select(
            F.col("l_orderkey").cast("int").alias("orderNumber"),
            product_code(F.col("l_partkey")).alias("productCode"),
            F.col("l_quantity").cast("int").alias("quantityOrdered"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("priceEach"),
            F.col("l_linenumber").cast("int").alias("orderLineNumber"),
            create.alias("create_timestamp"),
            _days(create, (F.col("l_linenumber") % 3) * 20).alias("update_timestamp"))

    def _src_payments(self) -> DataFrame:
        e = self.table("events").where(F.col("event_type") == "purchase")
        create = F.timestamp_add("MONTH", F.lit(-300), F.col("ts").cast("timestamp_ntz"))
        return e.select(
            F.col("user_id").cast("int").alias("customerNumber"),
            F.concat(F.lit("CHK"), F.col("event_id").cast("string")).alias("checkNumber"),
            create.cast("date").alias("paymentDate"),
            F.col("value").cast("decimal(10,2)").alias("amount"),
            create.alias("create_timestamp"),
            _days(create, F.col("event_id") % 4).alias("update_timestamp"))

    # -------------------------------------------------------------- prior
    # Value a row had before its post-batch-date change (fixed rule per table).
    _OLD = {
        "customers": lambda: {"creditLimit": (F.col("creditLimit") - 250).cast("decimal(10,2)"),
                              "contactLastName": F.lit("PRIOR")},
        "employees": lambda: {"jobTitle": F.lit("Trainee")},
        "offices": lambda: {"territory": F.lit("NONE")},
        "productlines": lambda: {"textDescription": F.lit("tbd")},
        "products": lambda: {"MSRP": (F.col("MSRP") - 5).cast("decimal(10,2)")},
        "orders": lambda: {"status": F.lit("In Process"), "shippedDate": F.lit(None).cast("date"),
                           "cancelledDate": F.lit(None).cast("date")},
        "orderdetails": lambda: {"quantityOrdered": F.col("quantityOrdered") + 1},
        "payments": lambda: {"amount": (F.col("amount") - 1).cast("decimal(10,2)")},
    }

    def _ids(self, name: str) -> dict:
        """Ids the prior warehouse rows carry (given in earlier batches)."""
        one = F.lit(1).cast("long")
        return {
            "customers": {"dw_customer_id": F.col("customerNumber") + one,
                          "dw_employee_id": F.col("salesRepEmployeeNumber") + one},
            "employees": {"dw_employee_id": F.col("employeeNumber") + one,
                          "dw_office_id": F.col("officeCode").cast("long") + one,
                          "dw_reporting_employee_id": F.col("reportsTo") + one},
            "offices": {"dw_office_id": F.col("officeCode").cast("long") + one},
            "productlines": {},
            "products": {"dw_product_id": F.substring("productCode", 2, 9).cast("long") + one,
                         "dw_product_line_id": F.lit(None).cast("long")},
            "orders": {"dw_order_id": F.col("orderNumber") + one,
                       "dw_customer_id": F.col("customerNumber") + one},
            "orderdetails": {"dw_order_id": F.col("orderNumber") + one,
                             "dw_product_id": F.substring("productCode", 2, 9).cast("long") + one},
            "payments": {"dw_customer_id": F.col("customerNumber") + one},
        }[name]

    def prior(self, name: str) -> DataFrame:
        key = f"_prior_{name}"
        if key not in self.__dict__:
            self.__dict__[key] = self._prior(name)
        return self.__dict__[key]

    def _prior(self, name: str) -> DataFrame:
        spec = SPECS[name]
        wm = self.ctx.watermark_ts()
        src = self.source(name).where(F.col("create_timestamp") < wm)
        changed = F.col("update_timestamp") >= wm
        old = self._OLD[name]()
        cols = []
        for c in spec.source_names:
            if c == "update_timestamp":
                e = F.when(changed, F.col("create_timestamp")).otherwise(F.col("update_timestamp"))
            elif c in old:
                e = F.when(changed, old[c]).otherwise(F.col(c))
            else:
                e = F.col(c)
            cols.append(e.cast(dict(spec.columns)[c]).alias(c))
        rows = src.select(*cols)
        if name == "orderdetails":  # the only source with repeated keys
            rows = latest_per_key(rows, spec.update_keys, "update_timestamp")
        ids = self._ids(name)
        vals = {spec.wh(c): F.col(c) for c in spec.source_names}
        vals.update(ids)
        vals["etl_batch_no"] = self.prior_ctx.no_col()
        vals["etl_batch_date"] = self.prior_ctx.date_col()
        names = [c for c, _ in spec.warehouse_columns()]
        if name == "productlines":
            rows = rows.select(*[vals[c].alias(c) for c in names if c != spec.id_col])
            return assign_surrogate_keys(rows, ["productLine"], spec.id_col).select(*names)
        types = dict(spec.warehouse_columns())
        return rows.select(*[vals[c].cast(types[c]).alias(c) for c in names])

    def stage(self, name: str) -> DataFrame:
        return self._memo(f"_stage_{name}", lambda: delta_extract(
            self.source(name), SPECS[name].source_names, self.ctx))

    # ---------------------------------------------------------- warehouse
    def updated(self, name: str) -> DataFrame:
        return self._memo(f"_upd_{name}", lambda: upsert_updates(
            self.prior(name), self.stage(name), SPECS[name], self.ctx))

    def inserted(self, name: str) -> DataFrame:
        key = f"_ins_{name}"
        if key not in self.__dict__:
            self.__dict__[key] = upsert_inserts(self.prior(name), self.stage(name), SPECS[name], self.ctx)
        return self.__dict__[key]

    def upserted(self, name: str) -> DataFrame:
        return self._memo(f"_ups_{name}", lambda: upsert(
            self.prior(name), self.stage(name), SPECS[name], self.ctx))

    def mat(self, attr: str) -> DataFrame:
        """A warehouse table as the next step reads it: written once (as
        parquet in the checkpoint folder) and read back, so its lineage is
        not re-planned and re-run by every table that refers to it, as the
        batch pipeline reads a published table version."""
        key = f"_mat_{attr}"
        if key not in self.__dict__:
            self.__dict__[key] = write_through(getattr(self, attr), attr)
        return self.__dict__[key]

    @cached_property
    def wh_offices(self) -> DataFrame:
        return self.upserted("offices")

    @cached_property
    def wh_employees_office(self) -> DataFrame:
        return resolve_ref(self.upserted("employees"), self.mat("wh_offices"), "officeCode", "officeCode",
                           "dw_office_id", "dw_office_id")

    @cached_property
    def wh_employees(self) -> DataFrame:
        e = self.mat("wh_employees_office")
        return resolve_ref(e, e, "reportsTo", "employeeNumber", "dw_employee_id",
                           "dw_reporting_employee_id")

    @cached_property
    def wh_customers(self) -> DataFrame:
        return resolve_ref(self.upserted("customers"), self.mat("wh_employees"), "salesRepEmployeeNumber",
                           "employeeNumber", "dw_employee_id", "dw_employee_id")

    @cached_property
    def wh_productlines(self) -> DataFrame:
        return self.upserted("productlines")

    @cached_property
    def wh_products(self) -> DataFrame:
        return resolve_ref(self.upserted("products"), self.mat("wh_productlines"), "productLine",
                           "productLine", "dw_product_line_id", "dw_product_line_id")

    @cached_property
    def wh_orders(self) -> DataFrame:
        return resolve_ref(self.upserted("orders"), self.mat("wh_customers"), "src_customerNumber",
                           "src_customerNumber", "dw_customer_id", "dw_customer_id")

    @cached_property
    def wh_orderdetails_order(self) -> DataFrame:
        return resolve_ref(self.upserted("orderdetails"), self.mat("wh_orders"), "src_orderNumber",
                           "src_orderNumber", "dw_order_id", "dw_order_id")

    @cached_property
    def wh_orderdetails(self) -> DataFrame:
        return resolve_ref(self.wh_orderdetails_order, self.mat("wh_products"), "src_productCode",
                           "src_productCode", "dw_product_id", "dw_product_id")

    @cached_property
    def wh_payments(self) -> DataFrame:
        return resolve_ref(self.upserted("payments"), self.mat("wh_customers"), "src_customerNumber",
                           "src_customerNumber", "dw_customer_id", "dw_customer_id")

    # ------------------------------------------------------------ history
    def prior_history(self, name: str) -> DataFrame:
        """History of the prior dimension rows: an active row opened when
        the row was created, holding its pre-batch value (none where the id
        divides by 7), and a closed row of a lower value where it divides
        by 5. Ids that divide by 11 have only a closed row, to be re-opened."""
        key, tracked = ("dw_customer_id", "creditLimit") if name == "customers" \
            else ("dw_product_id", "MSRP")
        p = self.prior(name)
        pc = self.prior_ctx
        schema = history_schema(key, tracked)
        vals = {key: F.col(key), tracked: F.col(tracked),
                "effective_from_date": F.col("src_create_timestamp").cast("date"),
                "effective_to_date": F.lit(None), "dw_active_record_ind": F.lit(1),
                "dw_create_timestamp": pc.run_ts_col(), "dw_update_timestamp": pc.run_ts_col(),
                "create_etl_batch_no": pc.no_col(), "create_etl_batch_date": pc.date_col(),
                "update_etl_batch_no": F.lit(None), "update_etl_batch_date": F.lit(None)}
        def shaped(rows: DataFrame, **other) -> DataFrame:
            return rows.select(*[{**vals, **other}[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])

        k = F.col(key)
        active = shaped(p.where(k % 11 != 0), **{tracked: F.when(k % 7 != 0, F.col(tracked))})
        closed = shaped(p.where((k % 5 == 0) | (k % 11 == 0)), **{
            tracked: F.col(tracked) - 10, "effective_to_date": pc.date_col(), "dw_active_record_ind": F.lit(0),
            "update_etl_batch_no": pc.no_col(), "update_etl_batch_date": pc.date_col()})
        return active.unionByName(closed)

    # ------------------------------------------------------------ summaries
    def daily_customer(self, ctx: BatchContext | None = None, **kw) -> DataFrame:
        m = self.mat
        return D.daily_customer_summary(m("wh_customers"), m("wh_orders"), m("wh_orderdetails"),
                                        m("wh_products"), m("wh_payments"), ctx or self.ctx, **kw)

    def daily_product(self, ctx: BatchContext | None = None) -> DataFrame:
        m = self.mat
        return D.daily_product_summary(m("wh_orders"), m("wh_orderdetails"), m("wh_products"),
                                       ctx or self.ctx)

    def daily_tables(self, kind: str) -> tuple[DataFrame, DataFrame]:
        key = f"_daily_tables_{kind}"
        if key not in self.__dict__:
            self.__dict__[key] = self._daily_tables(kind)
        return self.__dict__[key]

    def _daily_tables(self, kind: str) -> tuple[DataFrame, DataFrame]:
        """(daily table after this batch, monthly table before it).

        Daily rows dated before the batch date stand for earlier batches;
        the prior monthly table is their roll-up. Every branch filters on
        its own summary date and the outer aggregate groups by it, so this
        batch's rows are the open-ended computation restricted to dates on
        or after the batch date, stamped with this batch's run time (and,
        for products, its batch literals): one pass gives both parts."""
        make = self.daily_customer if kind == "customer" else self.daily_product
        spec = M.CUSTOMER_ROLLUP if kind == "customer" else M.PRODUCT_ROLLUP
        allday = write_through(make(HISTORY_CTX), f"daily_{kind}")
        b = self.ctx.date_col()
        earlier = allday.where(F.col("summary_date") < b)
        stamps = {"dw_create_timestamp": self.ctx.run_ts_col(),
                  "dw_update_timestamp": self.ctx.run_ts_col()}
        if kind == "product":
            stamps.update(etl_batch_no=self.ctx.no_col(), etl_batch_date=self.ctx.date_col())
        current = allday.where(F.col("summary_date") >= b) \
            .select(*[stamps.get(c, F.col(c)).alias(c) for c in allday.columns])
        daily = earlier.unionByName(current)
        empty = self.spark.createDataFrame([], M.monthly_schema(spec))
        # the prior monthly table is a published table in the pipeline:
        # written once, so the monthly queries read it as parquet
        monthly = write_through(M.monthly_insert(empty, earlier, spec, PRIOR_CTX), f"monthly_{kind}")
        return daily, monthly
