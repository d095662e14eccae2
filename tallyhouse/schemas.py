"""Table specifications of the retail warehouse.

Column names and their order are fixed values of the source system (the
extract column lists); types are chosen for Spark: keys int, money
decimal(10,2), timestamps without time zone (source wall clock).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TS = T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)
STR = T.StringType()
INT = T.IntegerType()
DATE = T.DateType()
ID = T.LongType()

# Column types of the warehouse-only columns.
BATCH_COLUMNS = (("etl_batch_no", INT), ("etl_batch_date", DATE))


@dataclass(frozen=True)
class TableSpec:
    """What the upsert, reference and staging operators need per table.

    ``insert_keys`` decide "new row" (anti-join); ``update_keys`` decide
    which stage row refreshes which target row. They differ for payments.
    ``renames`` map source names to warehouse names. ``refs`` are the
    reference id columns that resolution fills later.
    """

    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    insert_keys: tuple[str, ...]
    update_keys: tuple[str, ...]
    update_cols: tuple[str, ...]
    renames: dict = field(default_factory=dict)
    id_col: str | None = None
    refs: tuple[str, ...] = ()
    widths: dict = field(default_factory=dict)

    @property
    def source_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    def stage_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, True) for c, t in self.columns])

    def wh(self, source_col: str) -> str:
        if source_col == "create_timestamp":
            return "src_create_timestamp"
        if source_col == "update_timestamp":
            return "src_update_timestamp"
        return self.renames.get(source_col, source_col)

    def warehouse_columns(self) -> list[tuple[str, T.DataType]]:
        out = []
        if self.id_col:
            out.append((self.id_col, ID))
        for c, t in self.columns:
            if c not in ("create_timestamp", "update_timestamp"):
                out.append((self.wh(c), t))
        out += [(r, ID) for r in self.refs]
        out += [("src_create_timestamp", TS), ("src_update_timestamp", TS)]
        out += list(BATCH_COLUMNS)
        return out

    def warehouse_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, True) for c, t in self.warehouse_columns()])


_TSCOLS = (("create_timestamp", TS), ("update_timestamp", TS))

CUSTOMERS = TableSpec(
    name="customers",
    columns=(("customerNumber", INT), ("customerName", STR), ("contactLastName", STR),
             ("contactFirstName", STR), ("phone", STR), ("addressLine1", STR),
             ("addressLine2", STR), ("city", STR), ("state", STR), ("postalCode", STR),
             ("country", STR), ("salesRepEmployeeNumber", INT), ("creditLimit", MONEY))
    + _TSCOLS,
    insert_keys=("customerNumber",),
    update_keys=("customerNumber",),
    update_cols=("customerName", "contactLastName", "contactFirstName", "phone",
                 "addressLine1", "addressLine2", "city", "state", "postalCode",
                 "country", "salesRepEmployeeNumber", "creditLimit"),
    renames={"customerNumber": "src_customerNumber"},
    id_col="dw_customer_id",
    refs=("dw_employee_id",),
)

EMPLOYEES = TableSpec(
    name="employees",
    columns=(("employeeNumber", INT), ("lastName", STR), ("firstName", STR),
             ("extension", STR), ("email", STR), ("officeCode", STR), ("reportsTo", INT),
             ("jobTitle", STR)) + _TSCOLS,
    insert_keys=("employeeNumber",),
    update_keys=("employeeNumber",),
    update_cols=("lastName", "firstName", "extension", "email", "officeCode",
                 "reportsTo", "jobTitle"),
    id_col="dw_employee_id",
    refs=("dw_office_id", "dw_reporting_employee_id"),
)

OFFICES = TableSpec(
    name="offices",
    columns=(("officeCode", STR), ("city", STR), ("phone", STR), ("addressLine1", STR),
             ("addressLine2", STR), ("state", STR), ("country", STR), ("postalCode", STR),
             ("territory", STR)) + _TSCOLS,
    insert_keys=("officeCode",),
    update_keys=("officeCode",),
    update_cols=("city", "phone", "addressLine1", "addressLine2", "state", "country",
                 "postalCode", "territory"),
    id_col="dw_office_id",
)

PRODUCTLINES = TableSpec(
    name="productlines",
    columns=(("productLine", STR), ("textDescription", STR)) + _TSCOLS,
    insert_keys=("productLine",),
    update_keys=("productLine",),
    update_cols=("textDescription",),
    id_col="dw_product_line_id",
)

PRODUCTS = TableSpec(
    name="products",
    columns=(("productCode", STR), ("productName", STR), ("productLine", STR),
             ("productScale", STR), ("productVendor", STR), ("productDescription", STR),
             ("quantityInStock", INT), ("buyPrice", MONEY), ("MSRP", MONEY)) + _TSCOLS,
    insert_keys=("productCode",),
    update_keys=("productCode",),
    update_cols=("productName", "productLine", "productScale", "productVendor",
                 "productDescription", "quantityInStock", "buyPrice", "MSRP"),
    renames={"productCode": "src_productCode"},
    id_col="dw_product_id",
    refs=("dw_product_line_id",),
)

ORDERS = TableSpec(
    name="orders",
    columns=(("orderNumber", INT), ("orderDate", DATE), ("requiredDate", DATE),
             ("shippedDate", DATE), ("status", STR), ("comments", STR),
             ("customerNumber", INT)) + _TSCOLS + (("cancelledDate", DATE),),
    insert_keys=("orderNumber",),
    update_keys=("orderNumber",),
    # customerNumber is deliberately not refreshed by an update.
    update_cols=("orderDate", "requiredDate", "shippedDate", "status", "comments",
                 "cancelledDate"),
    renames={"orderNumber": "src_orderNumber", "customerNumber": "src_customerNumber"},
    id_col="dw_order_id",
    refs=("dw_customer_id",),
)

ORDERDETAILS = TableSpec(
    name="orderdetails",
    columns=(("orderNumber", INT), ("productCode", STR), ("quantityOrdered", INT),
             ("priceEach", MONEY), ("orderLineNumber", INT)) + _TSCOLS,
    insert_keys=("orderNumber", "productCode"),
    update_keys=("orderNumber", "productCode"),
    update_cols=("quantityOrdered", "priceEach", "orderLineNumber"),
    renames={"orderNumber": "src_orderNumber", "productCode": "src_productCode"},
    refs=("dw_order_id", "dw_product_id"),
)

PAYMENTS = TableSpec(
    name="payments",
    columns=(("customerNumber", INT), ("checkNumber", STR), ("paymentDate", DATE),
             ("amount", MONEY)) + _TSCOLS,
    # A check number seen under another customer is neither inserted nor updated.
    insert_keys=("checkNumber",),
    update_keys=("customerNumber", "checkNumber"),
    update_cols=("paymentDate", "amount"),
    renames={"customerNumber": "src_customerNumber"},
    refs=("dw_customer_id",),
)

SPECS = {s.name: s for s in (OFFICES, EMPLOYEES, CUSTOMERS, PRODUCTLINES, PRODUCTS,
                             ORDERS, ORDERDETAILS, PAYMENTS)}

# Dependency order of the warehouse step (parents before children).
LOAD_ORDER = ("offices", "employees", "customers", "productlines", "products",
              "orders", "orderdetails", "payments")

HISTORY_SCHEMA_TAIL = (
    ("effective_from_date", DATE), ("effective_to_date", DATE),
    ("dw_active_record_ind", INT), ("dw_create_timestamp", TS),
    ("dw_update_timestamp", TS), ("create_etl_batch_no", INT),
    ("create_etl_batch_date", DATE), ("update_etl_batch_no", INT),
    ("update_etl_batch_date", DATE),
)


def history_schema(key: str, tracked: str, tracked_type=MONEY) -> T.StructType:
    cols = ((key, ID), (tracked, tracked_type)) + HISTORY_SCHEMA_TAIL
    return T.StructType([T.StructField(c, t, True) for c, t in cols])


CONTROL_SCHEMA = T.StructType([T.StructField("etl_batch_no", INT),
                               T.StructField("etl_batch_date", DATE)])
