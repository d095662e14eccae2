"""DuckDB statements that recompute every registered query.

They are written the way the original warehouse statements work, not the
way the Spark operators do: INSERT is a LEFT JOIN ... IS NULL with ids
from ``max + row_number()``, UPDATE ... FROM is a LEFT JOIN with CASE,
the daily summaries are the six-branch UNION ALL with an outer aggregate,
the SCD2 open step runs against the history after the close step. The
driver rows are mapped to the retail model with the same fixed rules as
``tallyhouse.plans.testbed``.
"""

from __future__ import annotations

from tallyhouse.operators import daily as D
from tallyhouse.operators import monthly as M
from tallyhouse.plans.testbed import HISTORY_CTX, PRIOR_CTX, TEST_CTX
from tallyhouse.schemas import SPECS, history_schema

B = f"DATE '{TEST_CTX.batch_date.isoformat()}'"
BTS = f"TIMESTAMP '{TEST_CTX.batch_date.isoformat()} 00:00:00'"
NO = TEST_CTX.batch_no
RUN = f"TIMESTAMP '{TEST_CTX.run_ts:%Y-%m-%d %H:%M:%S}'"
PNO = PRIOR_CTX.batch_no
PDATE = f"DATE '{PRIOR_CTX.batch_date.isoformat()}'"
PRUN = f"TIMESTAMP '{PRIOR_CTX.run_ts:%Y-%m-%d %H:%M:%S}'"
HDATE = f"DATE '{HISTORY_CTX.batch_date.isoformat()}'"
HNO = HISTORY_CTX.batch_no
HRUN = f"TIMESTAMP '{HISTORY_CTX.run_ts:%Y-%m-%d %H:%M:%S}'"

MONEY_NAMES = {"creditLimit", "buyPrice", "MSRP", "priceEach", "amount"}


def _is_money(c: str) -> bool:
    return c in MONEY_NAMES or c.endswith("_amount")


def present(body: str, cols: list[str]) -> str:
    sel = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' if _is_money(c) else f'"{c}"' for c in cols)
    return f"SELECT {sel} FROM ({body}) AS q"


NULLS = "CAST(NULL AS VARCHAR)"

# ------------------------------------------------------------------ sources
SRC = {
    "customers": f"""
SELECT CAST(c_custkey AS INTEGER) AS customerNumber, c_name AS customerName,
  c_mktsegment AS contactLastName, {NULLS} AS contactFirstName, {NULLS} AS phone,
  {NULLS} AS addressLine1, {NULLS} AS addressLine2, {NULLS} AS city, {NULLS} AS state,
  {NULLS} AS postalCode, {NULLS} AS country,
  CAST(c_custkey % 97 AS INTEGER) AS salesRepEmployeeNumber,
  CAST(c_acctbal AS DECIMAL(10,2)) AS creditLimit, ct AS create_timestamp,
  ct + to_days(CAST((c_custkey % 11) * 53 AS INTEGER)) AS update_timestamp
FROM (SELECT *, CAST(DATE '1995-01-01' + CAST((c_custkey * 7) % 2400 AS INTEGER) AS TIMESTAMP)
                + to_hours(CAST(c_custkey % 24 AS BIGINT)) AS ct FROM customer) x""",
    "employees": f"""
SELECT CAST(s_suppkey AS INTEGER) AS employeeNumber, s_name AS lastName, {NULLS} AS firstName,
  {NULLS} AS extension, {NULLS} AS email, CAST(s_nationkey AS VARCHAR) AS officeCode,
  CAST(CASE WHEN s_suppkey >= 10 THEN s_suppkey // 10 END AS INTEGER) AS reportsTo,
  CASE WHEN s_suppkey < 10 THEN 'Sales Manager' ELSE 'Sales Rep' END AS jobTitle,
  ct AS create_timestamp, ct + to_days(CAST((s_suppkey % 9) * 170 AS INTEGER)) AS update_timestamp
FROM (SELECT *, CAST(DATE '1993-01-01' + CAST((s_suppkey * 37) % 2400 AS INTEGER) AS TIMESTAMP)
                + to_hours(CAST(s_suppkey % 24 AS BIGINT)) AS ct FROM supplier) x""",
    "offices": f"""
SELECT CAST(n_nationkey AS VARCHAR) AS officeCode, n_name AS city, {NULLS} AS phone,
  {NULLS} AS addressLine1, {NULLS} AS addressLine2, {NULLS} AS state, n_name AS country,
  {NULLS} AS postalCode, CAST(n_regionkey AS VARCHAR) AS territory, ct AS create_timestamp,
  ct + to_days(CAST((n_nationkey % 4) * 300 AS INTEGER)) AS update_timestamp
FROM (SELECT *, CAST(DATE '1994-01-01' + CAST(n_nationkey * 90 AS INTEGER) AS TIMESTAMP) AS ct
      FROM nation) x""",
    "productlines": """
SELECT p_type AS productLine, lower(p_type) AS textDescription,
  CASE WHEN length(p_type) % 2 = 0 THEN TIMESTAMP '1999-02-01 00:00:00' ELSE TIMESTAMP '1994-01-01 00:00:00' END AS create_timestamp,
  CASE WHEN length(p_type) % 2 = 0 THEN TIMESTAMP '1999-02-02 00:00:00'
    ELSE CAST(DATE '1997-01-01' + CAST(length(p_type) * 100 AS INTEGER) AS TIMESTAMP) END AS update_timestamp
FROM (SELECT DISTINCT p_type FROM part) x""",
    "products": f"""
SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS productCode, p_name AS productName,
  p_type AS productLine, '1:' || CAST(p_size AS VARCHAR) AS productScale, p_brand AS productVendor,
  {NULLS} AS productDescription, CAST(p_size * 10 AS INTEGER) AS quantityInStock,
  CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(10,2)) AS buyPrice,
  CAST(p_retailprice AS DECIMAL(10,2)) AS MSRP, ct AS create_timestamp,
  ct + to_days(CAST((p_partkey % 13) * 90 AS INTEGER)) AS update_timestamp
FROM (SELECT *, CAST(DATE '1994-06-01' + CAST((p_partkey * 3) % 2000 AS INTEGER) AS TIMESTAMP)
                + to_hours(CAST(p_partkey % 24 AS BIGINT)) AS ct FROM part) x""",
    "orders": """
SELECT CAST(o_orderkey AS INTEGER) AS orderNumber, od AS orderDate, od + 7 AS requiredDate,
  shipped AS shippedDate,
  CASE WHEN o_orderstatus = 'O' AND o_orderkey % 40 = 3 THEN NULL WHEN o_orderstatus = 'O' AND o_orderkey % 40 = 5 THEN ''
    WHEN o_orderstatus = 'F' THEN ' Shipped' WHEN o_orderstatus = 'P' THEN 'cancelled ' ELSE 'In Process' END AS status,
  o_orderpriority AS comments, CAST(CASE WHEN o_orderkey % 50 <> 7 THEN o_custkey END AS INTEGER) AS customerNumber,
  CAST(od AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS BIGINT)) AS create_timestamp,
  CAST(coalesce(shipped, cancelled, od) AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS BIGINT))
    AS update_timestamp,
  cancelled AS cancelledDate
FROM (SELECT *, CAST(o_orderdate AS DATE) AS od,
        CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 7 + 1 AS INTEGER) END AS shipped,
        CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) END AS cancelled
      FROM orders) x""",
    "orderdetails": """
SELECT CAST(l_orderkey AS INTEGER) AS orderNumber,
  'P' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS productCode,
  CAST(l_quantity AS INTEGER) AS quantityOrdered, CAST(l_extendedprice AS DECIMAL(10,2)) AS priceEach,
  CAST(l_linenumber AS INTEGER) AS orderLineNumber, CAST(l_shipdate AS TIMESTAMP) AS create_timestamp,
  CAST(l_shipdate AS TIMESTAMP) + to_days(CAST((l_linenumber % 3) * 20 AS INTEGER)) AS update_timestamp
FROM lineitem""",
    "payments": """
SELECT CAST(user_id AS INTEGER) AS customerNumber, 'CHK' || CAST(event_id AS VARCHAR) AS checkNumber,
  CAST(ct AS DATE) AS paymentDate, CAST("value" AS DECIMAL(10,2)) AS amount, ct AS create_timestamp,
  ct + to_days(CAST(event_id % 4 AS INTEGER)) AS update_timestamp
FROM (SELECT *, CAST(ts AS TIMESTAMP) - INTERVAL 300 MONTH AS ct FROM events
      WHERE event_type = 'purchase') x""",
}

OLD = {
    "customers": {"creditLimit": "CAST(creditLimit - 250 AS DECIMAL(10,2))", "contactLastName": "'PRIOR'"},
    "employees": {"jobTitle": "'Trainee'"},
    "offices": {"territory": "'NONE'"},
    "productlines": {"textDescription": "'tbd'"},
    "products": {"MSRP": "CAST(MSRP - 5 AS DECIMAL(10,2))"},
    "orders": {"status": "'In Process'", "shippedDate": "CAST(NULL AS DATE)",
               "cancelledDate": "CAST(NULL AS DATE)"},
    "orderdetails": {"quantityOrdered": "quantityOrdered + 1"},
    "payments": {"amount": "CAST(amount - 1 AS DECIMAL(10,2))"},
}

IDS = {
    "customers": {"dw_customer_id": "CAST(customerNumber AS BIGINT) + 1",
                  "dw_employee_id": "CAST(salesRepEmployeeNumber AS BIGINT) + 1"},
    "employees": {"dw_employee_id": "CAST(employeeNumber AS BIGINT) + 1",
                  "dw_office_id": "CAST(officeCode AS BIGINT) + 1",
                  "dw_reporting_employee_id": "CAST(reportsTo AS BIGINT) + 1"},
    "offices": {"dw_office_id": "CAST(officeCode AS BIGINT) + 1"},
    "productlines": {"dw_product_line_id": "row_number() OVER (ORDER BY productLine)"},
    "products": {"dw_product_id": "CAST(substring(productCode, 2, 9) AS BIGINT) + 1",
                 "dw_product_line_id": "CAST(NULL AS BIGINT)"},
    "orders": {"dw_order_id": "CAST(orderNumber AS BIGINT) + 1",
               "dw_customer_id": "CAST(customerNumber AS BIGINT) + 1"},
    "orderdetails": {"dw_order_id": "CAST(orderNumber AS BIGINT) + 1",
                     "dw_product_id": "CAST(substring(productCode, 2, 9) AS BIGINT) + 1"},
    "payments": {"dw_customer_id": "CAST(customerNumber AS BIGINT) + 1"},
}


def _wh_cols(t):
    return [c for c, _ in SPECS[t].warehouse_columns()]


def _latest(src: str, keys, order_col: str, cols) -> str:
    rest = [c for c in cols if c not in keys and c != order_col]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in [order_col] + rest)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{', '.join(keys)} ORDER BY {order}) AS _rn FROM {src}) z WHERE _rn = 1")


def _prior(t: str) -> str:
    spec = SPECS[t]
    exprs = []
    for c in spec.source_names:
        if c == "update_timestamp":
            e = f"CASE WHEN update_timestamp >= {BTS} THEN create_timestamp ELSE update_timestamp END"
        elif c in OLD[t]:
            e = f"CASE WHEN update_timestamp >= {BTS} THEN {OLD[t][c]} ELSE {c} END"
        else:
            e = c
        exprs.append(f"{e} AS {c}")
    versioned = f"SELECT {', '.join(exprs)} FROM src_{t} WHERE create_timestamp < {BTS}"
    if t == "orderdetails":
        versioned = _latest(f"({versioned}) v", spec.update_keys, "update_timestamp", spec.source_names)
    out = []
    for c in _wh_cols(t):
        if c in IDS[t]:
            out.append(f"{IDS[t][c]} AS {c}")
        elif c == "etl_batch_no":
            out.append(f"{PNO} AS etl_batch_no")
        elif c == "etl_batch_date":
            out.append(f"{PDATE} AS etl_batch_date")
        else:
            src = {spec.wh(s): s for s in spec.source_names}[c]
            out.append(f"{src} AS {c}")
    return f"SELECT {', '.join(out)} FROM ({versioned}) p"


def _upd(t: str) -> str:
    spec = SPECS[t]
    newer = "s.update_timestamp > t.src_update_timestamp"
    upd = {spec.wh(c): c for c in spec.update_cols}
    sel = []
    for c in _wh_cols(t):
        if c in upd:
            sel.append(f"CASE WHEN {newer} THEN s.{upd[c]} ELSE t.{c} END AS {c}")
        elif c == "src_update_timestamp":
            sel.append(f"CASE WHEN {newer} THEN s.update_timestamp ELSE t.src_update_timestamp END AS {c}")
        elif c == "etl_batch_no":
            sel.append(f"CASE WHEN {newer} THEN {NO} ELSE t.etl_batch_no END AS {c}")
        elif c == "etl_batch_date":
            sel.append(f"CASE WHEN {newer} THEN {B} ELSE t.etl_batch_date END AS {c}")
        else:
            sel.append(f"t.{c}")
    on = " AND ".join(f"t.{spec.wh(k)} = s.{k}" for k in spec.update_keys)
    return f"SELECT {', '.join(sel)} FROM prior_{t} t LEFT JOIN dd_{t} s ON {on}"


def _ins(t: str) -> str:
    spec = SPECS[t]
    sel = []
    src_of = {spec.wh(s): s for s in spec.source_names}
    for c in _wh_cols(t):
        if c == spec.id_col:
            order = ", ".join(f"s.{k} ASC NULLS FIRST" for k in spec.insert_keys)
            sel.append(f"(SELECT coalesce(max({c}), 0) FROM prior_{t}) + row_number() OVER (ORDER BY {order}) AS {c}")
        elif c in spec.refs:
            sel.append(f"CAST(NULL AS BIGINT) AS {c}")
        elif c == "etl_batch_no":
            sel.append(f"{NO} AS {c}")
        elif c == "etl_batch_date":
            sel.append(f"{B} AS {c}")
        else:
            sel.append(f"s.{src_of[c]} AS {c}")
    on = " AND ".join(f"s.{k} = t.{spec.wh(k)}" for k in spec.insert_keys)
    miss = " AND ".join(f"t.{spec.wh(k)} IS NULL" for k in spec.insert_keys)
    return f"SELECT {', '.join(sel)} FROM dd_{t} s LEFT JOIN prior_{t} t ON {on} WHERE {miss}"


def _ref(child: str, parent: str, ckey: str, pkey: str, pid: str, col: str) -> str:
    return (f"SELECT c.* REPLACE (coalesce(p._ref_id, c.{col}) AS {col}) FROM {child} c "
            f"LEFT JOIN (SELECT {pkey} AS _ref_key, {pid} AS _ref_id FROM {parent} "
            f"WHERE {pkey} IS NOT NULL) p ON c.{ckey} = p._ref_key")


def base_ctes() -> list[tuple[str, str]]:
    ctes = []
    for t in SPECS:
        spec = SPECS[t]
        ctes.append((f"src_{t}", SRC[t]))
        ctes.append((f"stage_{t}", f"SELECT * FROM src_{t} WHERE update_timestamp >= {BTS}"))
        ctes.append((f"prior_{t}", _prior(t)))
        ctes.append((f"dd_{t}", _latest(f"stage_{t}", spec.update_keys, "update_timestamp",
                                        spec.source_names)))
        ctes.append((f"upd_{t}", _upd(t)))
        ctes.append((f"ins_{t}", _ins(t)))
        ctes.append((f"up_{t}", f"SELECT * FROM upd_{t} UNION ALL SELECT * FROM ins_{t}"))
    ctes += [
        ("wh_offices", "SELECT * FROM up_offices"),
        ("wh1_employees", _ref("up_employees", "wh_offices", "officeCode", "officeCode",
                               "dw_office_id", "dw_office_id")),
        ("wh_employees", _ref("wh1_employees", "wh1_employees", "reportsTo", "employeeNumber",
                              "dw_employee_id", "dw_reporting_employee_id")),
        ("wh_customers", _ref("up_customers", "wh_employees", "salesRepEmployeeNumber",
                              "employeeNumber", "dw_employee_id", "dw_employee_id")),
        ("wh_productlines", "SELECT * FROM up_productlines"),
        ("wh_products", _ref("up_products", "wh_productlines", "productLine", "productLine",
                             "dw_product_line_id", "dw_product_line_id")),
        ("wh_orders", _ref("up_orders", "wh_customers", "src_customerNumber", "src_customerNumber",
                           "dw_customer_id", "dw_customer_id")),
        ("wh1_orderdetails", _ref("up_orderdetails", "wh_orders", "src_orderNumber",
                                  "src_orderNumber", "dw_order_id", "dw_order_id")),
        ("wh_orderdetails", _ref("wh1_orderdetails", "wh_products", "src_productCode",
                                 "src_productCode", "dw_product_id", "dw_product_id")),
        ("wh_payments", _ref("up_payments", "wh_customers", "src_customerNumber",
                             "src_customerNumber", "dw_customer_id", "dw_customer_id")),
    ]
    return ctes


def _with(ctes, final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + final


# -------------------------------------------------------------------- scd2

def _hist_ctes(t: str) -> list[tuple[str, str]]:
    key, tracked, dim = (("dw_customer_id", "creditLimit", "wh_customers") if t == "customers"
                         else ("dw_product_id", "MSRP", "wh_products"))
    prior = (f"SELECT {key}, CASE WHEN {key} % 7 <> 0 THEN {tracked} END AS {tracked}, "
             f"CAST(src_create_timestamp AS DATE) AS effective_from_date, "
             f"CAST(NULL AS DATE) AS effective_to_date, 1 AS dw_active_record_ind, "
             f"{PRUN} AS dw_create_timestamp, {PRUN} AS dw_update_timestamp, "
             f"{PNO} AS create_etl_batch_no, {PDATE} AS create_etl_batch_date, "
             f"CAST(NULL AS INTEGER) AS update_etl_batch_no, CAST(NULL AS DATE) AS update_etl_batch_date "
             f"FROM prior_{t} WHERE {key} % 11 <> 0 UNION ALL "
             f"SELECT {key}, CAST({tracked} - 10 AS DECIMAL(10,2)), CAST(src_create_timestamp AS DATE), {PDATE}, 0, "
             f"{PRUN}, {PRUN}, {PNO}, {PDATE}, {PNO}, {PDATE} FROM prior_{t} WHERE {key} % 5 = 0 OR {key} % 11 = 0")
    hit = "d._k IS NOT NULL"
    closed = (f"SELECT h.{key}, h.{tracked}, h.effective_from_date, "
              f"CASE WHEN {hit} THEN {B} - 1 ELSE h.effective_to_date END AS effective_to_date, "
              f"CASE WHEN {hit} THEN 0 ELSE h.dw_active_record_ind END AS dw_active_record_ind, "
              f"h.dw_create_timestamp, "
              f"CASE WHEN {hit} THEN {RUN} ELSE h.dw_update_timestamp END AS dw_update_timestamp, "
              f"h.create_etl_batch_no, h.create_etl_batch_date, "
              f"CASE WHEN {hit} THEN {NO} ELSE h.update_etl_batch_no END AS update_etl_batch_no, "
              f"CASE WHEN {hit} THEN {B} ELSE h.update_etl_batch_date END AS update_etl_batch_date "
              f"FROM hist0_{t} h LEFT JOIN (SELECT {key} AS _k, {tracked} AS _v FROM {dim}) d "
              f"ON h.dw_active_record_ind = 1 AND h.{key} = d._k AND h.{tracked} <> d._v")
    opened = (f"SELECT c.{key}, c.{tracked}, {B} AS effective_from_date, CAST(NULL AS DATE) AS effective_to_date, "
              f"1 AS dw_active_record_ind, {RUN} AS dw_create_timestamp, {RUN} AS dw_update_timestamp, "
              f"{NO} AS create_etl_batch_no, {B} AS create_etl_batch_date, "
              f"CAST(NULL AS INTEGER) AS update_etl_batch_no, CAST(NULL AS DATE) AS update_etl_batch_date "
              f"FROM {dim} c LEFT JOIN histc_{t} h ON c.{key} = h.{key} AND h.dw_active_record_ind = 1 "
              f"WHERE h.{key} IS NULL OR c.{tracked} <> h.{tracked}")
    return [(f"hist0_{t}", prior), (f"histc_{t}", closed), (f"histo_{t}", opened)]


# ------------------------------------------------------------------- daily

def _pad(vals: dict, columns=D.CUSTOMER_COLUMNS) -> str:
    def sqltype(t):
        return t.simpleString().upper().replace("TIMESTAMP_NTZ", "TIMESTAMP")
    return ", ".join(f"CAST({vals.get(c, '0')} AS {sqltype(t)}) AS {c}" for c, t in columns)


def _daily_branches(b: str) -> dict[str, str]:
    grp = ("GROUP BY {d}, o.dw_customer_id, o.src_create_timestamp, o.src_update_timestamp, "
           "od.etl_batch_no, od.etl_batch_date")
    tail = {"dw_create_timestamp": "o.src_create_timestamp", "dw_update_timestamp": "o.src_update_timestamp",
            "etl_batch_no": "od.etl_batch_no", "etl_batch_date": "od.etl_batch_date"}
    lines = "FROM wh_orderdetails od JOIN wh_orders o ON o.dw_order_id = od.dw_order_id"
    new = (f"SELECT {_pad({'summary_date': 'CAST(c.src_create_timestamp AS DATE)', 'dw_customer_id': 'c.dw_customer_id', 'dw_create_timestamp': 'c.src_create_timestamp', 'dw_update_timestamp': 'c.src_update_timestamp', 'etl_batch_no': 'c.etl_batch_no', 'etl_batch_date': 'c.etl_batch_date'})} "
           f"FROM wh_customers c WHERE CAST(c.src_create_timestamp AS DATE) >= {b} "
           f"GROUP BY c.dw_customer_id, c.src_create_timestamp, c.src_update_timestamp, c.etl_batch_no, c.etl_batch_date")
    ordered = (f"SELECT {_pad({'summary_date': 'o.orderDate', 'dw_customer_id': 'o.dw_customer_id', 'products_ordered_qty': 'COUNT(DISTINCT od.dw_product_id)', 'products_items_qty': 'SUM(od.quantityOrdered)', 'order_mrp_amount': 'SUM(od.quantityOrdered * p.MSRP)', **tail})} "
               f"{lines} JOIN wh_products p ON od.dw_product_id = p.dw_product_id "
               f"WHERE CAST(o.orderDate AS DATE) >= {b} " + grp.format(d="o.orderDate"))
    cancelled = (f"SELECT {_pad({'summary_date': 'o.cancelledDate', 'dw_customer_id': 'o.dw_customer_id', 'cancelled_order_count': 'COUNT(DISTINCT od.dw_order_id)', 'cancelled_order_amount': 'SUM(od.priceEach * od.quantityOrdered)', 'cancelled_order_apd': '1', **tail})} "
                 f"{lines} WHERE CAST(o.cancelledDate AS DATE) >= {b} AND UPPER(TRIM(o.status)) = 'CANCELLED' "
                 + grp.format(d="o.cancelledDate"))
    shipped = (f"SELECT {_pad({'summary_date': 'o.shippedDate', 'dw_customer_id': 'o.dw_customer_id', 'shipped_order_count': 'COUNT(DISTINCT od.dw_order_id)', 'shipped_order_amount': 'SUM(od.priceEach * od.quantityOrdered)', 'shipped_order_apd': '1', **tail})} "
               f"{lines} WHERE CAST(o.shippedDate AS DATE) >= {b} AND UPPER(TRIM(o.status)) = 'SHIPPED' "
               + grp.format(d="o.shippedDate"))
    payments = (f"SELECT {_pad({'summary_date': 'p.paymentDate', 'dw_customer_id': 'p.dw_customer_id', 'payment_apd': '1', 'payment_amount': 'SUM(p.amount)', 'new_customer_paid_apd': 'CASE WHEN fpay.first_payment_date = p.paymentDate THEN 1 ELSE 0 END', 'dw_create_timestamp': 'p.src_create_timestamp', 'dw_update_timestamp': 'p.src_update_timestamp', 'etl_batch_no': 'p.etl_batch_no', 'etl_batch_date': 'p.etl_batch_date'})} "
                f"FROM wh_payments p JOIN first_payment_cte fpay ON p.dw_customer_id = fpay.dw_customer_id "
                f"WHERE CAST(p.paymentDate AS DATE) >= {b} "
                f"GROUP BY p.paymentDate, p.dw_customer_id, fpay.first_payment_date, p.src_create_timestamp, "
                f"p.src_update_timestamp, p.etl_batch_no, p.etl_batch_date")
    opened = (f"SELECT {_pad({'summary_date': 'o.orderDate', 'dw_customer_id': 'o.dw_customer_id', 'order_count': 'COUNT(DISTINCT od.dw_order_id)', 'order_apd': '1', 'order_cost_amount': 'SUM(od.priceEach * od.quantityOrdered)', **tail})} "
              f"{lines} WHERE CAST(o.orderDate AS DATE) >= {b} AND UPPER(TRIM(o.status)) NOT IN ('CANCELLED', 'SHIPPED') "
              + grp.format(d="o.orderDate"))
    return {"new": new, "ordered": ordered, "cancelled": cancelled, "shipped": shipped,
            "payments": payments, "open": opened}


def _daily_customer(b: str, run: str, additive: str = "reference", new_customer: str = "reference") -> str:
    br = _daily_branches(b)
    union = " UNION ALL ".join(f"({q})" for q in br.values())
    outer = []
    for c, t in D.CUSTOMER_MEASURES:
        if c == "new_customer_apd" and new_customer == "reference":
            e = "CASE WHEN summary_date = CAST(MAX(final.dw_create_timestamp) AS DATE) THEN 1 ELSE 0 END"
        elif c == "new_customer_apd":
            # flagged only on a day that has a customer-created row
            e = (f"CASE WHEN (summary_date, dw_customer_id) IN (SELECT CAST(src_create_timestamp AS DATE), "
                 f"dw_customer_id FROM wh_customers WHERE CAST(src_create_timestamp AS DATE) >= {b}) "
                 f"THEN 1 ELSE 0 END")
        elif c in D.CUSTOMER_OUTER_SUM or (additive == "sum" and c in D.CUSTOMER_ADDITIVE):
            e = f"SUM({c})"
        else:
            e = f"MAX({c})"
        outer.append(e)
    vals = dict(zip([c for c, _ in D.CUSTOMER_MEASURES], outer))
    vals.update({"summary_date": "summary_date", "dw_customer_id": "dw_customer_id",
                 "dw_create_timestamp": run, "dw_update_timestamp": run,
                 "etl_batch_no": "MAX(etl_batch_no)", "etl_batch_date": "MAX(etl_batch_date)"})
    return f"SELECT {_pad(vals)} FROM ({union}) final GROUP BY summary_date, dw_customer_id"


def _daily_customer_exact(b: str, run: str) -> str:
    """The summed form with direct distinct counts over a day and customer."""
    lines = "FROM wh_orderdetails od JOIN wh_orders o ON o.dw_order_id = od.dw_order_id"
    status = "UPPER(TRIM(o.status))"
    counts = {"order_count": ("orderDate", "od.dw_order_id", f"{status} NOT IN ('CANCELLED', 'SHIPPED')", ""),
              "cancelled_order_count": ("cancelledDate", "od.dw_order_id", f"{status} = 'CANCELLED'", ""),
              "shipped_order_count": ("shippedDate", "od.dw_order_id", f"{status} = 'SHIPPED'", ""),
              "products_ordered_qty": ("orderDate", "od.dw_product_id", "TRUE", "JOIN wh_products p ON od.dw_product_id = p.dw_product_id")}
    joins, found = [], {}
    for c, (day, item, cond, more) in counts.items():
        joins.append(f"LEFT JOIN (SELECT o.{day} AS d, o.dw_customer_id AS k, COUNT(DISTINCT {item}) AS n {lines} {more} "
                     f"WHERE o.{day} >= {b} AND {cond} GROUP BY 1, 2) x_{c} "
                     f"ON t.summary_date = x_{c}.d AND t.dw_customer_id IS NOT DISTINCT FROM x_{c}.k")
        found[c] = f"CAST(COALESCE(x_{c}.n, 0) AS BIGINT)"
    names = ", ".join(f"{found.get(c, f't.{c}')} AS {c}" for c, _ in D.CUSTOMER_COLUMNS)
    return f"SELECT {names} FROM ({_daily_customer(b, run, additive='sum')}) t {' '.join(joins)}"


def _product_branches(b: str) -> dict[str, str]:
    lines = ("FROM wh_orderdetails od JOIN wh_orders o ON od.src_orderNumber = o.src_orderNumber "
             "JOIN wh_products p ON od.src_productCode = p.src_productCode")
    cols = (("summary_date", D.PRODUCT_COLUMNS[0][1]), ("dw_product_id", D.PRODUCT_COLUMNS[1][1])) \
        + D.PRODUCT_MEASURES
    ordered = (f"SELECT {_pad({'summary_date': 'o.orderDate', 'dw_product_id': 'od.dw_product_id', 'customer_apd': '1', 'product_cost_amount': 'SUM(od.quantityOrdered * od.priceEach)', 'product_mrp_amount': 'SUM(od.quantityOrdered * p.MSRP)'}, cols)} "
               f"{lines} WHERE CAST(o.orderDate AS DATE) >= {b} GROUP BY o.orderDate, od.dw_product_id")
    cancelled = (f"SELECT {_pad({'summary_date': 'o.cancelledDate', 'dw_product_id': 'od.dw_product_id', 'customer_apd': '1', 'cancelled_product_qty': 'SUM(od.quantityOrdered)', 'cancelled_cost_amount': 'SUM(od.quantityOrdered * od.priceEach)', 'cancelled_mrp_amount': 'SUM(od.quantityOrdered * p.MSRP)', 'cancelled_order_apd': '1'}, cols)} "
                 f"{lines} WHERE CAST(o.cancelledDate AS DATE) >= {b} AND UPPER(TRIM(o.status)) = 'CANCELLED' "
                 f"GROUP BY o.cancelledDate, od.dw_product_id")
    return {"ordered": ordered, "cancelled": cancelled}


def _daily_product(b: str, no: int, bdate: str, run: str) -> str:
    br = _product_branches(b)
    vals = {"summary_date": "summary_date", "dw_product_id": "dw_product_id",
            "customer_apd": "MAX(customer_apd)", "cancelled_order_apd": "MAX(cancelled_order_apd)",
            "dw_create_timestamp": run, "dw_update_timestamp": run,
            "etl_batch_no": str(no), "etl_batch_date": bdate}
    for c in ("product_cost_amount", "product_mrp_amount", "cancelled_product_qty",
              "cancelled_cost_amount", "cancelled_mrp_amount"):
        vals[c] = f"SUM({c})"
    return (f"SELECT {_pad(vals, D.PRODUCT_COLUMNS)} FROM ({br['ordered']} UNION ALL {br['cancelled']}) cte "
            f"GROUP BY summary_date, dw_product_id")


# ----------------------------------------------------------------- monthly

def _monthly_ctes(kind: str) -> list[tuple[str, str]]:
    spec = M.CUSTOMER_ROLLUP if kind == "customer" else M.PRODUCT_ROLLUP
    if kind == "customer":
        hist, new = _daily_customer(HDATE, HRUN), _daily_customer(B, RUN)
    else:
        hist, new = _daily_product(HDATE, HNO, HDATE, HRUN), _daily_product(B, NO, B, RUN)
    month = "CAST(date_trunc('month', summary_date) AS DATE)"

    def agg(src, run, where=""):
        vals = {M.MONTH: month, spec.key: spec.key,
                "dw_create_timestamp": run, "dw_update_timestamp": run,
                "etl_batch_no": "MAX(etl_batch_no)", "etl_batch_date": "MAX(etl_batch_date)"}
        for c in spec.sums:
            vals[c] = f"SUM({c})"
        for f in spec.flags:
            vals[f] = f"MAX({f})"
            vals[M.RollupSpec.apm(f)] = f"MAX({f})"
        return f"SELECT {_pad(vals, spec.columns)} FROM {src} {where} GROUP BY {month}, {spec.key}"

    p = kind[0]
    ctes = [(f"dh_{p}", f"SELECT * FROM ({hist}) h WHERE summary_date < {B}"),
            (f"dn_{p}", new),
            (f"daily_{p}", f"SELECT * FROM dh_{p} UNION ALL SELECT * FROM dn_{p}"),
            (f"mon0_{p}", agg(f"dh_{p}", PRUN))]
    # UPDATE ... FROM with the daily delta aggregated per key first.
    dc = agg(f"daily_{p}", "NULL", f"WHERE CAST(summary_date AS DATE) >= {B}")
    sel = []
    for c, t in spec.columns:
        if c in spec.sums:
            sel.append(f"CASE WHEN dc.{M.MONTH} IS NOT NULL THEN mc.{c} + dc.{c} ELSE mc.{c} END")
        elif c.endswith("_apd") and c in spec.flags:
            sel.append(f"CASE WHEN dc.{M.MONTH} IS NOT NULL THEN (CASE WHEN mc.{c} = 1 THEN 1 ELSE dc.{c} END) ELSE mc.{c} END")
        elif c.endswith("_apm"):
            f = c[:-4] + "_apd"
            sel.append(f"CASE WHEN dc.{M.MONTH} IS NOT NULL THEN (CASE WHEN mc.{c} = 1 THEN 1 ELSE dc.{f} END) ELSE mc.{c} END")
        elif c == "dw_update_timestamp":
            sel.append(f"CASE WHEN dc.{M.MONTH} IS NOT NULL THEN {RUN} ELSE mc.{c} END")
        elif c in ("etl_batch_no", "etl_batch_date"):
            sel.append(f"CASE WHEN dc.{M.MONTH} IS NOT NULL THEN dc.{c} ELSE mc.{c} END")
        else:
            sel.append(f"mc.{c}")
    upd_vals = dict(zip([c for c, _ in spec.columns], sel))
    ctes.append((f"monu_{p}", f"SELECT {_pad(upd_vals, spec.columns)} FROM mon0_{p} mc LEFT JOIN ({dc}) dc "
                              f"ON mc.{M.MONTH} = dc.{M.MONTH} AND mc.{spec.key} = dc.{spec.key}"))
    fresh = (f"(SELECT d.* FROM daily_{p} d LEFT JOIN mon0_{p} m ON CAST(date_trunc('month', d.summary_date) AS DATE) "
             f"= m.{M.MONTH} AND d.{spec.key} = m.{spec.key} WHERE m.{M.MONTH} IS NULL) f")
    ctes.append((f"moni_{p}", agg(fresh, RUN)))
    # recompute: touched and absent (month, id) pairs aggregated again from
    # all their daily rows, existing ones keep their create time; other
    # monthly rows unchanged (NULL ids match NULL ids)
    same = "{x}.tm = {y}.{m} AND {x}.tk IS NOT DISTINCT FROM {y}.{k}"
    touched = (f"SELECT DISTINCT {month} AS tm, {spec.key} AS tk FROM daily_{p} "
               f"WHERE CAST(summary_date AS DATE) >= {B} UNION "
               f"SELECT d.tm, d.tk FROM (SELECT DISTINCT {month} AS tm, {spec.key} AS tk FROM daily_{p}) d WHERE NOT EXISTS "
               f"(SELECT 1 FROM mon0_{p} m WHERE {same.format(x='d', y='m', m=M.MONTH, k=spec.key)})")
    ctes.append((f"touch_{p}", touched))
    again = (f"(SELECT d.* FROM daily_{p} d WHERE EXISTS (SELECT 1 FROM touch_{p} t WHERE "
             f"t.tm = CAST(date_trunc('month', d.summary_date) AS DATE) AND t.tk IS NOT DISTINCT FROM d.{spec.key})) g")
    dated = (f"SELECT a.* REPLACE (COALESCE(m.dw_create_timestamp, a.dw_create_timestamp) AS dw_create_timestamp) "
             f"FROM ({agg(again, RUN)}) a LEFT JOIN mon0_{p} m ON a.{M.MONTH} = m.{M.MONTH} "
             f"AND a.{spec.key} IS NOT DISTINCT FROM m.{spec.key}")
    keep = (f"SELECT m.* FROM mon0_{p} m WHERE NOT EXISTS (SELECT 1 FROM touch_{p} t WHERE "
            f"t.tm = m.{M.MONTH} AND t.tk IS NOT DISTINCT FROM m.{spec.key})")
    ctes.append((f"monr_{p}", f"{keep} UNION ALL {dated}"))
    return ctes


# ------------------------------------------------------------------ misc

CONTROL = ("SELECT CAST(date_diff('month', DATE '1995-01-01', d) + 1 AS INTEGER) AS etl_batch_no, "
           "d AS etl_batch_date FROM (SELECT DISTINCT CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) "
           "AS d FROM orders) x")

LOG_EVENTS = ("SELECT CAST(dayofmonth(ts) AS INTEGER) AS etl_batch_no, CAST(ts AS DATE) AS etl_batch_date, "
              "CASE event_type WHEN 'signup' THEN 'R' WHEN 'purchase' THEN 'C' WHEN 'error' THEN 'F' END AS event, "
              "CAST(ts AS TIMESTAMP) AS event_time, event_id AS seq FROM events "
              "WHERE event_type IN ('signup', 'purchase', 'error')")

BATCH_LOG = f"""
WITH ev AS ({LOG_EVENTS}),
firstr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY etl_batch_no ORDER BY event_time, seq) AS rn
                          FROM ev WHERE event = 'R') x WHERE rn = 1),
lastev AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY etl_batch_no ORDER BY event_time DESC, seq DESC) AS rn
                          FROM ev) x WHERE rn = 1),
lastr AS (SELECT etl_batch_no, max(event_time) AS st FROM ev WHERE event = 'R' GROUP BY etl_batch_no),
cnt AS (SELECT etl_batch_no, count(*) AS n FROM ev GROUP BY etl_batch_no)
SELECT f.etl_batch_no, f.etl_batch_date, l.event AS etl_batch_status, r.st AS etl_batch_start_time,
       CASE WHEN l.event = 'R' THEN NULL ELSE l.event_time END AS etl_batch_end_time, c.n AS event_count
FROM firstr f JOIN lastev l ON f.etl_batch_no = l.etl_batch_no JOIN lastr r ON f.etl_batch_no = r.etl_batch_no
JOIN cnt c ON f.etl_batch_no = c.etl_batch_no"""


def oracle_sql() -> dict[str, str]:
    base = base_ctes()
    out: dict[str, str] = {}

    def put(key, final, cols, extra=()):
        out[key] = present(_with(base + list(extra), final), cols)

    out["batch_context"] = present(f"SELECT * FROM ({CONTROL}) c ORDER BY etl_batch_no DESC LIMIT 1",
                                   ["etl_batch_no", "etl_batch_date"])
    out["snapshot_source"] = present(
        f"SELECT etl_batch_no, etl_batch_date, snapshot_date, 'CM_' || strftime(snapshot_date, '%Y%m%d') AS snapshot_name "
        f"FROM (SELECT *, CASE WHEN etl_batch_date = DATE '2001-01-01' THEN DATE '2005-06-09' ELSE etl_batch_date END "
        f"AS snapshot_date FROM ({CONTROL}) c) s",
        ["etl_batch_no", "etl_batch_date", "snapshot_date", "snapshot_name"])
    out["batch_log_state"] = present(BATCH_LOG, ["etl_batch_no", "etl_batch_date", "etl_batch_status",
                                                 "etl_batch_start_time", "etl_batch_end_time", "event_count"])
    for t, spec in SPECS.items():
        src = spec.source_names
        put(f"delta_extract_{t}", f"SELECT * FROM stage_{t}", src)
        put(f"upsert_insert_{t}", f"SELECT * FROM ins_{t}", _wh_cols(t))
        put(f"upsert_update_{t}", f"SELECT * FROM upd_{t}", _wh_cols(t))
    put("delta_extract", "SELECT * FROM stage_orders", SPECS["orders"].source_names)
    # an empty text comes back from CSV as NULL
    put("csv_roundtrip", "SELECT * REPLACE (nullif(status, '') AS status) FROM stage_orders", SPECS["orders"].source_names)
    cust = SPECS["customers"]
    text = [c for c, t in cust.columns if t.simpleString() == "string"]
    put("stage_reload", "SELECT * REPLACE (" + ", ".join(f"coalesce({c}, '') AS {c}" for c in text)
        + ") FROM stage_customers", cust.source_names)
    put("truncate_columns", "SELECT * REPLACE (substring(customerName, 1, 12) AS customerName, "
        "substring(contactLastName, 1, 5) AS contactLastName) FROM stage_customers", cust.source_names)
    forms = ("'%Y-%m-%d %H:%M:%S'", "'%Y/%m/%d %H:%M:%S'", "'%m/%d/%Y'", "'%Y-%m-%dT%H:%M:%S.123'", "'%Y-%m-%dT%H:%M:%SZ'",
             "'%-m/%-d/%Y'", "'%Y-%m-%d %H:%M'", "'%Y-%m-%d %H:%M:%S.1234567'", "'%Y-%m-%dT%H:%M:%S+02:00'")
    n = len(forms)
    text = " ".join(f"WHEN {i} THEN strftime(create_timestamp, {f})" for i, f in enumerate(forms))
    day, ts = "CAST(CAST(create_timestamp AS DATE) AS TIMESTAMP)", "create_timestamp"
    read = {2: day, 5: day, 3: f"{ts} + INTERVAL 123 MILLISECOND", 6: f"date_trunc('minute', {ts})",
            7: f"{ts} + INTERVAL 123456 MICROSECOND"}
    parsed = " ".join(f"WHEN {i} THEN {x}" for i, x in read.items())
    put("parse_auto_dates",
        f"SELECT orderNumber, CASE orderNumber % {n} {text} END AS ts_text, "
        f"CASE orderNumber % {n} {parsed} ELSE {ts} END AS parsed_ts, "
        "CAST(create_timestamp AS DATE) AS parsed_date, CAST(create_timestamp AS DATE) AS auto_date FROM src_orders",
        ["orderNumber", "ts_text", "parsed_ts", "parsed_date", "auto_date"])
    put("truncate_columns_bytes", "SELECT officeCode, city, CASE WHEN strlen(city || 'é') <= 5 THEN city || 'é' ELSE "
        "(SELECT max(left(city || 'é', i)) FROM range(0, 6) r(i) WHERE strlen(left(city || 'é', i)) <= 5) END AS cut FROM stage_offices",
        ["officeCode", "city", "cut"])
    put("stage_empty_status", "SELECT orderNumber, coalesce(CASE WHEN orderNumber % 5 = 0 THEN NULL ELSE status END, '') AS status, "
        "upper(trim(coalesce(CASE WHEN orderNumber % 5 = 0 THEN NULL ELSE status END, ''))) NOT IN ('SHIPPED', 'CANCELLED') AS is_open "
        "FROM stage_orders", ["orderNumber", "status", "is_open"])
    put("surrogate_keys",
        "SELECT row_number() OVER (ORDER BY orderNumber, productCode) AS dw_orderdetail_id, orderNumber, productCode "
        "FROM (SELECT DISTINCT orderNumber, productCode FROM src_orderdetails) x",
        ["dw_orderdetail_id", "orderNumber", "productCode"])
    for key, cte, t in (("ref_customers_employee", "wh_customers", "customers"),
                        ("ref_employees_office", "wh1_employees", "employees"),
                        ("ref_employees_manager", "wh_employees", "employees"),
                        ("ref_products_line", "wh_products", "products"),
                        ("ref_orders_customer", "wh_orders", "orders"),
                        ("ref_orderdetails_order", "wh1_orderdetails", "orderdetails"),
                        ("ref_orderdetails_product", "wh_orderdetails", "orderdetails"),
                        ("ref_payments_customer", "wh_payments", "payments")):
        put(key, f"SELECT * FROM {cte}", _wh_cols(t))
    for t, key, tracked in (("customers", "dw_customer_id", "creditLimit"),
                            ("products", "dw_product_id", "MSRP")):
        cols = [f.name for f in history_schema(key, tracked).fields]
        put(f"scd2_close_{t}", f"SELECT * FROM histc_{t}", cols, _hist_ctes(t))
        put(f"scd2_open_{t}", f"SELECT * FROM histo_{t}", cols, _hist_ctes(t))
    fp = [("first_payment_cte", "SELECT dw_customer_id, MIN(paymentDate) AS first_payment_date "
                                "FROM wh_payments GROUP BY dw_customer_id")]
    ccols = [c for c, _ in D.CUSTOMER_COLUMNS]
    put("first_payment", "SELECT * FROM first_payment_cte", ["dw_customer_id", "first_payment_date"], fp)
    br = _daily_branches(B)
    for key, name in (("daily_new_customers", "new"), ("daily_products_ordered", "ordered"),
                      ("daily_cancelled_orders", "cancelled"), ("daily_shipped_orders", "shipped"),
                      ("daily_payments", "payments"), ("daily_open_orders", "open")):
        put(key, br[name], ccols, fp)
    put("daily_customer_summary", _daily_customer(B, RUN), ccols, fp)
    put("daily_customer_summary_additive_sum", _daily_customer(B, RUN, additive="sum"), ccols, fp)
    put("daily_customer_summary_additive_exact", _daily_customer_exact(B, RUN), ccols, fp)
    put("daily_customer_summary_customers_only", _daily_customer(B, RUN, new_customer="customers_only"),
        ccols, fp)
    pb = _product_branches(B)
    pcols = ["summary_date", "dw_product_id"] + [c for c, _ in D.PRODUCT_MEASURES]
    put("daily_product_ordered", pb["ordered"], pcols)
    put("daily_product_cancelled", pb["cancelled"], pcols)
    put("daily_product_summary", _daily_product(B, NO, B, RUN), [c for c, _ in D.PRODUCT_COLUMNS])
    for kind in ("customer", "product"):
        spec = M.CUSTOMER_ROLLUP if kind == "customer" else M.PRODUCT_ROLLUP
        cols = [c for c, _ in spec.columns]
        extra = fp + _monthly_ctes(kind)
        put(f"monthly_{kind}_update", f"SELECT * FROM monu_{kind[0]}", cols, extra)
        put(f"monthly_{kind}_insert", f"SELECT * FROM moni_{kind[0]}", cols, extra)
        put(f"monthly_{kind}_recompute", f"SELECT * FROM monr_{kind[0]}", cols, extra)
    return out
