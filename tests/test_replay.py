"""Three batches (initial, change, late parent) through ``run_batch``,
compared after each batch with DuckDB running the statement forms of a
warehouse (INSERT ... LEFT JOIN ... IS NULL, UPDATE ... FROM, history
UPDATE then INSERT, insert-only daily rows, monthly UPDATE then INSERT)
over all 8 tables, both histories and the 4 summaries. The statements are
generated from the table specifications. Stage rows are unique per key, so
the de-duplication fix does not change anything here."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest

from tallyhouse.checks import oracle as O
from tallyhouse.context import BatchContext
from tallyhouse.operators import daily as D
from tallyhouse.operators import monthly as M
from tallyhouse.plans.retail import HISTORIES, REFS, BatchLog, BatchOptions, run_batch
from tallyhouse.schemas import LOAD_ORDER, SPECS, history_schema
from tallyhouse.sources.csv_stage import write_delta_csv
from tallyhouse.sources.store import TableStore

T0 = "2024-01-01 00:00:00"


def _ts(s):
    return dt.datetime.fromisoformat(s)


def _ofc(code, city, terr, upd):
    return (code, city, None, None, None, None, "X", None, terr, _ts(T0), _ts(upd))


def _emp(no, name, office, reports, title, upd):
    return (no, name, None, None, None, office, reports, title, _ts(T0), _ts(upd))


def _cus(no, name, rep, credit, upd):
    return (no, name, "L", None, None, None, None, None, None, None, None, rep,
            None if credit is None else Decimal(credit), _ts(T0), _ts(upd))


BATCHES = [
    (BatchContext(1, dt.date(2024, 1, 1), _ts("2024-01-01 05:00:00")), {
        "offices": [_ofc("1", "Paris", "EMEA", "2024-01-01 01:00:00"), _ofc("2", "Tokyo", "APAC", "2024-01-01 01:00:00")],
        "employees": [_emp(1, "Boss", "1", None, "President", "2024-01-01 01:00:00"),
                      _emp(2, "Rep", "2", 1, "Sales Rep", "2024-01-01 01:00:00"),
                      _emp(3, "Far", "3", 2, "Sales Rep", "2024-01-01 01:00:00")],
        "customers": [_cus(10, "Acme", 2, "100.00", "2024-01-01 01:00:00"),
                      _cus(11, "Bolt", 9, "200.00", "2024-01-01 01:00:00"),
                      _cus(12, "Cog", 3, None, "2024-01-01 01:00:00")],
    }),
    (BatchContext(2, dt.date(2024, 1, 2), _ts("2024-01-02 05:00:00")), {
        "offices": [],
        "employees": [_emp(2, "Rep", "1", 1, "Senior Rep", "2024-01-02 01:00:00")],
        "customers": [_cus(10, "Acme Ltd", 2, "150.00", "2024-01-02 01:00:00"),
                      _cus(11, "Bolt", 9, "999.00", "2024-01-01 01:00:00"),   # not newer
                      _cus(13, "Dyn", 1, "50.00", "2024-01-02 01:00:00")],
    }),
    (BatchContext(3, dt.date(2024, 1, 3), _ts("2024-01-03 05:00:00")), {
        "offices": [_ofc("3", "Lima", "LATAM", "2024-01-03 01:00:00"),
                    _ofc("1", "Paris", "EU", "2024-01-03 01:00:00")],
        "employees": [_emp(9, "Late", "3", 1, "Sales Rep", "2024-01-03 01:00:00")],
        "customers": [_cus(12, "Cog", 3, "70.00", "2024-01-03 01:00:00"),     # NULL -> value
                      _cus(10, "Acme Ltd", 2, None, "2024-01-03 01:00:00")],   # value -> NULL
    }),
]

def _pl(line, text, upd):
    return (line, text, _ts(T0), _ts(upd))


def _prod(code, line, msrp, upd):
    return (code, f"name {code}", line, "1:10", "V", None, 5, Decimal("1.00"), None if msrp is None else Decimal(msrp), _ts(T0), _ts(upd))


def _ord(no, day, status, customer, upd, shipped=None, cancelled=None):
    d = [None if x is None else dt.date.fromisoformat(x) for x in (day, day, shipped, cancelled)]
    return (no, d[0], d[1], d[2], status, None, customer, _ts(f"{day} 02:00:00"), _ts(upd), d[3])


def _line(no, code, qty, price, upd):
    return (no, code, qty, Decimal(price), 1, _ts(T0), _ts(upd))


def _pay(customer, check, day, amount, upd):
    return (customer, check, dt.date.fromisoformat(day), Decimal(amount), _ts(T0), _ts(upd))


SALES = [
    {"productlines": [_pl("Cars", "cars", "2024-01-01 01:00:00"), _pl("Ships", None, "2024-01-01 01:00:00")],
     "products": [_prod("S1", "Cars", "10.00", "2024-01-01 01:00:00"), _prod("S2", "Trains", "20.00", "2024-01-01 01:00:00"),
                  _prod("S3", None, None, "2024-01-01 01:00:00")],
     "orders": [_ord(1, "2024-01-01", "In Process", 10, "2024-01-01 02:00:00"),
                _ord(2, "2024-01-01", None, 11, "2024-01-01 02:00:00"),
                _ord(3, "2024-01-01", " shipped", 10, "2024-01-01 02:00:00", shipped="2024-01-02"),
                _ord(4, "2024-01-01", "Cancelled ", None, "2024-01-01 02:00:00", cancelled="2024-01-01"),
                _ord(5, "2024-01-01", "In Process", 99, "2024-01-01 02:00:00")],
     "orderdetails": [_line(1, "S1", 2, "9.00", "2024-01-01 02:00:00"), _line(1, "S2", 1, "19.00", "2024-01-01 02:00:00"),
                      _line(2, "S1", 5, "8.00", "2024-01-01 02:00:00"), _line(3, "S2", 1, "18.00", "2024-01-01 02:00:00"),
                      _line(4, "S3", 7, "1.50", "2024-01-01 02:00:00"), _line(5, "S9", 1, "2.00", "2024-01-01 02:00:00"),
                      _line(8, "S1", 3, "7.00", "2024-01-01 02:00:00")],
     "payments": [_pay(10, "A", "2024-01-01", "5.00", "2024-01-01 02:00:00"), _pay(77, "B", "2024-01-01", "6.00", "2024-01-01 02:00:00")]},
    {"productlines": [_pl("Ships", "big ships", "2024-01-02 01:00:00")],
     "products": [_prod("S1", "Cars", "12.00", "2024-01-02 01:00:00"), _prod("S9", "Ships", "3.00", "2024-01-02 01:00:00")],
     "orders": [_ord(1, "2024-01-01", "Shipped", 10, "2024-01-02 02:00:00", shipped="2024-01-02"),
                _ord(6, "2024-01-02", "In Process", 13, "2024-01-02 02:00:00"), _ord(8, "2024-01-02", "", 12, "2024-01-02 02:00:00")],
     "orderdetails": [_line(6, "S9", 4, "2.50", "2024-01-02 02:00:00"), _line(6, "S1", 1, "11.00", "2024-01-02 02:00:00"),
                      _line(2, "S1", 6, "8.00", "2024-01-02 02:00:00")],
     "payments": [_pay(10, "C", "2024-01-02", "7.00", "2024-01-02 02:00:00"), _pay(13, "A", "2024-01-02", "9.00", "2024-01-02 02:00:00"),
                  _pay(77, "B", "2024-01-01", "6.50", "2024-01-02 02:00:00")]},
    {"productlines": [_pl("Trains", "late line", "2024-01-03 01:00:00")],
     "products": [_prod("S3", None, "4.00", "2024-01-03 01:00:00"), _prod("S1", "Cars", None, "2024-01-03 01:00:00")],
     "orders": [_ord(7, "2024-02-01", "In Process", 10, "2024-02-01 02:00:00")],
     "orderdetails": [_line(7, "S2", 2, "19.00", "2024-02-01 02:00:00")],
     "payments": []},
]
FULL = [(ctx, {**data, **sales}) for (ctx, data), sales in zip(BATCHES, SALES)]

TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def _type(t):
    return TYPES.get(t.simpleString(), t.simpleString().upper())


def _columns():
    """Columns of every warehouse table."""
    out = {t: SPECS[t].warehouse_columns() for t in LOAD_ORDER}
    out |= {h: [(f.name, f.dataType) for f in history_schema(key, tracked).fields] for h, (_, key, tracked) in HISTORIES.items()}
    out |= {"daily_customer_summary": D.CUSTOMER_COLUMNS, "daily_product_summary": D.PRODUCT_COLUMNS,
            "monthly_customer_summary": M.CUSTOMER_ROLLUP.columns, "monthly_product_summary": M.PRODUCT_ROLLUP.columns}
    return out


def _create(con, names):
    for t, cols in _columns().items():
        if t in names:
            con.execute(f"CREATE TABLE {t} ({', '.join(f'{c} {_type(ty)}' for c, ty in cols)})")


def _replay_table(con, spec, rows, ctx):
    no, day = ctx.batch_no, f"DATE '{ctx.batch_date}'"
    t, cols = spec.name, spec.source_names
    con.execute(f"CREATE OR REPLACE TABLE stage_{t} ({', '.join(f'{c} {_type(ty)}' for c, ty in spec.columns)})")
    # the load reads missing text as empty text
    rows = [["" if v is None and _type(ty) == "VARCHAR" else v for v, (_, ty) in zip(r, spec.columns)] for r in rows]
    if rows:
        con.executemany(f"INSERT INTO stage_{t} VALUES ({', '.join('?' * len(cols))})", rows)
    ik, uk = [[(spec.wh(k), k) for k in keys] for keys in (spec.insert_keys, spec.update_keys)]
    values = {spec.wh(c): f"s.{c}" for c in cols} | {r: "NULL" for r in spec.refs} | {"etl_batch_no": str(no), "etl_batch_date": day}
    if spec.id_col:
        order = ", ".join(f"s.{k}" for _, k in ik)
        values[spec.id_col] = f"(SELECT coalesce(max({spec.id_col}), 0) FROM {t}) + row_number() OVER (ORDER BY {order})"
    names = [c for c, _ in spec.warehouse_columns()]
    con.execute(f"INSERT INTO {t} ({', '.join(names)}) SELECT {', '.join(values[c] for c in names)} FROM stage_{t} s "
                f"LEFT JOIN {t} w ON {' AND '.join(f'w.{a} = s.{b}' for a, b in ik)} WHERE w.{ik[0][0]} IS NULL")
    sets = [f"{spec.wh(c)} = s.{c}" for c in (*spec.update_cols, "update_timestamp")]
    con.execute(f"UPDATE {t} SET {', '.join(sets)}, etl_batch_no = {no}, etl_batch_date = {day} FROM stage_{t} s "
                f"WHERE {' AND '.join(f'{t}.{a} = s.{b}' for a, b in uk)} AND s.update_timestamp > {t}.src_update_timestamp")
    for child, parent, key, pid, col in REFS.get(t, []):
        con.execute(f"UPDATE {t} SET {col} = p.v FROM (SELECT {key} AS k, {pid} AS v FROM {parent}) p WHERE {t}.{child} = p.k")


def _replay_history(con, table, ctx):
    dim, key, tracked = HISTORIES[table]
    no, day, now = ctx.batch_no, f"DATE '{ctx.batch_date}'", f"TIMESTAMP '{ctx.run_ts}'"
    con.execute(f"UPDATE {table} SET dw_active_record_ind = 0, effective_to_date = {day} - 1, update_etl_batch_no = {no}, "
                f"update_etl_batch_date = {day}, dw_update_timestamp = {now} FROM {dim} d WHERE {table}.dw_active_record_ind = 1 "
                f"AND {table}.{key} = d.{key} AND {table}.{tracked} <> d.{tracked}")
    new = {key: f"d.{key}", tracked: f"d.{tracked}", "effective_from_date": day, "dw_active_record_ind": "1", "dw_create_timestamp": now,
           "dw_update_timestamp": now, "create_etl_batch_no": str(no), "create_etl_batch_date": day}
    con.execute(f"INSERT INTO {table} ({', '.join(new)}) SELECT {', '.join(new.values())} FROM {dim} d LEFT JOIN {table} h "
                f"ON d.{key} = h.{key} AND h.dw_active_record_ind = 1 WHERE h.{key} IS NULL OR d.{tracked} <> h.{tracked}")


def _replay_monthly(con, table, daily, spec, ctx):
    day, now = f"DATE '{ctx.batch_date}'", f"TIMESTAMP '{ctx.run_ts}'"
    month = "CAST(date_trunc('month', summary_date) AS DATE)"
    values = {M.MONTH: month, spec.key: spec.key, "dw_create_timestamp": now, "dw_update_timestamp": now,
              "etl_batch_no": "max(etl_batch_no)", "etl_batch_date": "max(etl_batch_date)"}
    values |= {c: f"sum({c})" for c in spec.sums} | {f: f"max({f})" for f in spec.flags}
    values |= {spec.apm(f): f"max({f})" for f in spec.flags}
    agg = f"SELECT {', '.join(f'{values[c]} AS {c}' for c, _ in spec.columns)} FROM {{src}} GROUP BY {month}, {spec.key}"
    known = f"SELECT {M.MONTH} AS m, {spec.key} AS k FROM {table}"
    fresh = con.execute(agg.format(src=f"(SELECT d.* FROM {daily} d LEFT JOIN ({known}) o ON CAST(date_trunc('month', d.summary_date) "
                                       f"AS DATE) = o.m AND d.{spec.key} = o.k WHERE o.m IS NULL)")).fetchall()
    sets = [f"{c} = {table}.{c} + d.{c}" for c in spec.sums]
    for f in spec.flags:
        sets += [f"{c} = CASE WHEN {table}.{c} = 1 THEN 1 ELSE d.{f} END" for c in (f, spec.apm(f))]
    sets += [f"dw_update_timestamp = {now}", "etl_batch_no = d.etl_batch_no", "etl_batch_date = d.etl_batch_date"]
    delta = agg.format(src=f"(SELECT * FROM {daily} WHERE summary_date >= {day})")
    con.execute(f"UPDATE {table} SET {', '.join(sets)} FROM ({delta}) d WHERE {table}.{M.MONTH} = d.{M.MONTH} AND {table}.{spec.key} = d.{spec.key}")
    if fresh:
        con.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(spec.columns))})", fresh)


def _replay_batch(con, ctx, data):
    for t in LOAD_ORDER:
        _replay_table(con, SPECS[t], data[t], ctx)
    for h in HISTORIES:
        _replay_history(con, h, ctx)
    for t in ("customers", "orders", "orderdetails", "products", "payments"):
        con.execute(f"CREATE OR REPLACE VIEW wh_{t} AS SELECT * FROM {t}")
    day, now = f"DATE '{ctx.batch_date}'", f"TIMESTAMP '{ctx.run_ts}'"
    first = "WITH first_payment_cte AS (SELECT dw_customer_id, MIN(paymentDate) AS first_payment_date FROM wh_payments GROUP BY dw_customer_id)"
    for t, sql, cols in (("daily_customer_summary", f"{first} SELECT * FROM ({O._daily_customer(day, now)}) q", D.CUSTOMER_COLUMNS),
                         ("daily_product_summary", f"SELECT * FROM ({O._daily_product(day, ctx.batch_no, day, now)}) q", D.PRODUCT_COLUMNS)):
        names = ", ".join(c for c, _ in cols)
        con.execute(f"INSERT INTO {t} ({names}) SELECT {names} FROM ({sql}) r")
    for kind, spec in (("customer", M.CUSTOMER_ROLLUP), ("product", M.PRODUCT_ROLLUP)):
        _replay_monthly(con, f"monthly_{kind}_summary", f"daily_{kind}_summary", spec, ctx)


def _norm(rows):
    return sorted(tuple("NULL" if v is None else str(v) for v in r) for r in rows)


def _stage(spark, root, ctx, data, tables):
    for t in tables:
        write_delta_csv(spark.createDataFrame(data[t], SPECS[t].stage_schema()), root, t, ctx.batch_date)


def _table(store, name):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(c, t, True) for c, t in _columns()[name]])
    return store.read(name, schema)


SCOPES = {"all": {"ref_scope": "all", "history_scope": "all"}, "touched": {},
          "small parts": {"units": {t: "day" for t in LOAD_ORDER}, "block_ids": 2, "most_parts": 1}}


@pytest.mark.parametrize("scope", SCOPES)
def test_three_batches_match_statement_replay(spark, scratch, scope):
    con = duckdb.connect()
    _create(con, _columns())
    store = TableStore(spark, f"{scratch}/wh")
    opts = BatchOptions(**SCOPES[scope])
    for i, (ctx, data) in enumerate(FULL):
        root = f"{scratch}/stage{i}"
        _stage(spark, root, ctx, data, LOAD_ORDER)
        state = run_batch(spark, store, ctx, root, opts, clock=lambda ctx=ctx: ctx.run_ts)
        assert {r["etl_batch_no"]: r["etl_batch_status"] for r in state.collect()}[ctx.batch_no] == "C"
        _replay_batch(con, ctx, data)
        for t, cols in _columns().items():
            names = [c for c, _ in cols]
            ours = _table(store, t).select(*names).collect()
            theirs = con.execute(f"SELECT {', '.join(names)} FROM {t}").fetchall()
            assert _norm(ours) == _norm(theirs), (i, t)
    # the late parents healed the references
    emp = {r["employeeNumber"]: r for r in store.read("employees").collect()}
    cust = {r["src_customerNumber"]: r["dw_employee_id"] for r in store.read("customers").collect()}
    assert cust[11] == emp[9]["dw_employee_id"]            # rep 9 arrived in batch 3
    offices = {r["officeCode"]: r["dw_office_id"] for r in store.read("offices").collect()}
    assert emp[3]["dw_office_id"] == offices["3"]         # office 3 arrived in batch 3
    lines = {(r["src_orderNumber"], r["src_productCode"]): r for r in store.read("orderdetails").collect()}
    assert lines[5, "S9"]["dw_product_id"] and lines[8, "S1"]["dw_order_id"]  # product and order of batch 2
    steps = {(r["etl_batch_no"], r["step"]): r["row_count"] for r in BatchLog(store).step_rows().collect()}
    assert steps[1, "stage orders"] == 5 and steps[3, "stage payments"] == 0


def test_rerun_daily_append_duplicates_replace_dates_does_not(spark, scratch):
    # Q18: daily loading is insert-only by default, so rerunning a batch
    # appends its daily rows again; 'replace_dates' rewrites those dates.
    ctx, data = BATCHES[0]
    root = f"{scratch}/stage"
    _stage(spark, root, ctx, data, ("offices", "employees", "customers"))
    counts = {}
    for mode in ("append", "replace_dates"):
        store = TableStore(spark, f"{scratch}/wh-{mode}")
        opts = BatchOptions(tables=("offices", "employees", "customers"), daily_write=mode)
        sizes = []
        for _ in range(2):
            run_batch(spark, store, ctx, root, opts, clock=lambda: ctx.run_ts)
            sizes.append(store.read("daily_customer_summary").count())
        counts[mode] = sizes
    assert counts["append"][0] == 3 and counts["append"][1] == 6
    assert counts["replace_dates"] == [3, 3]


def test_write_modes_share_one_layout(spark, scratch):
    # append -> replace_dates -> append: rows of other dates stay, rows of
    # the batch's dates follow the mode.
    store = TableStore(spark, f"{scratch}/wh")
    tables = ("offices", "employees", "customers")
    empty = {"offices": [], "employees": [], "customers": []}
    sizes = []
    for i, mode in enumerate(("append", "append", "replace_dates", "append", "replace_dates")):
        day = 1 if i < 3 else 2
        ctx = BatchContext(i, dt.date(2024, 1, day), _ts(f"2024-01-0{day} 05:00:00"))
        data = BATCHES[0][1] if i == 0 else {**empty, "customers": [_cus(20, "New", 2, "1.00", "2024-01-02 01:00:00")]} if i == 3 else empty
        if i == 3:
            data["customers"] = [(*data["customers"][0][:-2], _ts("2024-01-02 01:00:00"), _ts("2024-01-02 01:00:00"))]
        _stage(spark, f"{scratch}/stage{i}", ctx, data, tables)
        run_batch(spark, store, ctx, f"{scratch}/stage{i}", BatchOptions(tables=tables, daily_write=mode), clock=lambda: ctx.run_ts)
        by_day = {str(r["summary_date"]): r["count"] for r in store.read("daily_customer_summary").groupBy("summary_date").count().collect()}
        sizes.append(by_day)
    assert sizes == [{"2024-01-01": 3}, {"2024-01-01": 6}, {"2024-01-01": 3},
                     {"2024-01-01": 3, "2024-01-02": 1}, {"2024-01-01": 3, "2024-01-02": 1}]


def test_extract_failure_is_logged_and_published_nothing(spark, scratch):
    from tallyhouse.plans import cli
    from tallyhouse.schemas import CONTROL_SCHEMA
    ctx, data = BATCHES[0]
    spark.createDataFrame([(ctx.batch_no, ctx.batch_date)], CONTROL_SCHEMA).write.parquet(f"{scratch}/control")
    for t, rows in data.items():
        df = spark.createDataFrame(rows, SPECS[t].stage_schema())
        (df.drop("city") if t == "offices" else df).write.parquet(f"{scratch}/src/CM_20240101/{t}")
    args = ["--control", f"{scratch}/control", "--sources", f"{scratch}/src", "--stage", f"{scratch}/stage",
            "--store", f"{scratch}/wh", "--tables", "offices,employees,customers", "--snapshots"]
    with pytest.raises(Exception):
        cli.main(args, spark)
    store = TableStore(spark, f"{scratch}/wh")
    assert [r["event"] for r in BatchLog(store).events().orderBy("seq").collect()] == ["R", "F"]
    assert not store.exists("offices")
    # repaired, the batch reads the dated snapshot and completes
    spark.createDataFrame(data["offices"], SPECS["offices"].stage_schema()).write.mode("overwrite").parquet(f"{scratch}/src/CM_20240101/offices")
    widths = '{"offices": {"city": 3}}'
    state = cli.main([*args, "--widths", widths, "--stage-format", "parquet", "--keep-commits", "2"], spark)
    assert [(r["etl_batch_no"], r["etl_batch_status"]) for r in state.collect()] == [(1, "C")]
    assert sorted(r["city"] for r in store.read("offices").collect()) == ["Par", "Tok"]


def test_command_line_batch(spark, scratch):
    # the command-line entry: control row -> extract -> batch -> log state
    from tallyhouse.plans import cli
    from tallyhouse.schemas import CONTROL_SCHEMA
    ctx, data = BATCHES[0]
    spark.createDataFrame([(0, dt.date(2023, 12, 31)), (ctx.batch_no, ctx.batch_date)], CONTROL_SCHEMA) \
        .write.parquet(f"{scratch}/control")
    for t, rows in data.items():
        spark.createDataFrame(rows, SPECS[t].stage_schema()).write.parquet(f"{scratch}/src/{t}")
    state = cli.main(["--control", f"{scratch}/control", "--sources", f"{scratch}/src",
                      "--stage", f"{scratch}/stage", "--store", f"{scratch}/wh",
                      "--tables", "offices,employees,customers"], spark)
    assert [(r["etl_batch_no"], r["etl_batch_status"]) for r in state.collect()] == [(1, "C")]
    assert TableStore(spark, f"{scratch}/wh").read("customers").count() == 3
