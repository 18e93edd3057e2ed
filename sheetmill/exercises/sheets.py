"""The tariff-sheet build on a sheet Spark lays out from ``lineitem`` aggregates;
K10 / K11: deployment tables laid out from ``orders``; K12: nested documents built from ``events``.

Line items become tariff levels, one sheet per block of suppliers (their number grows with
the data): return flag -> payment method, part key -> fuel, line status -> consumption
level, discount -> component, ship year -> period; value = shipped value in thousands.
Every sheet is laid out like the published workbook (one
section per payment method, four fuel blocks side by side, nil and typical tables with
period headings, total-inc-VAT rows in the dual-fuel block) and then tidied by
``tidy_tariff_tables``.  Blank cells (a level with no line items in a year) are filled
from the left as the source tool does; the oracle rebuilds the same result from the
aggregates.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sheetmill.exercises._registry import exercise, table
from sheetmill.exercises.grids import _notes_grid
from sheetmill.functions.numeric import to_number
from sheetmill.operators import grid as G
from sheetmill.operators.joins import map_values
from sheetmill.plans import bank_holidays as HP_BH
from sheetmill.plans import config as C
from sheetmill.plans import heat_pumps as HP
from sheetmill.plans import price_cap as K
from sheetmill.session import materialize

PAY_OF_FLAG = {"A": C.PAYMENT_METHODS[0], "N": C.PAYMENT_METHODS[1], "R": C.PAYMENT_METHODS[2]}
CONS_OF_STATUS = {"F": C.NIL, "O": C.TYPICAL}
COMPONENTS = ["DF", "NC", C.TOTAL, C.TOTAL_INC_VAT]
SECTION_ROWS = 14
SUPPLIERS = 10  # suppliers to a sheet


def _levels(spark, sf):
    li = table(spark, sf, "lineitem")
    base = li.select(
        F.concat(F.lit("suppliers "), F.floor(F.col("l_suppkey") / SUPPLIERS).cast("string")).alias("sheet_id"),
        map_values("l_returnflag", PAY_OF_FLAG).alias("pay"),
        F.element_at(F.array(*[F.lit(f) for f in C.FUELS]), (F.col("l_partkey") % 4 + 1).cast("int")).alias("fuel"),
        map_values("l_linestatus", CONS_OF_STATUS).alias("cons"),
        F.when(F.col("l_discount") < 0.05, F.lit("DF")).otherwise(F.lit("NC")).alias("comp"),
        F.year("l_shipdate").alias("y"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    ).where(F.col("pay").isNotNull() & F.col("cons").isNotNull() & F.col("y").isNotNull())
    # Component and total levels in ONE aggregation (grouping sets: one scan, one shuffle);
    # the result is a few hundred rows a sheet, written once so the layout steps never rescan
    # lineitem.  Decimal sums: exact, whatever the order of the rows.
    level = ["sheet_id", "pay", "fuel", "cons", "comp", "y"]
    sums = base.groupingSets([level, [c for c in level if c != "comp"]], *level).agg(
        (F.sum("price").cast("double") / 1000).alias("value"), F.grouping("comp").alias("__total")
    )
    parts = sums.where(F.col("__total") == 0).drop("__total")
    totals = sums.where(F.col("__total") == 1).withColumn("comp", F.lit(C.TOTAL)).drop("__total")
    inc_vat = totals.where(F.col("fuel") == C.DUAL_FUEL).withColumn("comp", F.lit(C.TOTAL_INC_VAT)).withColumn("value", F.col("value") * 1.05)
    return materialize(parts.unionByName(totals).unionByName(inc_vat), "k8-levels")


def _tariff_grid(spark, sf):
    levels = _levels(spark, sf)
    years = sorted(r["y"] for r in levels.select("y").distinct().collect())  # calendar years: a few
    lo, width = (years[0], years[-1] - years[0] + 1) if years else (0, 0)

    def block_col(fi):  # first column of a fuel block
        return 1 + fi * (width + 1)

    def section(pi):
        return 2 + pi * SECTION_ROWS

    pay_idx = {p: i for i, p in enumerate(C.PAYMENT_METHODS)}
    fuel_idx = {f: i for i, f in enumerate(C.FUELS)}
    # Fixed label cells (bounded: a few per payment x fuel x consumption x component).
    labels = [(0, 0, "Levels derived from line items")]
    for pi, pay in enumerate(C.PAYMENT_METHODS):
        s = section(pi)
        labels.append((s, 1, pay))
        for fi, fuel in enumerate(C.FUELS):
            labels.append((s + 1, block_col(fi), fuel))
            for off, cons in ((3, C.NIL), (8, C.TYPICAL)):
                labels.append((s + off, block_col(fi), cons))
                for ci, comp in enumerate(COMPONENTS):
                    if comp != C.TOTAL_INC_VAT or fuel == C.DUAL_FUEL:
                        labels.append((s + off + 1 + ci, block_col(fi), comp))
    # Period headings: one per (payment, fuel, consumption) block and year present in the data.
    blocks = [(section(pi) + off, block_col(fi)) for pi in range(3) for fi in range(4) for off in (3, 8)]
    labels += [(r, c + 1 + y - lo, f"January {y} - December {y}") for r, c in blocks for y in years]
    cells = F.array(*[F.struct(F.lit(r).alias("row_idx"), F.lit(c).alias("col_idx"), F.lit(v).alias("value")) for r, c, v in labels])
    fixed = levels.select("sheet_id").distinct().select("sheet_id", F.inline(cells))
    comp_idx = {c: i for i, c in enumerate(COMPONENTS)}
    row = (
        F.lit(2)
        + map_values("pay", pay_idx) * SECTION_ROWS
        + F.when(F.col("cons") == C.NIL, F.lit(3)).otherwise(F.lit(8))
        + 1
        + map_values("comp", comp_idx)
    )
    col = 1 + map_values("fuel", fuel_idx) * (width + 1) + 1 + F.col("y") - lo
    values = levels.select("sheet_id", row.cast("int").alias("row_idx"), col.cast("int").alias("col_idx"), F.col("value").cast("string").alias("value"))
    return fixed.unionByName(values)


def _combos_sql() -> str:
    rows = [
        f"('{p}', '{f}', '{c}', '{comp}')"
        for p in C.PAYMENT_METHODS
        for f in C.FUELS
        for c in (C.NIL, C.TYPICAL)
        for comp in COMPONENTS
        if comp != C.TOTAL_INC_VAT or f == C.DUAL_FUEL
    ]
    return "VALUES " + ", ".join(rows)


FUEL_CASE = "CASE l_partkey % 4 " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(C.FUELS)) + " END"
PAY_CASE = "CASE l_returnflag " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PAY_OF_FLAG.items()) + " END"
K8_SQL = f"""
WITH base AS (
  SELECT 'suppliers ' || CAST(l_suppkey // {SUPPLIERS} AS VARCHAR) AS sheet_id, {PAY_CASE} AS pay, {FUEL_CASE} AS fuel,
         CASE l_linestatus WHEN 'F' THEN 'Nil consumption' WHEN 'O' THEN 'Typical consumption' END AS cons,
         CASE WHEN l_discount < 0.05 THEN 'DF' ELSE 'NC' END AS comp,
         year(l_shipdate) AS y, CAST(l_extendedprice AS DECIMAL(18,2)) AS price
  FROM lineitem),
b AS (SELECT * FROM base WHERE pay IS NOT NULL AND cons IS NOT NULL AND y IS NOT NULL),
tot AS (SELECT sheet_id, pay, fuel, cons, y, CAST(sum(price) AS DOUBLE) / 1000 AS value FROM b GROUP BY ALL),
v AS (SELECT sheet_id, pay, fuel, cons, comp, y, CAST(sum(price) AS DOUBLE) / 1000 AS value FROM b GROUP BY ALL
      UNION ALL SELECT sheet_id, pay, fuel, cons, 'Total_GB average', y, value FROM tot
      UNION ALL SELECT sheet_id, pay, fuel, cons, 'Total inc VAT', y, value * 1.05::DOUBLE FROM tot WHERE fuel = 'Dual fuel (implied)'),
sheets AS (SELECT DISTINCT sheet_id FROM b),
combos AS (SELECT * FROM ({_combos_sql()}) t(pay, fuel, cons, comp)),
years AS (SELECT DISTINCT y FROM b),
cells AS (SELECT sheets.sheet_id, c.pay, c.fuel, c.cons, c.comp, years.y, v.value
          FROM combos c JOIN years ON true JOIN sheets ON true LEFT JOIN v ON v.sheet_id = sheets.sheet_id AND v.pay = c.pay AND v.fuel = c.fuel AND v.cons = c.cons AND v.comp = c.comp AND v.y = years.y),
filled AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY sheet_id, pay, fuel, cons, comp ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM cells)
SELECT sheet_id, pay AS payment_method, fuel, cons AS consumption, comp AS tariff_component,
       'Jan ' || CAST(y AS VARCHAR) || ' - Dec ' || CAST(y AS VARCHAR) AS period, f AS value
FROM filled
"""


@exercise("K8_tidy_tariff_tables", K8_SQL)
def k8_tidy_tariff_tables(spark, sf):
    """Sheets laid out from lineitem levels -> sections -> blocks -> tidy levels."""
    tidy = K.tidy_tariff_tables(_tariff_grid(spark, sf))
    return tidy.select(
        "sheet_id",
        F.col(f"`{K.PAYMENT}`").alias("payment_method"),
        F.col(K.FUEL).alias("fuel"),
        F.col(K.CONSUMPTION).alias("consumption"),
        F.col(f"`{K.COMPONENT}`").alias("tariff_component"),
        F.col(f"`{C.PERIOD_COL}`").alias("period"),
        to_number(K.VALUE).alias("value"),
    )


# ------------------------------------------------------------------ K10 (Table 1.1 from orders)

HP_TITLE = "Table 1.1 Installations by type, orders of "
CUSTOMERS = 10  # customers to a Table 1.1 sheet
# Fixed cells of every sheet: (row, column, text).  Row 3 is a fully blank separator row.
HP_FIXED = [
    (1, 0, "Quarterly counts derived from the orders table."),
    (2, 0, "Source: orders table"),
    (4, 0, f"{C.QUARTER_HEADER}\n"),
    (4, 1, f"{C.TYPE_VALUE_VARS[0]} [note 1]"),
    (4, 2, C.TYPE_VALUE_VARS[1]),
    (4, 3, " Total heat pump \ninstallations"),
]
HP_META = {"publisher": "test tables", "filename": "orders.parquet", "publication_date": "2026-01-01", "page_url": "local"}


def _customer_block(size):
    return F.concat(F.lit("customers "), F.floor(F.col("o_custkey") / size).cast("string"))


def _order_notes(spark, sf):
    """A notes sheet per block of customers: its first and its last order date."""
    day = lambda d: F.date_format(d, "yyyy-MM-dd")
    dates = table(spark, sf, "orders").groupBy(_customer_block(CUSTOMERS).alias("sheet_id")).agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    texts = [F.concat(F.lit("First order "), day("lo")), F.lit("A superseded text"), F.concat(F.lit("Last order "), day("hi"))]
    lines = [F.struct(F.lit(i + 2).alias("r"), F.lit(n).alias("Note number"), t.alias("Note text")) for i, (n, t) in enumerate(zip(("note 1", "note 2", "note 2"), texts, strict=True))]
    return G.grid_from_table(dates.select("sheet_id", F.inline(F.array(*lines))), "sheet_id", "r", ["Note number", "Note text"], header_row=1)


def _installations_grid(spark, sf):
    """One Table 1.1 sheet per block of customers (their number grows with the data): a row
    per order quarter (tagged [note 2] in Q1), counts of status F / O orders as the two
    technologies, and of all orders as the total."""
    orders = table(spark, sf, "orders")
    counts = orders.groupBy(_customer_block(CUSTOMERS).alias("sheet_id"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("a"), F.count_if(F.col("o_orderstatus") == "O").alias("g"), F.count(F.lit(1)).alias("t")
    )
    label = F.concat(F.col("y").cast("string"), F.lit(" Q"), F.col("q").cast("string"), F.when(F.col("q") == 1, F.lit(" [note 2]")).otherwise(F.lit("")))
    row = (F.lit(5) + F.col("y") * 4 + F.col("q")).cast("int")
    values = [label, F.col("a").cast("string"), F.col("g").cast("string"), F.col("t").cast("string")]
    body = counts.select("sheet_id", row.alias("row_idx"), F.inline(F.array(*[F.struct(F.lit(i).alias("col_idx"), v.alias("value")) for i, v in enumerate(values)])))
    sheets = counts.select("sheet_id").distinct()
    fixed = [F.struct(F.lit(0).alias("row_idx"), F.lit(0).alias("col_idx"), F.concat(F.lit(HP_TITLE), F.col("sheet_id")).alias("value"))]
    fixed += [F.struct(F.lit(r).alias("row_idx"), F.lit(c).alias("col_idx"), F.lit(v).alias("value")) for r, c, v in HP_FIXED]
    return body.unionByName(sheets.select("sheet_id", F.inline(F.array(*fixed))))


K10_SQL = f"""
WITH c AS (
  SELECT 'customers ' || CAST(o_custkey // {CUSTOMERS} AS VARCHAR) AS sheet_id, year(o_orderdate) AS y, quarter(o_orderdate) AS q,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS a, count(*) FILTER (WHERE o_orderstatus = 'O') AS g, count(*) AS t
  FROM orders GROUP BY ALL),
n AS (
  SELECT 'customers ' || CAST(o_custkey // {CUSTOMERS} AS VARCHAR) AS sheet_id, 'First order ' || strftime(min(o_orderdate), '%Y-%m-%d') AS n1,
         'Last order ' || strftime(max(o_orderdate), '%Y-%m-%d') AS n2
  FROM orders GROUP BY 1),
r AS (
  SELECT sheet_id, '{HP_TITLE}' || sheet_id AS table_name,
         CAST(y AS VARCHAR) || ' Q' || CAST(q AS VARCHAR) AS installation_quarter,
         CAST(make_date(y, q * 3 - 2, 1) AS TIMESTAMP) AS installation_quarter_start,
         CAST(last_day(make_date(y, q * 3, 1)) AS TIMESTAMP) AS installation_quarter_end,
         ' ' || n1 || ' ' || CASE WHEN q = 1 THEN n2 ELSE '' END AS notes,
         a, g, t
  FROM c JOIN n USING (sheet_id))
SELECT sheet_id, table_name, installation_quarter, installation_quarter_start, installation_quarter_end, notes,
       '{C.TYPE_VALUE_VARS[0]}' AS type, CAST(a AS BIGINT) AS value FROM r
UNION ALL SELECT sheet_id, table_name, installation_quarter, installation_quarter_start, installation_quarter_end, notes,
       '{C.TYPE_VALUE_VARS[1]}', CAST(g AS BIGINT) FROM r
UNION ALL SELECT sheet_id, table_name, installation_quarter, installation_quarter_start, installation_quarter_end, notes,
       '{C.TYPE_VALUE_VARS[2]}', CAST(t AS BIGINT) FROM r
"""


@exercise("K10_heat_pumps_by_type", K10_SQL)
def k10_heat_pumps_by_type(spark, sf):
    """Table 1.1 sheets laid out from orders (one per block of customers, all tidied in one
    plan): title/source facts, header promotion and cleaning, column and row note tags
    resolved from each workbook's own notes sheet, quarter bounds, melt, contract."""
    notes = G.notes_lookup(_order_notes(spark, sf))
    out = HP.heat_pumps_by_type(_installations_grid(spark, sf), notes, HP_META, keep_sheet=True)
    return out.select(
        "sheet_id",
        F.col("metadata")["table_name"].alias("table_name"),
        "installation_quarter",
        "installation_quarter_start",
        "installation_quarter_end",
        "notes",
        "type",
        "value",
    )


# ------------------------------------------------------------------ K11 (Table 1.2 from orders)

HP_REGION_TITLE = "Table 1.2 Installations by region, orders of "
REGION_CUSTOMERS = 50  # customers to a Table 1.2 sheet
N_AREAS = len(C.REGION_VALUE_VARS)


def _regions_grid(spark, sf):
    """One Table 1.2 sheet per block of customers: a row per order quarter (tagged [note 3] in
    Q4) and one column per area, counting the orders whose customer key falls in that
    area's bucket (customer key modulo the number of areas)."""
    orders = table(spark, sf, "orders")
    k = F.col("o_custkey") % N_AREAS
    counts = orders.groupBy(_customer_block(REGION_CUSTOMERS).alias("sheet_id"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")).agg(
        *[F.count_if(k == j).alias(f"n{j}") for j in range(N_AREAS)]
    )
    label = F.concat(F.col("y").cast("string"), F.lit(" Q"), F.col("q").cast("string"), F.when(F.col("q") == 4, F.lit(" [note 3]")).otherwise(F.lit("")))
    row = (F.lit(4) + F.col("y") * 4 + F.col("q")).cast("int")
    values = [label, *[F.col(f"n{j}").cast("string") for j in range(N_AREAS)]]
    body = counts.select("sheet_id", row.alias("row_idx"), F.inline(F.array(*[F.struct(F.lit(i).alias("col_idx"), v.alias("value")) for i, v in enumerate(values)])))
    fixed = [F.struct(F.lit(0).alias("row_idx"), F.lit(0).alias("col_idx"), F.concat(F.lit(HP_REGION_TITLE), F.col("sheet_id")).alias("value"))]
    cells = [(1, 0, "Source: orders table"), (3, 0, C.QUARTER_HEADER)] + [(3, 1 + j, name) for j, name in enumerate(C.REGION_VALUE_VARS)]
    fixed += [F.struct(F.lit(r).alias("row_idx"), F.lit(c).alias("col_idx"), F.lit(v).alias("value")) for r, c, v in cells]
    sheets = counts.select("sheet_id").distinct()
    return body.unionByName(sheets.select("sheet_id", F.inline(F.array(*fixed))))


def _areas_sql() -> str:
    rows = [f"({j}, '{n}', '{C.AREA_CODES.get(n, 'N/A')}', '{C.GEOGRAPHIC_LEVEL[n]}')" for j, n in enumerate(C.REGION_VALUE_VARS)]
    return "VALUES " + ", ".join(rows)


K11_SQL = f"""
WITH b AS (SELECT 'customers ' || CAST(o_custkey // {REGION_CUSTOMERS} AS VARCHAR) AS pr, year(o_orderdate) AS y, quarter(o_orderdate) AS q, o_custkey % {N_AREAS} AS k FROM orders),
g AS (SELECT DISTINCT pr, y, q FROM b),
cnt AS (SELECT pr, y, q, k, count(*) AS n FROM b GROUP BY ALL),
areas AS (SELECT * FROM ({_areas_sql()}) t(k, name, code, lvl))
SELECT g.pr AS sheet_id, '{HP_REGION_TITLE}' || g.pr AS table_name,
       CAST(g.y AS VARCHAR) || ' Q' || CAST(g.q AS VARCHAR) AS installation_quarter,
       CAST(make_date(g.y, g.q * 3 - 2, 1) AS TIMESTAMP) AS installation_quarter_start,
       CAST(last_day(make_date(g.y, g.q * 3, 1)) AS TIMESTAMP) AS installation_quarter_end,
       ' ' || CASE WHEN g.q = 4 THEN (SELECT r_name FROM region WHERE r_regionkey = 3) ELSE '' END AS notes,
       areas.name AS country_or_region, CAST(COALESCE(cnt.n, 0) AS BIGINT) AS value,
       areas.code AS area_code, areas.lvl AS geographic_level
FROM g JOIN areas ON true
LEFT JOIN cnt ON cnt.pr = g.pr AND cnt.y = g.y AND cnt.q = g.q AND cnt.k = areas.k
"""


@exercise("K11_heat_pumps_by_region", K11_SQL)
def k11_heat_pumps_by_region(spark, sf):
    """Table 1.2 sheets laid out from orders (one per block of customers): as K10, with one
    notes sheet for all, plus area code (default 'N/A') and geographic level."""
    notes = G.notes_lookup(_notes_grid(spark, sf)).drop("sheet_id")
    out = HP.heat_pumps_by_region(_regions_grid(spark, sf), notes, HP_META, keep_sheet=True)
    return out.select(
        "sheet_id",
        F.col("metadata")["table_name"].alias("table_name"),
        "installation_quarter",
        "installation_quarter_start",
        "installation_quarter_end",
        "notes",
        "country_or_region",
        "value",
        "area_code",
        "geographic_level",
    )


# ------------------------------------------------------------------ K12 (bank-holiday documents from events)

DIVISION_OF_TYPE = {"purchase": "england-and-wales", "view": "scotland", "click": "northern-ireland"}
OTHER_DIVISION = "england-and-wales"  # of every other event type


def _holiday_documents(spark, sf):
    """Nested documents shaped like the bank-holiday feed, built from events: one document
    per (user, day, block of 16 event ids), so no document holds more than 16 events even
    for a hot user; map key = division, the scotland entries leave ``division`` out (it
    defaults to the key), notes and bunting are sometimes absent (defaults "" / false)."""
    ev = table(spark, sf, "events")
    div = map_values("event_type", DIVISION_OF_TYPE, default=OTHER_DIVISION)
    doc_key = [F.col("user_id"), F.to_date("ts").alias("day"), F.floor(F.col("event_id") / 16).alias("blk")]
    event = F.struct(
        F.concat(F.lit("Event "), F.col("event_id").cast("string")).alias("title"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.when(F.col("value") > 50, F.lit("high")).alias("notes"),
        F.when(F.col("value") > 80, F.lit(True)).alias("bunting"),
    )
    per_div = ev.groupBy(*doc_key, div.alias("key")).agg(F.collect_list(event).alias("events"))
    entry = F.struct(F.col("key"), F.struct(F.when(F.col("key") != "scotland", F.col("key")).alias("division"), F.col("events")))
    return per_div.groupBy("user_id", "day", "blk").agg(F.map_from_entries(F.collect_list(entry)).alias("doc"))


K12_SQL = """
SELECT CASE event_type WHEN 'view' THEN 'scotland' WHEN 'click' THEN 'northern-ireland' ELSE 'england-and-wales' END AS division,
       'Event ' || CAST(event_id AS VARCHAR) AS title,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date,
       CASE WHEN value > 50 THEN 'high' ELSE '' END AS notes,
       COALESCE(value > 80, false) AS bunting,
       CAST(year(ts) AS BIGINT) AS year
FROM events
"""


@exercise("K12_bank_holidays", K12_SQL)
def k12_bank_holidays(spark, sf):
    """Nested documents -> flatten (map key default, notes/bunting defaults) -> exact date
    parse -> strict contract."""
    return HP_BH.silver_bank_holidays(_holiday_documents(spark, sf))
