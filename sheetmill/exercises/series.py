"""H (series), I (checks), J (scalar functions) and K (gold metrics) on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheetmill.exercises._registry import exercise, table
from sheetmill.functions import dates as J
from sheetmill.functions.numeric import round_half_even
from sheetmill.functions.text import extract_or_null, slugify_col, strip
from sheetmill.operators import contracts as I
from sheetmill.operators.calendar import mark_latest, unknown_periods, url_month_is_latest
from sheetmill.operators.joins import union_all
from sheetmill.operators.timeseries import carry_forward, diff, pct_change, period_over_period
from sheetmill.plans import config as C
from sheetmill.plans import price_cap as K
from sheetmill.session import materialize, scratch_path
from sheetmill.sources import files
from sheetmill.streaming.series import publish_changes

ASOF = "1998-08-02 00:00:00"

# ------------------------------------------------------------------ H


def _monthly_by_priority(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy("o_orderpriority", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")).agg(F.round(F.sum("o_totalprice"), 2).alias("value"))


@exercise(
    "H1_diff",
    """WITH m AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY ALL)
       SELECT o_orderpriority, month, value, round(value - lag(value) OVER (PARTITION BY o_orderpriority ORDER BY month), 2) AS change FROM m""",
)
def h1_diff(spark, sf):
    out = diff(_monthly_by_priority(spark, sf), ["o_orderpriority"], ["month"], "value", "change")
    return out.withColumn("change", F.round("change", 2))


H2_SQL = """
WITH d AS (
  SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day,
         CASE WHEN day(ts) % 7 = 0 THEN NULL ELSE round(sum(value), 2) END AS value
  FROM events GROUP BY event_type, CAST(date_trunc('day', ts) AS TIMESTAMP), day(ts)),
f AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM d),
p AS (SELECT *, lag(f) OVER (PARTITION BY event_type ORDER BY day) AS pf FROM f)
SELECT event_type, day, value,
       CASE WHEN f IS NULL OR pf IS NULL THEN NULL
            WHEN pf = 0 THEN CASE WHEN f > 0 THEN 'inf'::DOUBLE WHEN f < 0 THEN '-inf'::DOUBLE END
            ELSE round_even((f / pf - 1) * 100, 2) END AS pct
FROM p
"""


@exercise("H2_pct_change", H2_SQL)
def h2_pct_change(spark, sf):
    """Daily value per event type with gaps (every 7th day blanked): percent change with
    values padded over the gaps."""
    ev = table(spark, sf, "events")
    daily = ev.groupBy("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), F.dayofmonth("ts").alias("dom")).agg(F.round(F.sum("value"), 2).alias("value"))
    daily = daily.withColumn("value", F.when(F.col("dom") % 7 == 0, F.lit(None)).otherwise(F.col("value"))).drop("dom")
    return pct_change(daily, ["event_type"], ["day"], "value", out="pct")


K7_SQL = """
WITH m AS (SELECT o_orderstatus, o_orderpriority, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY ALL),
p AS (SELECT *, lag(value) OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY month) AS prev FROM m)
SELECT o_orderstatus, o_orderpriority, month, value, value - prev AS change,
       CASE WHEN prev IS NULL THEN NULL WHEN prev = 0 THEN NULL ELSE round_even((value / prev - 1) * 100, 2) END AS pct
FROM p
"""


@exercise("K7_period_over_period", K7_SQL)
def k7_period_over_period(spark, sf):
    """Monthly order counts per (status, priority): change and percent change, planned
    with the hot-key split (one window per (key, year), carries across years)."""
    o = table(spark, sf, "orders")
    m = o.groupBy("o_orderstatus", "o_orderpriority", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return period_over_period(m, ["o_orderstatus", "o_orderpriority"], ["month"], "value", "change", "pct", split_by=F.year("month"))


# ------------------------------------------------------------------ I

PROPS_PATTERN = r'^\{"k": \d+\}$'


def event_rules() -> list[I.Rule]:
    return [
        I.isin("event_type", ["view", "signup", "purchase", "click"]),
        I.ge("value", 0),
        I.not_null("user_id"),
        I.matches("props", PROPS_PATTERN),
    ]


I1_SQL = f"""
SELECT 'event_type isin' AS rule, count(*) FILTER (WHERE event_type IS NOT NULL AND event_type NOT IN ('view', 'signup', 'purchase', 'click')) AS violations FROM events
UNION ALL SELECT 'value >= 0', count(*) FILTER (WHERE value < 0) FROM events
UNION ALL SELECT 'user_id not null', count(*) FILTER (WHERE user_id IS NULL) FROM events
UNION ALL SELECT 'props matches {PROPS_PATTERN}', count(*) FILTER (WHERE props IS NOT NULL AND NOT regexp_full_match(props, '\\{{"k": \\d+\\}}')) FROM events
"""


@exercise("I1_contract_violations", I1_SQL)
def i1_contract_violations(spark, sf):
    """Violation count per rule of an events contract, all rules in one aggregation."""
    return I.violation_counts(table(spark, sf, "events"), event_rules())


@exercise(
    "I2_isin",
    "SELECT 'o_orderpriority isin' AS rule, count(*) FILTER (WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')) AS violations FROM orders",
)
def i2_isin(spark, sf):
    return I.violation_counts(table(spark, sf, "orders"), [I.isin("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"])])


@exercise("I3_ge", "SELECT 'l_discount >= 0.05' AS rule, count(*) FILTER (WHERE l_discount < 0.05) AS violations FROM lineitem")
def i3_ge(spark, sf):
    return I.violation_counts(table(spark, sf, "lineitem"), [I.ge("l_discount", 0.05)])


@exercise("I4_not_null", "SELECT 'quality not null' AS rule, count(*) FILTER (WHERE l.quality IS NULL) AS violations FROM documents d LEFT JOIN labels l USING (doc_id)")
def i4_not_null(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return I.violation_counts(joined, [I.not_null("quality")])


I5_SQL = """
WITH t AS (
  SELECT o_orderkey, 'Total_GB average' AS component, o_totalprice AS value FROM orders
  UNION ALL
  SELECT l_orderkey, 'L' || CAST(l_linenumber AS VARCHAR), l_extendedprice * (1 + l_tax) * (1 - l_discount) FROM lineitem),
g AS (SELECT o_orderkey, COALESCE(sum(value) FILTER (WHERE component <> 'Total_GB average'), 0) AS components,
             COALESCE(sum(value) FILTER (WHERE component = 'Total_GB average'), 0) AS total FROM t GROUP BY o_orderkey)
SELECT o_orderkey, round(components, 2) AS components, round(total, 2) AS total, round(components, 6) = round(total, 6) AS ok FROM g
"""


@exercise("I5_components_sum_to_total", I5_SQL)
def i5_components_sum_to_total(spark, sf):
    """Line-item components (price incl. tax, net of discount) against the order total, per order."""
    o = table(spark, sf, "orders").select("o_orderkey", F.lit(C.TOTAL).alias("component"), F.col("o_totalprice").alias("value"))
    li = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("component"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax")) * (1 - F.col("l_discount"))).alias("value"),
    )
    out = I.components_sum_to_total(union_all([o, li]), ["o_orderkey"], component_col="component")
    return out.select("o_orderkey", F.round("components", 2).alias("components"), F.round("total", 2).alias("total"), "ok")


@exercise(
    "I5b_components_sum_exact",
    """SELECT l_orderkey, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) AS components,
              CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) AS total, true AS ok FROM lineitem GROUP BY l_orderkey""",
)
def i5b_components_sum_exact(spark, sf):
    """Prices in cents per order, each beside 1e18 and -1e18 as further components, against the
    sum of whole numbers: only exact sums let the large ones cancel and the cents stay."""
    li = table(spark, sf, "lineitem").select("l_orderkey", F.round(F.col("l_extendedprice") * 100).alias("cents"))
    parts = li.select("l_orderkey", F.lit("part").alias("component"), F.explode(F.array(F.lit(1e18), F.col("cents"), F.lit(-1e18))).alias("value"))
    total = li.groupBy("l_orderkey").agg(F.sum(F.col("cents").cast("long")).cast("double").alias("value")).select("l_orderkey", F.lit(C.TOTAL).alias("component"), "value")
    return I.components_sum_to_total(union_all([parts, total]), ["l_orderkey"], component_col="component", exact=True)


def _long_month_periods(spark, sf):
    o = table(spark, sf, "orders")
    start = F.date_trunc("month", "o_orderdate")
    return o.select(F.concat(F.date_format(start, "MMMM yyyy"), F.lit(" - "), F.date_format(F.add_months(start, 2), "MMMM yyyy")).alias("period"))


LONG_PERIOD_SQL = "strftime(o_orderdate, '%B %Y') || ' - ' || strftime(o_orderdate + INTERVAL 2 MONTH, '%B %Y')"


@exercise(
    "I6_matches_pattern",
    f"SELECT DISTINCT {LONG_PERIOD_SQL} AS period FROM orders WHERE NOT regexp_full_match({LONG_PERIOD_SQL}, '[A-Z][a-z]{{2}} \\d{{4}} - [A-Z][a-z]{{2}} \\d{{4}}')",
)
def i6_matches_pattern(spark, sf):
    """Period labels not in the normalised 'Mon yyyy - Mon yyyy' form (distinct offenders)."""
    periods = _long_month_periods(spark, sf)
    rule = I.matches("period", C.NORMALISED_PERIOD_PATTERN)
    return periods.where(rule.violation).distinct()


def _quarter_periods(spark, sf):
    o = table(spark, sf, "orders")
    qs = F.date_trunc("quarter", "o_orderdate").cast("date")
    qe = F.add_months(qs, 2)
    return o.select(
        F.concat(F.lit("1 "), F.date_format(qs, "MMMM"), F.lit(" to "), F.dayofmonth(F.last_day(qe)).cast("string"), F.lit(" "), F.date_format(qe, "MMMM"), F.lit(" "), F.year(qs).cast("string")).alias("period")
    ).distinct()


QUARTER_SQL = """(SELECT DISTINCT '1 ' || strftime(qs, '%B') || ' to ' || CAST(day(last_day(qs + INTERVAL 2 MONTH)) AS VARCHAR) || ' ' || strftime(qs + INTERVAL 2 MONTH, '%B') || ' ' || CAST(year(qs) AS VARCHAR) AS period, qs
   FROM (SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS qs FROM orders))"""
CALENDAR_LIST = ", ".join("'" + p + "'" for p in C.PERIOD_PUBLICATION_DATES)


@exercise("I7_period_known", f"SELECT period FROM {QUARTER_SQL} q WHERE period NOT IN ({CALENDAR_LIST})")
def i7_period_known(spark, sf):
    """Order quarters as period labels that the publication calendar does not have."""
    return unknown_periods(_quarter_periods(spark, sf), C.publication_calendar(spark))


def _monthly_calendar(spark, sf):
    """(period, publication_date) per month, from orders."""
    return table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("period")).agg(F.min("o_orderdate").alias("publication_date"))


def _asof():
    return F.lit(ASOF).cast("timestamp_ntz")


@exercise(
    "I8_period_is_latest",
    f"""WITH c AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, min(o_orderdate) AS publication_date FROM orders GROUP BY 1)
        SELECT period, publication_date, publication_date = (SELECT max(publication_date) FROM c WHERE publication_date <= TIMESTAMP '{ASOF}') AS is_latest FROM c""",
)
def i8_period_is_latest(spark, sf):
    """Monthly publication calendar derived from orders; which period is the latest published as of a date."""
    return mark_latest(_monthly_calendar(spark, sf), _asof())


@exercise(
    "I9_url_month_is_latest",
    f"""WITH c AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, min(o_orderdate) AS publication_date FROM orders GROUP BY 1),
             l AS (SELECT strftime(max(publication_date), '%Y-%m') AS m FROM c WHERE publication_date <= TIMESTAMP '{ASOF}')
        SELECT regexp_extract('https://example.org/files/' || strftime(o_orderdate, '%Y-%m') || '/annex.xlsx', '(\\d{{4}}-\\d{{2}})', 1) = (SELECT m FROM l) AS ok, count(*) AS n
        FROM orders GROUP BY 1""",
)
def i9_url_month_is_latest(spark, sf):
    """File URLs stamped with the order month: does the URL month equal the month of the latest publication?"""
    o = table(spark, sf, "orders").select(F.concat(F.lit("https://example.org/files/"), F.date_format("o_orderdate", "yyyy-MM"), F.lit("/annex.xlsx")).alias("url"))
    rule = url_month_is_latest("url", _monthly_calendar(spark, sf), _asof())
    return o.select((~rule.violation).alias("ok")).groupBy("ok").agg(F.count(F.lit(1)).alias("n"))


@exercise(
    "I10_fresh_within_months",
    f"""SELECT o_orderpriority, ({1998 * 12 + 8} - (year(o_orderdate) * 12 + month(o_orderdate))) <= 3 AS fresh, count(*) AS n FROM orders GROUP BY ALL""",
)
def i10_fresh_within_months(spark, sf):
    rule = I.fresh_within_months("o_orderdate", _asof(), 3)
    return table(spark, sf, "orders").groupBy("o_orderpriority", (~rule.violation).alias("fresh")).agg(F.count(F.lit(1)).alias("n"))


@exercise("I11_starts_with", "SELECT doc_id, coalesce(starts_with(lower(text), 'the'), false) AS starts FROM documents")
def i11_starts_with(spark, sf):
    return table(spark, sf, "documents").select("doc_id", (~I.starts_with("text", "The").violation).alias("starts"))


@exercise("I12_has_extension", "SELECT page_id, coalesce(ends_with(lower(url), '.html'), false) AS is_html FROM pages")
def i12_has_extension(spark, sf):
    return table(spark, sf, "pages").select("page_id", (~I.has_extension("url", ".HTML").violation).alias("is_html"))


# ------------------------------------------------------------------ J


@exercise(
    "J1_parse_cap_period",
    f"""SELECT period, CAST(qs AS TIMESTAMP) AS period_left,
               CAST(last_day(qs + INTERVAL 2 MONTH) AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 SECOND AS period_right
        FROM {QUARTER_SQL} q""",
)
def j1_parse_cap_period(spark, sf):
    p = _quarter_periods(spark, sf).withColumn("iv", J.parse_cap_period("period", strict=True))
    return p.select("period", F.col("iv.left").alias("period_left"), F.col("iv.right").alias("period_right"))


@exercise(
    "J2_cap_period_key",
    f"""SELECT period, strftime(qs, '%Y-%m-%d') || '_to_' || strftime(last_day(qs + INTERVAL 2 MONTH), '%Y-%m-%d') AS period_key FROM {QUARTER_SQL} q
        UNION ALL
        SELECT replace(period, ' to ', ' ' || CAST(year(qs) AS VARCHAR) || ' to '), strftime(qs, '%Y-%m-%d') || '_to_' || strftime(last_day(qs + INTERVAL 2 MONTH), '%Y-%m-%d') FROM {QUARTER_SQL} q""",
)
def j2_cap_period_key(spark, sf):
    """Period keys from both label forms (start year implied, and start year given)."""
    p = _quarter_periods(spark, sf)
    implied = p
    y = F.regexp_extract("period", r"(\d{4})$", 1)
    explicit = p.select(F.concat(F.regexp_extract("period", r"^(.*?) to ", 1), F.lit(" "), y, F.lit(" to "), F.regexp_extract("period", r" to (.*)$", 1)).alias("period"))
    both = implied.unionByName(explicit)
    return both.select("period", J.cap_period_key("period", strict=True).alias("period_key"))


MONTH_RANGE_SQL = """(SELECT DISTINCT strftime(ms, '%b %Y') || ' - ' || strftime(ms + INTERVAL 2 MONTH, '%b %Y') AS period, ms
   FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ms FROM orders)
   UNION
   SELECT DISTINCT strftime(ms, '%B %Y') || ' to ' || strftime(ms + INTERVAL 2 MONTH, '%B %Y'), ms
   FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ms FROM orders))"""


def _month_ranges(spark, sf):
    o = table(spark, sf, "orders")
    ms = F.date_trunc("month", "o_orderdate").cast("date")
    short = o.select(F.concat(F.date_format(ms, "MMM yyyy"), F.lit(" - "), F.date_format(F.add_months(ms, 2), "MMM yyyy")).alias("period"))
    long = o.select(F.concat(F.date_format(ms, "MMMM yyyy"), F.lit(" to "), F.date_format(F.add_months(ms, 2), "MMMM yyyy")).alias("period"))
    return short.union(long).distinct()


@exercise(
    "J3_parse_month_range",
    f"""SELECT period, CAST(ms AS TIMESTAMP) AS range_start,
               CAST(last_day(ms + INTERVAL 2 MONTH) AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 SECOND AS range_end
        FROM {MONTH_RANGE_SQL} r""",
)
def j3_parse_month_range(spark, sf):
    p = _month_ranges(spark, sf).withColumn("iv", J.parse_month_range("period", strict=True))
    return p.select("period", F.col("iv.left").alias("range_start"), F.col("iv.right").alias("range_end"))


_MONTHS_SQL = "period"
for _full, _short in J.MONTH_NORMALISATION:
    _MONTHS_SQL = f"replace({_MONTHS_SQL}, '{_full}', '{_short}')"


@exercise("J4_normalise_months", f"SELECT DISTINCT {LONG_PERIOD_SQL} AS period, {_MONTHS_SQL.replace('period', LONG_PERIOD_SQL)} AS normalised FROM orders")
def j4_normalise_months(spark, sf):
    return _long_month_periods(spark, sf).distinct().select("period", J.normalise_months("period").alias("normalised"))


@exercise("J5_normalise_date", "SELECT DISTINCT strftime(o_orderdate, '%-d %B %Y') AS date_text, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders")
def j5_normalise_date(spark, sf):
    o = table(spark, sf, "orders").select(F.date_format("o_orderdate", "d MMMM yyyy").alias("date_text")).distinct()
    return o.select("date_text", J.normalise_date("date_text", strict=True).alias("iso"))


@exercise("J6_iso_to_human", "SELECT event_id, strftime(ts, '%d %B %Y') AS human FROM events")
def j6_iso_to_human(spark, sf):
    ev = table(spark, sf, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return ev.select("event_id", J.iso_to_human(iso).alias("human"))


@exercise(
    "J7_quarter_bounds",
    """SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) || ' Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
              CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP) AS quarter_start,
              CAST(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS TIMESTAMP) AS quarter_end
       FROM orders""",
)
def j7_quarter_bounds(spark, sf):
    o = table(spark, sf, "orders")
    labels = o.select(F.concat(F.year("o_orderdate").cast("string"), F.lit(" Q"), F.quarter("o_orderdate").cast("string")).alias("quarter")).distinct()
    start, end = J.quarter_bounds("quarter")
    return labels.select("quarter", start.alias("quarter_start"), end.alias("quarter_end"))


@exercise("J8_parse_date_year", "SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, year(ts) AS year FROM events")
def j8_parse_date_year(spark, sf):
    ev = table(spark, sf, "events").select("event_id", J.parse_iso_date(F.date_format("ts", "yyyy-MM-dd")).alias("date"))
    return ev.withColumn("year", F.year("date").cast("bigint"))


@exercise("J9_truncate_to_day", "SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events")
def j9_truncate_to_day(spark, sf):
    return table(spark, sf, "events").select("event_id", J.truncate_to_day("ts").alias("day"))


@exercise(
    "J10_regex",
    r"""SELECT doc_id, NULLIF(regexp_extract(text, '([A-Z][a-z]+)', 1), '') AS first_cap,
              regexp_matches(text, '[0-9]') AS has_digit,
              ends_with(regexp_replace(text, '^\s+|\s+$', '', 'g'), '.') AS ends_dot,
              regexp_replace(text, '[0-9]+', '#', 'g') = text AS digit_free
       FROM documents""",
)
def j10_regex(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(
        "doc_id",
        extract_or_null("text", "([A-Z][a-z]+)", 1).alias("first_cap"),
        F.col("text").rlike("[0-9]").alias("has_digit"),
        F.endswith(strip("text"), F.lit(".")).alias("ends_dot"),
        (F.regexp_replace("text", "[0-9]+", "#") == F.col("text")).alias("digit_free"),
    )


@exercise(
    "J12_arithmetic",
    """SELECT l_orderkey, l_linenumber, l_extendedprice * 100 / 365 AS per_day,
              CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END * 0.1 AS unit FROM lineitem""",
)
def j12_arithmetic(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * 100 / 365).alias("per_day"), (F.try_divide("l_extendedprice", "l_quantity") * 0.1).alias("unit"))


@exercise("J13_round_half_even", "SELECT l_orderkey, l_linenumber, round_even(l_extendedprice / 7, 2) AS r FROM lineitem")
def j13_round_half_even(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", round_half_even(F.col("l_extendedprice") / 7, 2).alias("r"))


# ------------------------------------------------------------------ K

FUEL_OF_FLAG = {"A": "Gas", "N": "Electricity: Single-Rate Metering Arrangement", "R": "Electricity: Multi-Register Metering Arrangement"}
FUEL_CASE = "CASE l_returnflag " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FUEL_OF_FLAG.items()) + " END"
BENCH_CASE = "CASE fuel " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in C.BENCHMARK_CONSUMPTION.items()) + " END"


def _orders_components(spark, sf):
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    totals = o.select(F.col("o_orderkey").alias("grp"), F.lit(C.TOTAL).alias("component"), F.col("o_totalprice").alias("value"))
    parts = li.select(F.col("l_orderkey").alias("grp"), F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("component"), F.col("l_extendedprice").alias("value"))
    inc = o.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("grp"), F.lit(C.TOTAL_INC_VAT).alias("component"), (F.col("o_totalprice") * 1.05).alias("value"))
    return union_all([totals, parts, inc])


K1_SQL = """
WITH t AS (
  SELECT o_orderkey AS grp, 'Total_GB average' AS component, o_totalprice AS value FROM orders
  UNION ALL SELECT l_orderkey, 'L' || CAST(l_linenumber AS VARCHAR), l_extendedprice FROM lineitem
  UNION ALL SELECT o_orderkey, 'Total inc VAT', o_totalprice * 1.05 FROM orders WHERE o_orderstatus = 'F')
SELECT grp, component, round(value * 1.05, 4) AS value FROM t WHERE component = 'Total_GB average'
UNION ALL SELECT grp, 'VAT', round(value * 0.05, 4) FROM t WHERE component = 'Total_GB average'
UNION ALL SELECT grp, component, round(value, 4) FROM t WHERE component NOT IN ('Total_GB average', 'Total inc VAT')
"""


@exercise("K1_add_vat_component", K1_SQL)
def k1_add_vat_component(spark, sf):
    """Order totals and line components: VAT rows derived from totals, totals uprated,
    pre-VAT-inclusive rows dropped."""
    out = K.add_derived_component(_orders_components(spark, sf), component_col="component")
    return out.withColumn("value", F.round("value", 4))


CATEGORY = {"F": "Wholesale", "O": "Network", "P": "Policy", "VAT": "VAT", C.TOTAL: C.TOTAL}

K2_SQL = """
WITH c AS (SELECT o_orderstatus AS component, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY ALL
           UNION ALL SELECT 'Total_GB average', CAST(date_trunc('month', o_orderdate) AS TIMESTAMP), round(sum(o_totalprice), 2) FROM orders GROUP BY 2),
v AS (SELECT component, month, value FROM c WHERE component <> 'Total_GB average'
      UNION ALL SELECT component, month, value * 1.05 FROM c WHERE component = 'Total_GB average'
      UNION ALL SELECT 'VAT', month, value * 0.05 FROM c WHERE component = 'Total_GB average'),
p AS (SELECT *, lag(value) OVER (PARTITION BY component ORDER BY month) AS prev FROM v)
SELECT component, month, round(value, 4) AS value,
       CASE component WHEN 'F' THEN 'Wholesale' WHEN 'O' THEN 'Network' WHEN 'P' THEN 'Policy' WHEN 'VAT' THEN 'VAT' WHEN 'Total_GB average' THEN 'Total_GB average' END AS category,
       round(value - prev, 4) AS change,
       CASE WHEN prev IS NULL THEN NULL WHEN prev = 0 THEN NULL ELSE round_even((value / prev - 1) * 100, 2) END AS pct
FROM p
"""


@exercise("K2_levels_with_vat", K2_SQL)
def k2_levels_with_vat(spark, sf):
    """Monthly order value per status + monthly total: VAT component, category and change from the previous month."""
    o = table(spark, sf, "orders")
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")
    comps = o.groupBy(F.col("o_orderstatus").alias("component"), month).agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
    total = o.groupBy(month).agg(F.round(F.sum("o_totalprice"), 2).alias("value")).withColumn("component", F.lit(C.TOTAL))
    with_vat = K.add_derived_component(union_all([comps, total]), component_col="component", check=False)
    out = K.levels_with_vat(with_vat, keys=("component",), order="month", component_col="component", categories=CATEGORY)
    return out.select(
        "component",
        "month",
        F.round("value", 4).alias("value"),
        F.col("Component category").alias("category"),
        F.round("change_from_previous_period", 4).alias("change"),
        F.col("pct_change_from_previous_period").alias("pct"),
    )


COMPONENT_OF_LINE = dict(enumerate(list(C.COMPONENT_CATEGORY)[:7], 1))
COMPONENT_CASE = "CASE l_linenumber " + " ".join(f"WHEN {n} THEN '{c}'" for n, c in COMPONENT_OF_LINE.items()) + " END"
CATEGORY_CASE = "CASE component " + " ".join(f"WHEN '{c}' THEN '{C.COMPONENT_CATEGORY[c]}'" for c in COMPONENT_OF_LINE.values()) + " END"


def _tariff_like(spark, sf):
    """Line items shaped as a levels table: payment <- block of suppliers, fuel <- return flag,
    consumption <- line status, component <- line number, period <- ship month; value = shipped
    value in thousands (decimal sums: exact in any order)."""
    li = table(spark, sf, "lineitem")
    ms = F.date_trunc("month", "l_shipdate").cast("timestamp_ntz")
    from sheetmill.operators.joins import map_values

    # A few thousand rows a block, written once (as the gold stage run does with its input): the
    # required-values check and the build then read it instead of aggregating lineitem twice.
    levels = li.groupBy(
        F.concat(F.lit("suppliers "), F.floor(F.col("l_suppkey") / 50).cast("string")).alias(K.PAYMENT),
        map_values("l_returnflag", FUEL_OF_FLAG).alias(K.FUEL),
        map_values("l_linenumber", COMPONENT_OF_LINE).alias(K.COMPONENT),
        F.date_format(ms, "yyyy-MM").alias(C.PERIOD_COL),
        ms.alias(K.START),
        F.last_day(ms).cast("timestamp_ntz").alias(K.END),
        map_values("l_linestatus", {"F": C.NIL, "O": C.TYPICAL}).alias(K.CONSUMPTION),
    ).agg((F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double") / 1000).alias(K.VALUE))
    return materialize(levels, "tariff-like-levels")


TARIFF_SQL = f"""
WITH agg AS (
  SELECT 'suppliers ' || CAST(l_suppkey // 50 AS VARCHAR) AS payment, {FUEL_CASE} AS fuel, {COMPONENT_CASE} AS component, strftime(l_shipdate, '%Y-%m') AS period,
         CASE l_linestatus WHEN 'F' THEN 'Nil consumption' WHEN 'O' THEN 'Typical consumption' END AS consumption,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS value
  FROM lineitem GROUP BY ALL),
p AS (SELECT payment, fuel, component, period,
             avg(value) FILTER (WHERE consumption = 'Nil consumption') AS nil,
             avg(value) FILTER (WHERE consumption = 'Typical consumption') AS typ
      FROM agg WHERE fuel IS NOT NULL AND consumption IS NOT NULL GROUP BY ALL)
"""


K3_RATES_SQL = f"""
SELECT payment, fuel, component, period, 'Standing charge' AS type, 'p/day' AS unit, COALESCE(nil * 100.0::DOUBLE / 365.0::DOUBLE, 0) AS value FROM p WHERE nil IS NOT NULL OR typ IS NOT NULL
UNION ALL
SELECT payment, fuel, component, period, 'Unit price', 'p/kWh', COALESCE((typ - COALESCE(nil, 0)) / {BENCH_CASE} * 0.1::DOUBLE, 0) FROM p WHERE nil IS NOT NULL OR typ IS NOT NULL
"""
K6_BILL_SQL = """
SELECT payment, fuel, component, period, 'Standing charge' AS type, 'GBP/year' AS unit, COALESCE(nil, 0) AS value FROM p WHERE nil IS NOT NULL OR typ IS NOT NULL
UNION ALL
SELECT payment, fuel, component, period, 'Consumption-based cost', 'GBP/year', COALESCE(typ - COALESCE(nil, 0), 0) FROM p WHERE nil IS NOT NULL OR typ IS NOT NULL
"""
# The gold half: category, metadata, change per (component, fuel, payment, type); from 0 to x is infinite.
GOLD_SQL = f"""
, c AS (SELECT *, lag(value) OVER (PARTITION BY payment, fuel, component, type ORDER BY period) AS prev FROM r)
SELECT payment, fuel, component, period, type, unit, round(value, 6) AS value, {CATEGORY_CASE} AS category, 'test tables' AS publisher,
       round(value - prev, 6) AS change,
       CASE WHEN prev <> 0 THEN round_even((value / prev - 1) * 100, 2) WHEN prev = 0 AND value > 0 THEN 'inf'::DOUBLE WHEN prev = 0 AND value < 0 THEN '-inf'::DOUBLE END AS pct
FROM c
"""


def _long_rates(rates, *more):
    names = {K.PAYMENT: "payment", K.FUEL: "fuel", K.COMPONENT: "component", C.PERIOD_COL: "period", "Type": "type", "Unit": "unit"}
    return rates.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.round("value", 6).alias("value"), *more)


def _gold(rates):
    gold = K.gold_rates(rates, {"publisher": "test tables"})
    return _long_rates(
        gold,
        F.col("Component category").alias("category"),
        F.col("metadata")["publisher"].alias("publisher"),
        F.round("change_from_previous_period", 6).alias("change"),
        F.col("pct_change_from_previous_period").alias("pct"),
    )


@exercise("K3_component_rates", f"{TARIFF_SQL} SELECT * REPLACE (round(value, 6) AS value) FROM ({K3_RATES_SQL})")
def k3_component_rates(spark, sf):
    return _long_rates(K.component_rates(_tariff_like(spark, sf)))


@exercise("K3_gold_rates", f"{TARIFF_SQL}, r AS ({K3_RATES_SQL}) {GOLD_SQL}")
def k3_gold_rates(spark, sf):
    """Rates with category, metadata and the change from the previous period."""
    return _gold(K.component_rates(_tariff_like(spark, sf)))


@exercise("K6_annual_bill_contributions", f"{TARIFF_SQL} SELECT * REPLACE (round(value, 6) AS value) FROM ({K6_BILL_SQL})")
def k6_annual_bill_contributions(spark, sf):
    return _long_rates(K.annual_bill_contributions(_tariff_like(spark, sf)))


@exercise("K6_gold_contributions", f"{TARIFF_SQL}, r AS ({K6_BILL_SQL}) {GOLD_SQL}")
def k6_gold_contributions(spark, sf):
    """Contributions with category, metadata and the change from the previous period."""
    return _gold(K.annual_bill_contributions(_tariff_like(spark, sf)))


def _event_unit_rates(spark, sf):
    ev = table(spark, sf, "events")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    daily = ev.groupBy(
        F.concat(F.lit("segment-"), (F.col("user_id") % 3).cast("string")).alias(K.PAYMENT),
        F.col("event_type").alias(K.FUEL),
        F.date_format(day, "yyyy-MM-dd").alias(C.PERIOD_COL),
        day.alias(K.START),
        day.alias(K.END),
    ).agg(F.round(F.avg("value"), 4).alias(K.VALUE))
    rates = daily.withColumns({K.COMPONENT: F.lit(C.TOTAL), "Type": F.lit("Unit price")})
    return K.total_unit_rates(rates, fuel_columns={"purchase": "Purchase unit price", "view": "View unit price"})


K4_SQL = """
WITH d AS (SELECT 'segment-' || CAST(user_id % 3 AS VARCHAR) AS seg, strftime(ts, '%Y-%m-%d') AS day, event_type, round(avg(value), 4) AS v FROM events GROUP BY ALL)
SELECT seg AS segment, day, avg(v) FILTER (WHERE event_type = 'purchase') AS purchase_price, avg(v) FILTER (WHERE event_type = 'view') AS view_price
FROM d WHERE event_type IN ('purchase', 'view') GROUP BY ALL
"""


@exercise("K4_total_unit_rates", K4_SQL)
def k4_total_unit_rates(spark, sf):
    """Daily average value of two event types side by side, per user segment (one pivot)."""
    wide = _event_unit_rates(spark, sf)
    return wide.select(F.col(K.PAYMENT).alias("segment"), F.col(f"`{C.PERIOD_COL}`").alias("day"), F.col("Purchase unit price").alias("purchase_price"), F.col("View unit price").alias("view_price"))


K5_SQL = f"""
WITH w AS ({K4_SQL}),
r AS (SELECT segment, day, CASE WHEN view_price = 0 THEN NULL ELSE purchase_price / view_price END AS value FROM w),
p AS (SELECT *, lag(value) OVER (PARTITION BY segment ORDER BY day) AS prev,
             last_value(value IGNORE NULLS) OVER (PARTITION BY segment ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM r),
q AS (SELECT *, lag(f) OVER (PARTITION BY segment ORDER BY day) AS pf FROM p)
SELECT segment, day, round(value, 6) AS value, 'Purchase to view value ratio' AS variable, round(value - prev, 6) AS change,
       CASE WHEN f IS NULL OR pf IS NULL THEN NULL WHEN pf = 0 THEN CASE WHEN f > 0 THEN 'inf'::DOUBLE WHEN f < 0 THEN '-inf'::DOUBLE END
            ELSE round_even((f / pf - 1) * 100, 2) END AS pct
FROM q
"""


@exercise("K5_price_ratio", K5_SQL)
def k5_price_ratio(spark, sf):
    """Purchase / view daily value ratio per segment with change from the previous day."""
    ratio = K.price_ratio(_event_unit_rates(spark, sf), numerator="Purchase unit price", denominator="View unit price", variable="Purchase to view value ratio")
    return ratio.select(
        F.col(K.PAYMENT).alias("segment"),
        F.col(f"`{C.PERIOD_COL}`").alias("day"),
        F.round("value", 6).alias("value"),
        F.col("Variable").alias("variable"),
        F.round("change_from_previous_period", 6).alias("change"),
        F.col("pct_change_from_previous_period").alias("pct"),
    )


@exercise(
    "K9_period_dates",
    f"""SELECT period, CAST(ms AS TIMESTAMP) AS period_start, CAST(last_day(ms + INTERVAL 2 MONTH) AS TIMESTAMP) AS period_end,
               CAST(ms AS TIMESTAMP) AS interval_left,
               CAST(last_day(ms + INTERVAL 2 MONTH) AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 SECOND AS interval_right
        FROM {MONTH_RANGE_SQL} r""",
)
def k9_period_dates(spark, sf):
    out = K.period_dates(_month_ranges(spark, sf), period_col="period")
    return out.select("period", F.col("period start").alias("period_start"), F.col("period end").alias("period_end"), F.col("period interval.left").alias("interval_left"), F.col("period interval.right").alias("interval_right"))


@exercise(
    "H4_nth_in_group",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM (
         SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) t
       WHERE rn = 2""",
)
def h4_nth_in_group(spark, sf):
    """The 2nd order of every customer (nth occurrence per group)."""
    from sheetmill.operators.timeseries import nth_in_group

    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return nth_in_group(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], 2)


@exercise("I13_required_key", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def i13_required_key(spark, sf):
    """A required key read in strict mode (a missing key fails the job, naming the path)."""
    from sheetmill.sources.manifest import nested_get

    return table(spark, sf, "events").select("event_id", nested_get("props", ["k"], strict=True).alias("k"))


@exercise(
    "H3_carry_forward",
    """SELECT event_id, user_id,
              last_value(CASE WHEN event_type = 'error' THEN NULL ELSE value END IGNORE NULLS)
                OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value_filled
       FROM events""",
)
def h3_carry_forward(spark, sf):
    """Values of error events blanked, then carried forward per user in time order; the
    skew-safe plan (window per user and day, carries across days from a per-day summary)."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("value_filled"))
    filled = carry_forward(ev, ["user_id"], ["ts", "event_id"], "value_filled", split_by=F.to_date("ts"))
    return filled.select("event_id", "user_id", "value_filled")


@exercise("J11_slugify", "SELECT page_id, replace(replace(lower(url), '.', '_'), ' ', '_') AS slug FROM pages")
def j11_slugify(spark, sf):
    """Table-name slug rule applied to every page URL."""
    return table(spark, sf, "pages").select("page_id", slugify_col("url").alias("slug"))


_LANDED_SQL = """
WITH m AS (
  SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month,
         CASE WHEN month(o_orderdate) = 7 THEN NULL ELSE round(sum(o_totalprice), 2) END AS value
  FROM orders GROUP BY o_custkey, date_trunc('month', o_orderdate), month(o_orderdate)),
f AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled,
             lag(value) OVER (PARTITION BY o_custkey ORDER BY month) AS prev FROM m),
p AS (SELECT *, lag(filled) OVER (PARTITION BY o_custkey ORDER BY month) AS pf FROM f)
SELECT o_custkey, month, value, filled, round(value - prev, 2) AS change,
       CASE WHEN pf > 0 THEN round_even((filled / pf - 1) * 100, 2) END AS pct, false AS late FROM p
UNION ALL
SELECT o_custkey, month, value, NULL, NULL, NULL, true FROM m WHERE year(month) = 1993 AND month(month) <= 2
"""


@exercise("H1b_changes_as_periods_land", _LANDED_SQL)
def h1b_changes_as_periods_land(spark, sf):
    """Monthly order value per customer (Julys without a value), landed in three steps and each
    compared by a run of the stream that resumes after the one before; months landed a second time
    come back as late rows.  All of it equals the comparison of the whole history."""
    landing, root, ckpt = (scratch_path(spark, n) for n in ("h1b-landing", "h1b", "h1b-stream"))
    o = table(spark, sf, "orders")
    m = o.groupBy("o_custkey", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")).agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
    m = materialize(m.withColumn("value", F.when(F.month("month") != 7, F.col("value"))), "h1b-months")
    year = F.year("month")
    again = (year == 1993) & (F.month("month") <= 2)
    for part in (year <= 1993, (year > 1993) & (year <= 1996), (year > 1996) | again):
        m.where(part).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(m.schema).parquet(landing)
        publish_changes(stream, root, "orders", "monthly", ["o_custkey"], ["month"], "value", checkpoint_location=ckpt, pct_col="pct", split_by=year)
    out = files.read_latest(spark, root, "gold", "orders", "monthly")
    return out.select("o_custkey", "month", "value", "filled", F.round("change", 2).alias("change"), "pct", "late")
