"""Period and date parsing as native Column expressions (no Python UDFs).

Every function takes and returns ``Column`` objects so it runs inside whole-stage
codegen.  Strict variants raise through ``raise_error`` when the input does not parse;
lenient variants return NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheetmill.functions.text import replace_in_order

# Fixed values that must equal the source conventions.
# Period text such as "1 April to 30 June 2026": start day, start month, end day,
# end month and a single trailing year.
CAP_PERIOD_PATTERN = r"^(\d{1,2})\s+([A-Za-z]+)\s+to\s+(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})"
# Month range text such as "Apr 2026 - Jun 2026" or "April 2026 to June 2026", matched
# anywhere in the string, case-insensitive.
MONTH_RANGE_PATTERN = r"(?i)([A-Za-z]+)\s+(\d{4})\s*(?:-|to)\s*([A-Za-z]+)\s+(\d{4})"
# Full or long month names replaced by three-letter forms, applied one after another
# in this order ("September" before "Sept").
MONTH_NORMALISATION = [
    ("April", "Apr"),
    ("June", "Jun"),
    ("September", "Sep"),
    ("Sept", "Sep"),
    ("July", "Jul"),
    ("January", "Jan"),
    ("February", "Feb"),
    ("March", "Mar"),
    ("August", "Aug"),
    ("October", "Oct"),
    ("November", "Nov"),
    ("December", "Dec"),
]
QUARTER_PATTERN = r"(\d{4}) Q([1-4])"
PATH_SAFE_STAMP = "yyyy-MM-dd'T'HH-mm-ss'Z'"



def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fail_if_null(value: Column, source: Column, message: str) -> Column:
    """``value`` where it parsed; a job failure naming the input otherwise."""
    return F.when(source.isNull(), F.lit(None)).when(value.isNull(), F.raise_error(F.concat(F.lit(message + ": "), source))).otherwise(value)


def parse_day_month_year(text: Column) -> Column:
    """'1 April 2026' or '1 Apr 2026' -> DATE, NULL when it does not parse."""
    return F.coalesce(F.try_to_date(text, "d MMMM yyyy"), F.try_to_date(text, "d MMM yyyy"))


def parse_month_year(text: Column) -> Column:
    """'April 2026', 'Apr 2026' or 'Sept 2026' -> first day of the month, NULL when unparseable."""
    fixed = F.regexp_replace(text, r"(?i)^sept\b", "Sep")
    return F.coalesce(F.try_to_date(fixed, "MMMM yyyy"), F.try_to_date(fixed, "MMM yyyy"))


def end_of_day(d: Column) -> Column:
    """Last second of a day: date + 1 day - 1 second, as TIMESTAMP_NTZ."""
    return F.date_add(d, 1).cast("timestamp_ntz") - F.expr("INTERVAL 1 SECOND")


def interval_struct(left: Column, right: Column) -> Column:
    """Closed interval [left, right]; Spark has no interval-range type, so a struct.
    NULL when either end is NULL."""
    return F.when(left.isNotNull() & right.isNotNull(), F.struct(left.alias("left"), right.alias("right")))


def _tokens(s: Column, pattern: str) -> Column:
    """Whitespace tokens of the part of ``s`` matching ``pattern`` (empty array when no
    match): one regex evaluation per row, then cheap element lookups."""
    m = F.regexp_extract(s, pattern, 0)
    return F.when(m != "", F.split(m, r"\s+"))


def parse_cap_period(text: Column | str, strict: bool = False) -> Column:
    """J1 '1 April to 30 June 2026' -> struct(left 2026-04-01 00:00:00, right 2026-06-30 23:59:59).

    The pattern carries a single year (the start year is not allowed), anchored at the
    start of the string only.
    """
    s = _col(text)
    t = _tokens(s, CAP_PERIOD_PATTERN)  # [start day, start month, 'to', end day, end month, year]
    start = parse_day_month_year(F.concat_ws(" ", t[0], t[1], t[5]))
    end = parse_day_month_year(F.concat_ws(" ", t[3], t[4], t[5]))
    out = interval_struct(start.cast("timestamp_ntz"), end_of_day(end))
    return _fail_if_null(out, s, "period does not match expected pattern") if strict else out


def cap_period_key(text: Column | str, strict: bool = False) -> Column:
    """J2 '1 April to 30 June 2026' or '1 January 2026 to 31 March 2026' -> '2026-04-01_to_2026-06-30'.

    When the start part has no year, the end year is used.
    """
    s = _col(text)
    parts = F.split(s, " to ")
    two = F.size(parts) == 2
    start_txt, end_txt = F.element_at(parts, 1), F.element_at(parts, 2)
    end = F.try_to_date(end_txt, "d MMMM yyyy")
    n_spaces = F.length(start_txt) - F.length(F.regexp_replace(start_txt, " ", ""))
    start_full = F.when(n_spaces == 1, F.concat_ws(" ", start_txt, F.year(end).cast("string"))).otherwise(start_txt)
    start = F.try_to_date(start_full, "d MMMM yyyy")
    key = F.when(two & start.isNotNull() & end.isNotNull(), F.concat(F.date_format(start, "yyyy-MM-dd"), F.lit("_to_"), F.date_format(end, "yyyy-MM-dd")))
    return _fail_if_null(key, s, "period does not parse as 'd Month [yyyy] to d Month yyyy'") if strict else key


def parse_month_range(text: Column | str, strict: bool = False) -> Column:
    """J3 'Apr 2026 - Jun 2026' / 'April 2026 to June 2026' -> struct(first day, last second of last month)."""
    s = F.trim(_col(text))
    m = F.regexp_extract(s, MONTH_RANGE_PATTERN, 0)
    # "Apr 2026 - Jun 2026" / "April 2026to June 2026" -> [month, year, month, year]
    t = F.when(m != "", F.split(F.regexp_replace(m, r"(?i)^([A-Za-z]+\s+\d{4})\s*(?:-|to)\s*", "$1 "), r"\s+"))
    start = parse_month_year(F.concat_ws(" ", t[0], t[1]))
    end_month = parse_month_year(F.concat_ws(" ", t[2], t[3]))
    out = interval_struct(start.cast("timestamp_ntz"), end_of_day(F.last_day(end_month)))
    return _fail_if_null(out, _col(text), "month range does not match expected pattern") if strict else out


def normalise_months(text: Column | str) -> Column:
    """J4 substring replacements of month names, in the fixed order above."""
    return replace_in_order(_col(text), MONTH_NORMALISATION)


def normalise_date(text: Column | str, strict: bool = False) -> Column:
    """J5 '21 November 2025' -> '2025-11-21'."""
    s = _col(text)
    d = F.try_to_date(F.trim(s), "d MMMM yyyy")
    out = F.date_format(d, "yyyy-MM-dd")
    return _fail_if_null(out, s, "date does not parse as 'd Month yyyy'") if strict else out


def iso_to_human(ts: Column | str) -> Column:
    """J6 ISO timestamp (string ending in Z, or a timestamp) -> 'DD Month YYYY'."""
    c = _col(ts)
    parsed = F.coalesce(F.try_to_timestamp(c.cast("string"), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")), F.try_to_timestamp(c.cast("string")))
    return F.date_format(parsed, "dd MMMM yyyy")


def quarter_bounds(text: Column | str) -> tuple[Column, Column]:
    """J7 '2024 Q1' -> (2024-01-01, 2024-03-31) as TIMESTAMP_NTZ midnight values."""
    s = _col(text)
    ok = s.rlike(QUARTER_PATTERN)
    y = F.regexp_extract(s, QUARTER_PATTERN, 1).cast("int")
    q = F.regexp_extract(s, QUARTER_PATTERN, 2).cast("int")
    start = F.when(ok, F.make_date(y, q * 3 - 2, F.lit(1)))
    end = F.when(ok, F.last_day(F.make_date(y, q * 3, F.lit(1))))
    return start.cast("timestamp_ntz"), end.cast("timestamp_ntz")


def parse_iso_date(text: Column | str, strict: bool = True) -> Column:
    """J8 exact 'yyyy-MM-dd' -> TIMESTAMP_NTZ midnight (raises on bad input when strict)."""
    s = _col(text)
    d = F.try_to_date(s, "yyyy-MM-dd")
    out = d.cast("timestamp_ntz")
    return _fail_if_null(out, s, "date does not parse as yyyy-MM-dd") if strict else out


def truncate_to_day(ts: Column | str) -> Column:
    """J9 midnight of the same day, keeping the input's timestamp type."""
    c = _col(ts)
    return F.date_trunc("day", c).cast("timestamp_ntz")


def date_stamp(ts: Column | str, key: str | None = None, strict: bool = True) -> Column:
    """B5 timestamp (or 'yyyy-MM-dd HH:mm:ss' text) -> path-safe 'yyyy-MM-ddTHH-mm-ssZ' (optionally 'key=...')."""
    c = _col(ts)
    parsed = F.try_to_timestamp(c.cast("string"))
    out = F.date_format(parsed, PATH_SAFE_STAMP)
    if key:
        out = F.concat(F.lit(key + "="), out)
    return _fail_if_null(out, c, "could not parse ingest timestamp") if strict else out


def month_index(d: Column) -> Column:
    """year*12 + month, for calendar-month arithmetic."""
    return F.year(d) * 12 + F.month(d)
