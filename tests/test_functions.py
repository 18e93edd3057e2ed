"""J functions: the period and date table of FIXTURES.md (F6) and string helpers."""

from __future__ import annotations

import datetime as dt
import itertools
import time

import pytest
from pyspark.sql import functions as F

from sheetmill.functions import dates as J
from sheetmill.functions.numeric import ratio, to_number
from sheetmill.functions.text import basename, clean_header, standardise_name


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_parse_cap_period(spark):
    iv = one(spark, J.parse_cap_period(F.lit("1 April to 30 June 2026")))
    assert (iv["left"], iv["right"]) == (dt.datetime(2026, 4, 1), dt.datetime(2026, 6, 30, 23, 59, 59))


def test_parse_cap_period_rejects_start_year(spark):
    assert one(spark, J.parse_cap_period(F.lit("1 January 2026 to 31 March 2026"))) is None
    with pytest.raises(Exception, match="does not match"):
        one(spark, J.parse_cap_period(F.lit("1 January 2026 to 31 March 2026"), strict=True))


@pytest.mark.parametrize(
    "text,key",
    [("1 April to 30 June 2026", "2026-04-01_to_2026-06-30"), ("1 January 2026 to 31 March 2026", "2026-01-01_to_2026-03-31")],
)
def test_cap_period_key(spark, text, key):
    assert one(spark, J.cap_period_key(F.lit(text))) == key


@pytest.mark.parametrize("text", ["Apr 2026 - Jun 2026", "April 2026 to June 2026", "  apr 2026 TO june 2026 "])
def test_parse_month_range(spark, text):
    iv = one(spark, J.parse_month_range(F.lit(text)))
    assert (iv["left"], iv["right"]) == (dt.datetime(2026, 4, 1), dt.datetime(2026, 6, 30, 23, 59, 59))


def test_parse_month_range_month_containing_to(spark):
    iv = one(spark, J.parse_month_range(F.lit("August 1997 to October 1997")))
    assert iv["right"] == dt.datetime(1997, 10, 31, 23, 59, 59)


@pytest.mark.parametrize("text,out", [("April 2025 - September 2025", "Apr 2025 - Sep 2025"), ("Sept 2025", "Sep 2025"), ("May 2025", "May 2025")])
def test_normalise_months(spark, text, out):
    assert one(spark, J.normalise_months(F.lit(text))) == out


def test_normalise_date(spark):
    assert one(spark, J.normalise_date(F.lit(" 21 November 2025"))) == "2025-11-21"


@pytest.mark.parametrize("q,start,end", [("2024 Q1", dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 31)), ("2024 Q4", dt.datetime(2024, 10, 1), dt.datetime(2024, 12, 31))])
def test_quarter_bounds(spark, q, start, end):
    s, e = J.quarter_bounds(F.lit(q))
    row = spark.range(1).select(s.alias("s"), e.alias("e")).first()
    assert (row["s"], row["e"]) == (start, end)


def test_date_stamp(spark):
    assert one(spark, J.date_stamp(F.lit("2025-06-01 09:30:00"), key="ingested")) == "ingested=2025-06-01T09-30-00Z"


def test_iso_to_human(spark):
    assert one(spark, J.iso_to_human(F.lit("2025-11-21T09:30:00Z"))) == "21 November 2025"


def test_standardise_name():
    assert standardise_name("Installation quarter (A)") == "installation_quarter__a_"
    assert standardise_name(" Total heat pump\ninstallations ") == "total_heat_pump_installations"


def test_clean_header(spark):
    assert one(spark, clean_header(F.lit("  Total heat\npumps \n"))) == "Total heatpumps"


def test_ratio_and_to_number(spark):
    row = spark.range(1).select(
        ratio(F.lit(1.0), F.lit(0.0)).alias("a"),
        ratio(F.lit(-1.0), F.lit(0.0)).alias("b"),
        ratio(F.lit(0.0), F.lit(0.0)).alias("c"),
        ratio(F.lit(1.0), F.lit(0.0), inf_as_null=True).alias("d"),
        to_number(F.lit("12.5")).alias("e"),
        to_number(F.lit("n/a")).alias("f"),
    ).first()
    assert row["a"] == float("inf") and row["b"] == float("-inf") and row["c"] is None and row["d"] is None
    assert row["e"] == 12.5 and row["f"] is None


def test_basename_of_odd_paths(spark):
    """The same as the plain pattern gives, also around line ends, and NULL for NULL."""
    texts = ["".join(x) for n in range(5) for x in itertools.product("a/é\n\r\u2028", repeat=n)] + [None, "s3://b/c d//", "/x/y.xlsx", "a/\x85", "b/c/\r\n"]
    paths = spark.createDataFrame([(t,) for t in texts], "path string")
    pattern = F.regexp_extract("path", r"([^/]*)/*$", 1)
    assert paths.where(~basename("path").eqNullSafe(pattern)).collect() == []


def test_basename_takes_time_by_length_only(spark):
    """No new try at every character of a long segment (the plain pattern takes steps by its square)."""
    paths = spark.range(1).select(F.concat(F.lit("/"), F.repeat(F.lit("a"), 50_000), F.lit("/b.xlsx/"), F.col("id").cast("string")).alias("path"))
    one(spark, F.lit(0))
    began = time.monotonic()
    ends = paths.select(basename("path").alias("x"), basename(F.concat("path", F.lit("/\n"))).alias("y")).first()
    assert tuple(ends) == ("0", "0") and time.monotonic() - began < 10
