"""Publication-calendar rules (I7-I9) as operators on tables.

A calendar is a table of periods with their publication dates; the as-of date is a
parameter.  "The latest publication" is a lazy scalar subquery over the calendar (a
constant-size aggregate), so nothing is read while a plan is being built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetmill.functions.dates import parse_cap_period
from sheetmill.operators.contracts import Rule, url_month_is


def latest_publication(calendar: DataFrame, asof: Column, date_col: str = "publication_date") -> Column:
    """The last publication date at or before ``asof`` (NULL when none), as a scalar."""
    date = F.col(date_col)
    return calendar.agg(F.max(F.when(date <= asof, date)).alias("latest")).scalar()


def mark_latest(calendar: DataFrame, asof: Column, date_col: str = "publication_date", out: str = "is_latest") -> DataFrame:
    """I8 the calendar with a flag on the periods published last as of a date."""
    return calendar.withColumn(out, F.coalesce(F.col(date_col) == latest_publication(calendar, asof, date_col), F.lit(False)))


def unknown_periods(df: DataFrame, calendar: DataFrame, period_col: str = "period", calendar_col: str = "period") -> DataFrame:
    """I7 the distinct period labels of ``df`` that the calendar does not have, compared as
    parsed intervals; a label that does not parse is unknown."""
    labels = df.select(F.col(period_col).alias("period")).distinct().withColumn("iv", parse_cap_period("period"))
    known = calendar.select(parse_cap_period(calendar_col).alias("iv")).where(F.col("iv").isNotNull()).distinct().withColumn("known", F.lit(True))
    # Left join + IS NULL rather than left_anti: the optimizer pushes an anti join below
    # the distinct, which would parse every input row instead of every distinct label.
    return labels.join(known, on="iv", how="left").where(F.col("known").isNull()).select("period")


def stale_periods(df: DataFrame, calendar: DataFrame, asof: Column, period_col: str = "period", calendar_col: str = "period") -> DataFrame:
    """I8 the distinct period labels of ``df`` other than the one published last."""
    latest = mark_latest(calendar, asof).where("is_latest")
    return unknown_periods(df, latest, period_col, calendar_col)


def url_month_is_latest(url_col: str, calendar: DataFrame, asof: Column, date_col: str = "publication_date") -> Rule:
    """I9 the first yyyy-MM of a URL is the month of the last publication."""
    return url_month_is(url_col, F.date_format(latest_publication(calendar, asof, date_col), "yyyy-MM"))
