"""G: aggregation, distinct values, profiling and empty-input checks.

All of these are single ``groupBy``/``agg`` passes: Spark adds a map-side partial
aggregate before the shuffle, so a hot key costs one partial row per task, not a
skewed partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetmill.operators.contracts import _sql_string
from sheetmill.operators.exact import exact_sums


def group_sum(df: DataFrame, keys: Sequence[str], value: str, out: str = "value", drop_null_keys: bool = True) -> DataFrame:
    """G1 group sum; NULLs skipped, all-NULL group -> 0, NULL keys dropped (tool semantics)."""
    src = df
    if drop_null_keys:
        for k in keys:
            src = src.where(F.col(k).isNotNull())
    return src.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0)).alias(out))


def group_sum_exact(df: DataFrame, keys: Sequence[str], value: str, out: str = "value") -> DataFrame:
    """G1 as ``group_sum``, with the sum rounded once from its exact value: the same bits in any
    order of the rows and from any partitioning."""
    src = df
    for k in keys:
        src = src.where(F.col(k).isNotNull())
    return exact_sums(src, keys, {out: F.col(value)}).withColumn(out, F.coalesce(out, F.lit(0.0)))


def value_counts(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    """G3 counts per value, NULL kept as a value, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), F.asc_nulls_first(col))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """G5 distinct non-null values, sorted (a table, not an array, so it can be large)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def latest_at_or_before(df: DataFrame, keys: Sequence[str], date_col: str, asof: Column, out: str = "latest") -> DataFrame:
    """G11 max of dates <= as-of per group (NULL when none)."""
    return df.groupBy(*keys).agg(F.max(F.when(F.col(date_col) <= asof, F.col(date_col))).alias(out))


def first_by(df: DataFrame, keys: Sequence[str], order: Column | str, cols: Sequence[str], descending: bool = False, where: Column | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """G9 / A8 / A9 the row with the smallest (or largest) ordering value per group; among equal
    ordering values the one that comes first (last, if descending) by the columns ``ties``.

    ``min_by``/``max_by`` over a struct: a partial aggregate, so no group is ever
    collected into one task and no window sort is needed.
    """
    src = df if where is None else df.where(where)
    o = F.col(order) if isinstance(order, str) else order
    if ties:
        o = F.when(o.isNotNull(), F.struct(o, *[F.col(c) for c in ties]))
    payload = F.struct(*[F.col(c) for c in cols])
    pick = F.max_by(payload, o) if descending else F.min_by(payload, o)
    return src.groupBy(*keys).agg(pick.alias("__pick")).select(*keys, *[F.col(f"__pick.{c}").alias(c) for c in cols])


def profile(df: DataFrame, count_distinct: Sequence[str] = (), null_counts: Sequence[str] = (), extra: Sequence[Column] = ()) -> DataFrame:
    """G10 one-row table profile (row count, distinct counts, null counts) in one pass."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_distinct(c).alias(f"distinct_{c}") for c in count_distinct]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in null_counts]
    aggs += list(extra)
    return df.agg(*aggs)


def empty_groups(df: DataFrame, col: str, expected: Sequence[str], out: str = "rows") -> DataFrame:
    """G12 row count per expected tag (0 when absent) and an ``is_empty`` flag.

    Counting is one conditional aggregation over ``df`` (width = number of expected
    tags), then a literal unpivot; no join.
    """
    counts = df.agg(*[F.count_if(F.col(col) == F.lit(t)).alias(f"c{i}") for i, t in enumerate(expected)])
    stack = ", ".join(f"{_sql_string(t)}, c{i}" for i, t in enumerate(expected))
    return counts.selectExpr(f"stack({len(expected)}, {stack}) as ({col}, {out})").withColumn("is_empty", F.col(out) == 0)
