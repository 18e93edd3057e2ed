"""H / K7: ordered-series operators (previous value, change, percent change, carry-forward).

All series operators take the group keys and the ordering explicitly.  The default
plan is one window exchange on the keys: all rows of a key go to one task, which
is right when series are short (the usual case after aggregating to one value per
period).

For series where one key may hold a large share of all rows, pass ``split_by``: a
coarse bucket that does not decrease along the ordering (e.g. the year of a
monthly period, or ``floor(row_idx / 10000)``).  The window then runs per
(key, bucket), so a hot key is spread over many tasks.  Values that cross bucket
edges (the previous row, the last non-null value) come from a per-bucket summary
with one row per (key, bucket), built from partial aggregates and unioned in as the
first row of the next bucket's window, so the data itself is shuffled only once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetmill.functions.numeric import ratio

_B = "__bucket"


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _any_null(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: str,
    prev_col: str = "__prev",
    filled_col: str | None = None,
    prev_filled_col: str | None = None,
    split_by: Column | None = None,
) -> DataFrame:
    """Add the previous row's value (``prev_col``) and, optionally, the running last
    non-null value (``filled_col``) and its previous-row value (``prev_filled_col``)."""
    ordering = _order_cols(order)
    if split_by is None:
        w = Window.partitionBy(*keys).orderBy(*ordering)
        out = df.withColumn(prev_col, F.lag(value).over(w))
        if filled_col:
            out = out.withColumn(filled_col, F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
            if prev_filled_col:
                out = out.withColumn(prev_filled_col, F.lag(filled_col).over(w))
        return out

    # One row per (key, bucket), from partial aggregates of the input: the bucket's last
    # value and last non-null value; a small window over the buckets of each key turns
    # them into what enters each bucket from the left.
    parts = [*keys, _B]
    data = df.withColumn(_B, split_by)
    order_key = ordering[0] if len(ordering) == 1 else F.struct(*ordering)
    summary = data.groupBy(*parts).agg(
        F.max_by(F.col(value), order_key).alias("__last"),
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), order_key)).alias("__last_nn"),
    )
    wb = Window.partitionBy(*keys).orderBy(_B)
    carry = summary.select(
        *parts,
        F.lag("__last").over(wb).alias("__vp"),
        F.last("__last_nn", ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("__vf"),
        F.lit(0).alias("__is_data"),
    )
    # The carry row sorts first in its bucket, so one window per (key, bucket) reads it as
    # the row before the bucket's first row: no join back, the data is shuffled once, and
    # NULL keys group exactly as in the single-window plan.
    rows = data.withColumns({"__vp": F.col(value), "__vf": F.col(value), "__is_data": F.lit(1)})
    both = rows.unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(*parts).orderBy("__is_data", *ordering)
    out = both.withColumn(prev_col, F.lag("__vp").over(w))
    if filled_col:
        out = out.withColumn(filled_col, F.last("__vf", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        if prev_filled_col:
            out = out.withColumn(prev_filled_col, F.lag(filled_col).over(w))
    return out.where(F.col("__is_data") == 1).drop(_B, "__vp", "__vf", "__is_data")


def period_over_period(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: str = "value",
    change_col: str | None = "change_from_previous_period",
    pct_col: str | None = "pct_change_from_previous_period",
    pad: bool = True,
    inf_as_null: bool = False,
    scale: float = 100.0,
    decimals: int | None = 2,
    split_by: Column | None = None,
    filled_col: str | None = None,
) -> DataFrame:
    """K7 = H1 + H2.  Per group, ordered by ``order`` (give all keys as tie-breaks):

    * ``change_col`` = value - previous value (NULL around gaps);
    * ``pct_col`` = (f / previous f - 1) * scale, rounded half-even, where f is the value
      padded forward over NULLs inside the group when ``pad`` (the long-standing default
      of the percent-change routine of spreadsheet-style tools).  A previous value of 0
      gives +-infinity (NULL when ``inf_as_null``), 0/0 gives NULL;
    * rows with a NULL group key get NULL change values (such keys form no group);
    * ``filled_col`` (H3, with ``pad`` only) keeps f; for a NULL key that is the value itself.
    """
    if filled_col and not pad:
        raise ValueError("filled_col needs pad=True")
    v = F.col(value)
    tmp = with_previous(
        df,
        keys,
        order,
        value,
        prev_col="__prev",
        filled_col="__f" if pad else None,
        prev_filled_col="__pf" if pad else None,
        split_by=split_by,
    )
    f, pf = (F.col("__f"), F.col("__pf")) if pad else (v, F.col("__prev"))
    bad_key = _any_null(keys)
    cols: dict[str, Column] = {}
    if change_col:
        cols[change_col] = F.when(bad_key, F.lit(None)).otherwise(v - F.col("__prev")).cast("double")
    if pct_col:
        pct = (ratio(f, pf, inf_as_null=inf_as_null) - 1) * F.lit(scale)
        if decimals is not None:
            pct = F.bround(pct, decimals)
        cols[pct_col] = F.when(bad_key | pf.isNull() | f.isNull(), F.lit(None)).otherwise(pct).cast("double")
    if filled_col:
        cols[filled_col] = F.when(bad_key, v).otherwise(f)
    return tmp.withColumns(cols).drop("__prev", "__f", "__pf")


def diff(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, out: str = "change", split_by: Column | None = None) -> DataFrame:
    """H1 value minus the previous value in the group."""
    return period_over_period(df, keys, order, value, change_col=out, pct_col=None, split_by=split_by)


def pct_change(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: str,
    out: str = "pct_change",
    pad: bool = True,
    inf_as_null: bool = False,
    split_by: Column | None = None,
) -> DataFrame:
    """H2 percent change x100 rounded to 2 dp (see ``period_over_period``)."""
    return period_over_period(df, keys, order, value, change_col=None, pct_col=out, pad=pad, inf_as_null=inf_as_null, split_by=split_by)


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, out: str | None = None, split_by: Column | None = None
) -> DataFrame:
    """H3 / C7 fill NULLs with the last non-null value before them in the group."""
    out = out or value
    tmp = with_previous(df, keys, order, value, prev_col="__prev", filled_col="__filled", split_by=split_by)
    return tmp.drop("__prev").withColumn(out, F.col("__filled")).drop("__filled")


def nth_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int, rank_col: str = "__rn") -> DataFrame:
    """H4 / C3 the n-th row (1-based) of each group in order."""
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == n).drop(rank_col)
