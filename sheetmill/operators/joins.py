"""F: joins and set operations with the semantics of the spreadsheet-style tools.

Joins against derived tables carry no broadcast hint: with AQE on, Spark measures the
build side at run time and broadcasts it only when it is below
``spark.sql.autoBroadcastJoinThreshold``, otherwise it sort-merge joins (and splits
skewed partitions).  Explicit ``broadcast`` is used only for literal lookup tables
built from fixed configuration, whose size is known up front (``literal_table``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Literal lookups above this many entries are rejected: they should be tables.
MAX_LITERAL_LOOKUP = 10_000


def literal_table(spark: SparkSession, rows: Sequence[Sequence[object]], columns: Sequence[str], types: Sequence[str] | None = None) -> DataFrame:
    """A small fixed table built JVM-side (an inline array of literal structs), so no
    Python worker or RDD is involved; size-checked and hinted for broadcast."""
    if len(rows) > MAX_LITERAL_LOOKUP:
        raise ValueError(f"literal table with {len(rows)} rows; store it as a table instead")
    types = list(types) if types is not None else ["string"] * len(columns)
    structs = [F.struct(*[F.lit(v).cast(t).alias(c) for v, c, t in zip(r, columns, types, strict=True)]) for r in rows]
    row_type = "struct<" + ",".join(f"`{c}`:{t}" for c, t in zip(columns, types, strict=True)) + ">"
    arr = F.array(*structs) if structs else F.array_compact(F.array(F.lit(None).cast(row_type)))
    return F.broadcast(spark.range(1).select(F.inline(arr)))


def map_values(col: Column | str, mapping: dict, default: object | None = None) -> Column:
    """E7 value lookup through a literal map (JVM-side); missing key -> NULL or ``default``."""
    if len(mapping) > MAX_LITERAL_LOOKUP:
        raise ValueError("mapping too large for a literal map; use a lookup join")
    c = F.col(col) if isinstance(col, str) else col
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    out = F.try_element_at(m, c)
    return out if default is None else F.coalesce(out, F.lit(default))


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, values: Sequence[str]) -> DataFrame:
    """F3 dict-style lookup: a left join adding ``values`` looked up by ``key``; a missing
    key gives NULL and the row count never changes.  Like a dict, the lookup holds one
    entry per key: duplicates collapse to the smallest (values) struct, a partial
    aggregate on the lookup side only.  No hint: AQE broadcasts the lookup when its
    measured size is small, otherwise both sides are shuffled on the key."""
    entry = F.min(F.struct(*[F.col(v) for v in values])).alias("__e")
    one = lookup.where(F.col(lookup_key).isNotNull()).groupBy(F.col(lookup_key).alias("__k")).agg(entry)
    joined = df.join(one, df[key] == one["__k"], "left")
    return joined.select(*[df[c] for c in df.columns], *[F.col(f"__e.{v}").alias(v) for v in values])


def between_join(
    df: DataFrame, bounds: DataFrame, on: Sequence[tuple[str, str]], col: str, lo: str, hi: str, hi_inclusive: bool = True
) -> DataFrame:
    """F4 range join: rows of ``df`` whose ``col`` lies in [``lo``, ``hi``] (or [lo, hi)) of
    the ``bounds`` row with the same equi-keys ``on`` = [(df column, bounds column)].  The
    range is a filter after an equi-join, so Spark plans a hash or sort-merge join on
    the keys (never a nested-loop theta join); a NULL ``hi`` means unbounded above."""
    cond = [df[a] == bounds[b] for a, b in on]
    j = df.join(bounds, cond, "inner")
    upper = (F.col(col) <= F.col(hi)) if hi_inclusive else (F.col(col) < F.col(hi))
    return j.where((F.col(col) >= F.col(lo)) & (F.col(hi).isNull() | upper))


def full_outer_fill(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    suffixes: tuple[str, str] = ("_left", "_right"),
    fill: object = 0,
    null_keys_match: bool = True,
) -> DataFrame:
    """F1 full outer equi-join; overlapping non-key columns get suffixes; NULLs -> ``fill``.

    ``null_keys_match`` reproduces the tool behaviour of matching NULL keys with NULL
    keys (``<=>``).
    """
    lcols = [c for c in left.columns if c not in on]
    rcols = [c for c in right.columns if c not in on]
    both = set(lcols) & set(rcols)
    l2 = left.select(*[F.col(k).alias(f"__lk_{k}") for k in on], *[F.col(c).alias(c + suffixes[0] if c in both else c) for c in lcols])
    r2 = right.select(*[F.col(k).alias(f"__rk_{k}") for k in on], *[F.col(c).alias(c + suffixes[1] if c in both else c) for c in rcols])
    cond = [F.col(f"__lk_{k}").eqNullSafe(F.col(f"__rk_{k}")) if null_keys_match else F.col(f"__lk_{k}") == F.col(f"__rk_{k}") for k in on]
    j = l2.join(r2, on=cond, how="full")
    keys = [F.coalesce(F.col(f"__lk_{k}"), F.col(f"__rk_{k}")).alias(k) for k in on]
    rest = [c for c in j.columns if not c.startswith("__lk_") and not c.startswith("__rk_")]
    out = j.select(*keys, *rest)
    return out.na.fill(fill) if fill is not None else out


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """F5 UNION ALL by column name, missing columns filled with NULL."""
    if not frames:
        raise ValueError("union_all needs at least one DataFrame")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def missing_values(df: DataFrame, col: str, expected: Sequence[object], out: str = "value") -> DataFrame:
    """F6 expected values that do not occur in ``col``.

    Set difference of a literal list against a column without a join: one
    aggregation computes "seen" per expected value (width = len(expected)), then a
    literal unpivot keeps the unseen ones.  Output is bounded by ``expected``.
    """
    seen = df.agg(*[F.count_if(F.col(col) == F.lit(v)).alias(f"s{i}") for i, v in enumerate(expected)])
    dtype = df.schema[col].dataType.simpleString()
    stack = ", ".join(f"CAST({_sql_literal(v)} AS {dtype}), s{i}" for i, v in enumerate(expected))
    return seen.selectExpr(f"stack({len(expected)}, {stack}) as (`{out}`, __n)").where("__n = 0").drop("__n")


def _sql_literal(v: object) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def unexpected_values(df: DataFrame, col: str, allowed: Sequence[object] | None = None, pattern: str | None = None) -> DataFrame:
    """F7 distinct values outside an allowed set or not matching a pattern."""
    c = F.col(col)
    cond = F.lit(False)
    if allowed is not None:
        cond = cond | ~c.isin(list(allowed))
    if pattern is not None:
        cond = cond | ~c.rlike(pattern)
    return df.select(col).where(c.isNotNull() & cond).distinct()


def not_equal_keep_null(col: Column | str, value: object) -> Column:
    """E1 ``!=`` that keeps NULLs (spreadsheet tools treat NULL != x as true)."""
    c = F.col(col) if isinstance(col, str) else col
    return ~c.eqNullSafe(F.lit(value))
