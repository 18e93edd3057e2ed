"""D: wide <-> long reshaping, pivots and nested flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from sheetmill.functions.text import standardise_name


class ReshapeError(ValueError):
    pass


def melt(
    df: DataFrame,
    id_vars: Sequence[str],
    value_vars: Sequence[str] | None = None,
    var_name: str = "variable",
    value_name: str = "value",
) -> DataFrame:
    """D1/D2 wide -> long.  ``value_vars=None`` melts every column not in ``id_vars``.

    NULL values are kept (one output row per input row and value column).  Value
    columns are cast to one common type first: DOUBLE when all are numeric, else STRING.
    A row-local ``Expand``: no shuffle.
    """
    ids = list(id_vars)
    vals = [c for c in df.columns if c not in ids] if value_vars is None else list(value_vars)
    missing = [c for c in ids + vals if c not in df.columns]
    if missing:
        raise ReshapeError(f"melt: columns not found: {missing}")
    types = {f.name: f.dataType for f in df.schema.fields}
    common = "double" if all(isinstance(types[c], NumericType) for c in vals) else "string"
    if len({types[c].simpleString() for c in vals}) == 1:
        common = types[vals[0]].simpleString()
    cast = df.select(*[F.col(c) for c in ids], *[F.col(c).cast(common).alias(c) for c in vals])
    return cast.unpivot(ids, vals, var_name, value_name)


def require_values(df: DataFrame, column: str, expected: Sequence[str], what: str = "value") -> None:
    """D4/F6 fail when an expected value is absent from ``column``."""
    require_values_in(df, {column: (list(expected), what)})


def require_values_in(df: DataFrame, checks: dict[str, tuple[Sequence[str], str]]) -> None:
    """Several "expected values present" checks in ONE aggregation job.

    ``checks`` maps column -> (expected values, label).  The job returns one boolean per
    (column, value) pair, never the column's distinct values.
    """
    pairs = [(c, v) for c, (vals, _) in checks.items() for v in vals]
    if not pairs:
        return
    row = df.agg(*[F.max(F.col(f"`{c}`") == F.lit(v)).alias(f"s{i}") for i, (c, v) in enumerate(pairs)]).first()
    missing: dict[str, list[str]] = {}
    for i, (c, v) in enumerate(pairs):
        if not row[f"s{i}"]:
            missing.setdefault(c, []).append(v)
    if missing:
        raise ReshapeError("; ".join(f"expected {checks[c][1]}(s) not found in '{c}': {sorted(vs)}" for c, vs in missing.items()))


def pivot_mean(
    df: DataFrame,
    index: Sequence[str],
    columns: str,
    values: str,
    pivot_values: Sequence[str],
    drop_all_null: bool = True,
    require: bool = False,
) -> DataFrame:
    """D3 pivot with a mean aggregate, like a spreadsheet pivot table.

    * the pivot values are given explicitly, so Spark plans a single aggregation
      (no extra job to discover distinct values) with map-side partial aggregation;
    * rows whose index or pivot key is NULL are dropped;
    * groups whose pivoted values are all NULL are dropped (Spark would keep them);
    * duplicate (index, column) entries are averaged, not rejected.
    ``require=True`` (D4) raises when one of ``pivot_values`` never occurs.
    """
    if require:
        require_values(df, columns, pivot_values, what="pivot column")
    keyed = df.where(F.col(columns).isNotNull())
    for k in index:
        keyed = keyed.where(F.col(k).isNotNull())
    out = keyed.groupBy(*index).pivot(columns, list(pivot_values)).agg(F.avg(values))
    if drop_all_null:
        any_value = F.lit(False)
        for v in pivot_values:
            any_value = any_value | F.col(f"`{v}`").isNotNull()
        out = out.where(any_value)
    return out


def flatten_nested(
    df: DataFrame,
    map_col: str,
    group_field: str = "division",
    items_field: str = "events",
    required: Sequence[str] = ("title", "date"),
    defaults: dict[str, Column] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """D5 ``map<key, struct<group_field, items_field: array<struct>>>`` -> one row per item.

    ``group_field`` falls back to the map key; fields in ``defaults`` fall back to the
    given value; a NULL ``required`` field fails the job naming the field.  Row-local
    ``Generate`` (explode) steps only, no shuffle.
    """
    defaults = {"notes": F.lit(""), "bunting": F.lit(False)} if defaults is None else defaults
    by_key = df.select(*keep, F.explode(F.col(map_col)).alias("_key", "_group"))
    items = by_key.select(
        *keep,
        F.coalesce(F.col(f"_group.{group_field}"), F.col("_key")).alias(group_field),
        F.explode_outer(F.col(f"_group.{items_field}")).alias("_item"),
    ).where(F.col("_item").isNotNull())
    item_fields = [f.name for f in items.schema["_item"].dataType.fields]
    cols = []
    for name in item_fields:
        c = F.col(f"_item.{name}")
        if name in required:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"missing required field '{name}'"))).otherwise(c)
        elif name in defaults:
            c = F.coalesce(c, defaults[name])
        cols.append(c.alias(name))
    for name, value in defaults.items():
        if name not in item_fields:
            cols.append(value.alias(name))
    return items.select(*keep, group_field, *cols)


def standardise_column_names(df: DataFrame, fail_on_collision: bool = True) -> DataFrame:
    """D7 strip, lower, whitespace -> '_', non-word -> '_' for every column name."""
    new = [standardise_name(c) for c in df.columns]
    dupes = sorted({n for n in new if new.count(n) > 1})
    if dupes and fail_on_collision:
        raise ReshapeError(f"standardised column names collide: {dupes}")
    return df.toDF(*new)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """D6 rename (ignores names not present, like a spreadsheet-tool rename)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})
