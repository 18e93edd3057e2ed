"""E: projection, filter and conditional column operators (all row-local, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetmill.functions.numeric import inf_to_null, to_number
from sheetmill.operators.joins import map_values


def scale_where(df: DataFrame, mask: Column, col: str, factor: float) -> DataFrame:
    """E5 ``col *= factor`` on rows where ``mask`` holds."""
    return df.withColumn(col, F.when(F.coalesce(mask, F.lit(False)), F.col(col) * F.lit(factor)).otherwise(F.col(col)))


def replace_values(df: DataFrame, col: str, mapping: dict) -> DataFrame:
    """E6 replace whole values via a literal map; unmapped values are kept."""
    return df.withColumn(col, F.coalesce(map_values(col, mapping), F.col(col)))


def infinities_to_null(df: DataFrame, col: str) -> DataFrame:
    """E6 +-inf -> NULL."""
    return df.withColumn(col, inf_to_null(col))


def map_column(df: DataFrame, src: str, out: str, mapping: dict, default: object | None = None) -> DataFrame:
    """E7 add ``out`` = mapping[src]; missing -> NULL (or ``default``)."""
    return df.withColumn(out, map_values(src, mapping, default))


def fill_nulls(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """E4 per-column NULL fill (NaN counts as missing for double columns)."""
    cols = {}
    types = dict(df.dtypes)
    for c, v in values.items():
        x = F.col(f"`{c}`")
        if types.get(c) in ("double", "float"):
            x = F.when(F.isnan(x), F.lit(None)).otherwise(x)
        cols[c] = F.coalesce(x, F.lit(v))
    return df.withColumns(cols)


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """E3 drop rows with a NULL in any of ``subset``."""
    return df.na.drop(how="any", subset=list(subset))


def coerce_numeric(df: DataFrame, col: str) -> DataFrame:
    """E9 text -> DOUBLE, unparseable -> NULL."""
    return df.withColumn(col, to_number(col))


def attach_metadata(df: DataFrame, metadata: dict[str, str] | Column, extra: dict[str, Column] | None = None, out: str = "metadata") -> DataFrame:
    """E11 one provenance map per row: a literal map (constant-folded, no join),
    optionally enriched with per-row entries (``extra``)."""
    if isinstance(metadata, dict):
        base = F.create_map(*[F.lit(x) for kv in sorted(metadata.items()) for x in (kv[0], "" if kv[1] is None else str(kv[1]))]) if metadata else F.create_map().cast("map<string,string>")
    else:
        base = metadata
    if extra:
        names = list(extra)
        base = F.map_concat(F.map_filter(base, lambda k, v: ~k.isin(names)),F.create_map(*[x for k, v in extra.items() for x in (F.lit(k), v.cast("string"))]))
    return df.withColumn(out, base)
