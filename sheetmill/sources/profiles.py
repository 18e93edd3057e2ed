"""G4 / G6 / G10 profiles kept beside the published versions.

    data/<layer>/<dataset>/_profiles/<table>/<key>=<value>/run-<id>/part-*.parquet

One row per column: row and NULL counts, smallest and largest value, an HLL sketch of the
distinct values and, for numbers, a KLL sketch of the distribution.  All of it merges, so the
profile of any set of versions comes from these few rows; no data is read again.  A profile is
written before the commit record that names its run folder: a version that readers see has a
whole profile, and a version published again takes its new one.

Distinct counts are within about 5 % (three standard errors of 2**12 registers), ranks of
quantiles within 3 %.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from sheetmill.sources import commits
from sheetmill.sources.files import SourceNotFound, layer_path

LG_REGISTERS = 12
DISTINCT_ERROR = 0.05
RANK_ERROR = 0.03
COLUMNS = ("column", "rows", "nulls", "smallest", "largest", "low", "high", "distinct_sketch", "value_sketch")


def profiles_path(root: str, layer: str, dataset: str, table: str) -> str:
    return layer_path(root, layer, dataset, "_profiles", table)


def sketch_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column with its counts, bounds and sketches, in one pass over ``df``.

    ``smallest`` and ``largest`` are the bounds as text order gives them, for columns that are no
    numbers; ``low`` and ``high`` those of numbers.  NaN counts as a value, not as a NULL, but is
    left out of bounds and distribution."""
    names = [f.name for f in df.schema.fields] if columns is None else list(columns)
    numeric = {f.name: isinstance(f.dataType, NumericType) for f in df.schema.fields}
    flags = {f.name: isinstance(f.dataType, BooleanType) for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(names):
        c = F.col(f"`{name}`")
        text = c.cast("string")
        aggs += [F.count_if(c.isNull()).alias(f"n{i}"), F.hll_sketch_agg(text, F.lit(LG_REGISTERS)).alias(f"h{i}")]
        if numeric[name] and not flags[name]:
            number = F.when(~F.isnan(c.cast("double")), c.cast("double"))
            aggs += [F.min(number).alias(f"a{i}"), F.max(number).alias(f"b{i}"), F.kll_sketch_agg_double(number).alias(f"k{i}")]
        else:
            aggs += [F.min(text).alias(f"a{i}"), F.max(text).alias(f"b{i}")]

    def entry(i: int, name: str):
        number = numeric[name] and not flags[name]
        none = lambda t: F.lit(None).cast(t)
        return F.struct(
            F.lit(name).alias("column"), F.col("rows"), F.col(f"n{i}").alias("nulls"),
            (none("string") if number else F.col(f"a{i}")).alias("smallest"), (none("string") if number else F.col(f"b{i}")).alias("largest"),
            (F.col(f"a{i}") if number else none("double")).alias("low"), (F.col(f"b{i}") if number else none("double")).alias("high"),
            F.col(f"h{i}").alias("distinct_sketch"), (F.col(f"k{i}") if number else none("binary")).alias("value_sketch"),
        )

    return df.agg(*aggs).select(F.inline(F.array(*[entry(i, n) for i, n in enumerate(names)])))


def merged(sketches: DataFrame) -> DataFrame:
    """One row per column of any number of profiles, sketches merged."""
    return sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.min("smallest").alias("smallest"), F.max("largest").alias("largest"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("value_sketch").alias("value_sketch"),
    )


def estimates(sketches: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Readable profile: counts, bounds, estimated distinct count and quantiles (numbers only)."""
    some = F.kll_sketch_get_n_double("value_sketch") > 0
    quantile = lambda q: F.when(some, F.kll_sketch_get_quantile_double("value_sketch", F.lit(float(q)))).alias(f"q{round(q * 100)}")
    return sketches.select("column", "rows", "nulls", "smallest", "largest", "low", "high", F.hll_sketch_estimate("distinct_sketch").alias("distinct"), *[quantile(q) for q in ranks])


def write_profile(data: DataFrame, root: str, layer: str, dataset: str, table: str, folder: str, columns: Sequence[str] | None = None) -> None:
    """Write the profile of a version's run folder (before its commit record)."""
    sketch_columns(data, columns).select(*COLUMNS).coalesce(1).write.mode("overwrite").parquet(f"{profiles_path(root, layer, dataset, table)}/{folder}")


def read_profiles(spark: SparkSession, root: str, layer: str, dataset: str, table: str, versions: Sequence[str] | None = None) -> DataFrame:
    """The profile rows of the committed versions (all, or those named), with ``version``."""
    found = commits.version_folders(spark, commits.commits_path(root, layer, dataset, table))
    wanted = sorted(found) if versions is None else list(versions)
    unknown = [v for v in wanted if v not in found]
    if unknown or not wanted:
        raise SourceNotFound(f"no profiles for versions {unknown or 'of ' + table}")
    base = profiles_path(root, layer, dataset, table)
    frames = spark.read.option("basePath", base).parquet(*[f"{base}/{found[v].folder}" for v in wanted])
    key = found[wanted[0]].key
    return frames.select(F.col(key).cast("string").alias("version"), *COLUMNS)
