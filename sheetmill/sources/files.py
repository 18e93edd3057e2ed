"""A2-A5: reading nested JSON, tables, the latest published copy and metadata sidecars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class SourceNotFound(FileNotFoundError):
    pass


class SourceReadError(RuntimeError):
    pass


def _read(loader, what: str, path: str) -> DataFrame:
    try:
        return loader()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise SourceNotFound(f"{what} not found: {path}") from e
        raise SourceReadError(f"could not read {what}: {path}") from e


def read_nested_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A2 whole-file JSON documents (one row per file) with an explicit schema, so no
    inference pass over the data is needed."""
    return _read(lambda: spark.read.schema(schema).option("multiLine", True).json(path), "JSON", path)


def parse_json_column(col: Column | str, schema: StructType | str) -> Column:
    """A2 JSON text column -> typed struct/map (``from_json``); bad documents -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, schema)


def read_table(spark: SparkSession, path: str, base_path: str | None = None) -> DataFrame:
    """A3 parquet table; ``base_path`` keeps partition columns when reading one partition."""
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    return _read(lambda: reader.parquet(path), "parquet table", path)


def layer_path(root: str, layer: str, dataset: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), "data", layer, dataset, *parts])


def _read_folders(spark: SparkSession, root: str, layer: str, dataset: str, table: str, folders: Sequence[str]) -> DataFrame:
    """Data folders below ``historical/<table>``, the version key as a partition column."""
    base = layer_path(root, layer, dataset, "historical", table)
    return _read(lambda: spark.read.option("basePath", base).parquet(*[f"{base}/{f}" for f in folders]), "parquet table", base)


def read_latest(spark: SparkSession, root: str, layer: str, dataset: str, table: str) -> DataFrame:
    """A4 the latest published copy of a table, as its commit records name it.  What is resolved
    here stays readable while others publish."""
    from sheetmill.sources import commits

    records = commits.commits_path(root, layer, dataset, table)
    folders = commits.latest_folders(spark, records)
    return _read_folders(spark, root, layer, dataset, table, folders).drop(folders[0].split("=", 1)[0])


def read_historical(spark: SparkSession, root: str, layer: str, dataset: str, table: str) -> DataFrame:
    """All published versions of a table, the version key as a partition column (filters on it
    prune directories)."""
    from sheetmill.sources import commits

    found = commits.version_folders(spark, commits.commits_path(root, layer, dataset, table))
    if not found:
        raise SourceNotFound(f"nothing published: {layer_path(root, layer, dataset, 'historical', table)}")
    return _read_folders(spark, root, layer, dataset, table, [c.folder for c in found.values()])


def read_metadata(spark: SparkSession, path: str, schema: StructType | str | None = None, multiline: bool = True) -> DataFrame:
    """A5 metadata sidecars as a table: one (possibly pretty-printed) JSON object per
    file, or JSON lines when ``multiline=False``."""
    reader = spark.read.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    return _read(lambda: reader.json(path).withColumn("sidecar_path", F.col("_metadata.file_path")), "metadata", path)
