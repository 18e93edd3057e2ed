"""B: the bronze / silver / gold sink.

Layout under a shared ``root`` (object store or HDFS in production):

    data/<layer>/<dataset>/historical/<table>/<key>=<value>/run-<id>/part-*.parquet
    data/<layer>/<dataset>/_commits/<table>/<number>.json

The version key sits below the table name so Spark's partition discovery turns it
into a column and filters on it prune directories.  ``publish`` computes the upstream plan
exactly once and writes it once: into a run folder that no reader looks at, while a
contract's rule counts are collected by ``observe`` in the same pass.  A failed contract
removes the folder; else one commit record (``sources.commits``) makes the version visible
and, with it, ``latest``.  Nothing published is ever changed in place: a reader sees the old
version or the new one, and a writer that dies at any step changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetmill.operators.contracts import Contract, ContractError, observe_contract, raise_observed
from sheetmill.session import remove_path
from sheetmill.sources import commits, profiles
from sheetmill.sources.files import layer_path, read_historical


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """B1 parquet write (parents created by the writer)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def publish(
    df: DataFrame,
    root: str,
    layer: str,
    dataset: str,
    table: str,
    version_key: str,
    version: str,
    contract: Contract | None = None,
    set_latest: bool = True,
    profile: bool | Sequence[str] = False,
) -> dict[str, str]:
    """B2 publish a table as version ``<version_key>=<version>`` and as ``latest``
    (``set_latest=False`` leaves ``latest`` alone: a run of several versions sets it once at its
    end).  Publishing a version again replaces it for readers that come later.  ``profile``
    keeps a profile of its columns (all, or those named) beside it (``sources.profiles``)."""
    spark: SparkSession = df.sparkSession
    base = layer_path(root, layer, dataset, "historical", table)
    folder = f"{partition_name(spark, version_key, version)}/run-{uuid.uuid4().hex}"
    if contract is None:
        write_table(df, f"{base}/{folder}")
    else:
        observed, obs, rules = observe_contract(df, contract)
        write_table(observed, f"{base}/{folder}")
        try:
            raise_observed(spark.read.parquet(f"{base}/{folder}"), contract, obs, rules)
        except ContractError:
            remove_path(spark, f"{base}/{folder}")
            raise
    if profile:
        profiles.write_profile(spark.read.schema(df.schema).parquet(f"{base}/{folder}"), root, layer, dataset, table, folder, None if profile is True else list(profile))
    records = commits.commits_path(root, layer, dataset, table)
    commits.commit(spark, records, commits.Commit(version_key, version, folder, (folder,) if set_latest else None, schema=df.schema.json()))
    return {"historical": base, "commits": records, "folder": f"{base}/{folder}"}


def partition_name(spark: SparkSession, key: str, value: str) -> str:
    """``key=value`` with the characters escaped that partition folders escape."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(key, value)


def set_latest_versions(spark: SparkSession, root: str, layer: str, dataset: str, table: str, version_key: str, versions: list[str]) -> None:
    """Make the rows of several published versions together ``latest``, by one record."""
    records = commits.commits_path(root, layer, dataset, table)
    found = commits.version_folders(spark, records)
    commits.commit(spark, records, commits.Commit(version_key, None, None, tuple(found[v].folder for v in versions)))


def land_raw(files: DataFrame, root: str, dataset: str, version_key: str, version: str, layer: str = "bronze", set_latest: bool = True) -> dict[str, str]:
    """B3 land raw source files as a payload table (filename, content BINARY, metadata MAP).

    ``files`` has ``path`` and ``content`` (e.g. from ``binaryFile``) and optionally a
    ``metadata`` map.  Readers decode ``content`` in tasks, e.g. ``decode_workbooks``.
    """
    cols = [F.regexp_extract("path", r"([^/]*)/*$", 1).alias("filename"), F.col("content"), F.length("content").cast("bigint").alias("size_bytes")]
    if "metadata" in files.columns:
        cols.append(F.col("metadata"))
    return publish(files.select(*cols), root, layer, dataset, "file", version_key, version, set_latest=set_latest)


def read_version(spark: SparkSession, root: str, layer: str, dataset: str, table: str, version_key: str, version: str) -> DataFrame:
    """B4 one historical version through partition pruning (keeps the key column)."""
    return read_historical(spark, root, layer, dataset, table).where(F.col(version_key) == F.lit(version))
