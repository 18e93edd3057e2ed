"""Picking releases and attachments, nested lookups, and the landing manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetmill.functions.text import basename, citation
from sheetmill.operators.aggregate import first_by


def latest_per_group(df: DataFrame, keys: Sequence[str], ts_col: str, cols: Sequence[str]) -> DataFrame:
    """A8 the most recent row per group (``max_by`` over a struct: partial aggregation)."""
    return first_by(df, keys, ts_col, cols, descending=True)


def first_element_where(arr: Column | str, field: str, equals: object, strict: bool = False, what: str = "element") -> Column:
    """A9 first array element whose ``field`` equals ``equals`` (NULL or a job failure when none)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    hit = F.try_element_at(F.filter(a, lambda x: x[field] == F.lit(equals)), F.lit(1))
    if strict:
        hit = F.when(hit.isNull(), F.raise_error(F.lit(f"could not find {what} with {field} = {equals!r}"))).otherwise(hit)
    return hit


def first_in_group_where(df: DataFrame, keys: Sequence[str], order: str, where: Column, cols: Sequence[str]) -> DataFrame:
    """A9 in table form: the first row (by ``order``) per group satisfying ``where``."""
    return first_by(df, keys, order, cols, where=where)


def nested_get(json_col: Column | str, path: Sequence[str | int], strict: bool = False) -> Column:
    """A10 value at a nested key/index path of a JSON text column; a missing key gives
    NULL or, when ``strict``, a job failure naming the key path."""
    c = F.col(json_col) if isinstance(json_col, str) else json_col
    jpath = "$" + "".join(f"[{p}]" if isinstance(p, int) else f".{p}" for p in path)
    out = F.get_json_object(c, jpath)
    if strict:
        out = F.when(out.isNull(), F.raise_error(F.lit(f"unexpected structure: missing key path {jpath}"))).otherwise(out)
    return out


def file_name(url: Column | str, strict: bool = False) -> Column:
    """A11 last path segment; empty -> NULL (or a job failure when ``strict``)."""
    name = basename(url)
    out = F.when(name != "", name)
    if strict:
        out = F.when(out.isNull(), F.raise_error(F.lit("could not extract a file name from the URL"))).otherwise(out)
    return out


def manifest_rows(files: DataFrame, file_url: str, publisher: Column, page_url: Column, detail: Column | None = None, published: Column | None = None, extra: dict[str, Column] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """A12 one metadata row per file: ``keep``, publisher, page_url, file_url, filename, the
    ``extra`` columns (period, ingest stamp, version, ...) and the citation, which names
    ``detail`` (e.g. the period) after the file and the publication date before the page."""
    name = file_name(file_url)
    parts: list[Column | str] = ["Source: ", publisher, ", ", name]
    parts += [", ", detail] if detail is not None else []
    parts += [". Published ", published, ", ", page_url, "."] if published is not None else [". ", page_url, "."]
    return files.select(
        *keep,
        publisher.alias("publisher"),
        page_url.alias("page_url"),
        F.col(file_url).alias("file_url"),
        name.alias("filename"),
        *[c.alias(n) for n, c in (extra or {}).items()],
        citation(*parts).alias("citation"),
    )


def landing_manifest(spark: SparkSession, path: str, publisher: str, collection_url: str, pipeline_version: str, glob: str | None = None) -> DataFrame:
    """A12 one metadata row per landed file, from the file listing itself
    (``binaryFile`` columns; the content column is never read)."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select("path", "length", "modificationTime")
    extra = {
        "bronze_ingest_timestamp": F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "pipeline_version": F.lit(pipeline_version),
        "size_bytes": F.col("length"),
    }
    return manifest_rows(files, "path", F.lit(publisher), F.lit(collection_url), extra=extra).withColumnRenamed("page_url", "collection_url")
