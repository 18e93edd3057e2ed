"""Landing by content.  A payload is stored once, however often it is landed.

Two tables below one dataset:

* ``payload``: (digest, content), one row per distinct content, only ever added to;
* ``file``: the manifest, one version per landing: (filename, path, digest, size_bytes, metadata).

A landing hashes the files once into its manifest rows, finds the digests that no earlier landing
stored by an anti-join on digests alone, and writes the payloads of these.
The manifest version is published last: a run that dies before leaves at most payloads nobody
names, which the next landing finds and only references.  Two landings that race may store a
payload twice; readers take one of equal rows, so results stay whole.

A landing of no file publishes an empty manifest version.  Files of equal content share a payload,
files of equal name keep a manifest row each.  NULL content (not possible for files) stays a manifest row with
a NULL digest and no payload.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetmill.session import materialize
from sheetmill.sources import medallion
from sheetmill.sources.files import SourceNotFound, read_historical
from sheetmill.sources.manifest import file_name

PAYLOAD, MANIFEST = "payload", "file"
PAYLOAD_SCHEMA = "digest string, content binary"


def known_payloads(spark: SparkSession, root: str, layer: str, dataset: str) -> DataFrame:
    """All stored payloads; before the first landing an empty table."""
    try:
        return read_historical(spark, root, layer, dataset, PAYLOAD).select("digest", "content")
    except SourceNotFound:
        return spark.createDataFrame([], PAYLOAD_SCHEMA)


def land_by_content(files: DataFrame, root: str, dataset: str, version_key: str, version: str, layer: str = "bronze", set_latest: bool = True) -> dict[str, int]:
    """Land ``files`` (path, content, optionally a ``metadata`` map) as one version; other columns
    go.  Returns how many files were named and how many payloads were stored."""
    spark = files.sparkSession
    metadata = F.col("metadata") if "metadata" in files.columns else F.lit(None).cast("map<string,string>")
    rows = files.select(
        file_name("path").alias("filename"),
        "path",
        F.sha2("content", 256).alias("digest"),
        F.length("content").cast("bigint").alias("size_bytes"),
        metadata.alias("metadata"),
    )
    named = materialize(rows, "landing-manifest")
    stored = known_payloads(spark, root, layer, dataset).select("digest")
    # one path per new digest; the digests alone are shuffled
    by_path = named.where(F.col("digest").isNotNull()).groupBy("digest", "path").agg(F.count(F.lit(1)).alias("n"))
    missing = by_path.groupBy("digest").agg(F.min(F.struct("path", "n")).alias("at")).join(stored, "digest", "left_anti")
    missing = materialize(missing.select("digest", F.col("at.path").alias("chosen"), F.col("at.n").alias("n")), "landing-new")
    added, repeated = missing.agg(F.count(F.lit(1)), F.count(F.when(F.col("n") > 1, 1))).first()
    if added:
        source = files.select("path", "content", F.sha2("content", 256).alias("digest"))

        def chosen(of: DataFrame) -> DataFrame:
            # by digest too: a file that changed since it was hashed isn't stored under the old digest
            found = source.join(of.withColumnRenamed("digest", "wanted"), (F.col("digest") == F.col("wanted")) & F.col("path").eqNullSafe(F.col("chosen")), "left_semi")
            return found.select("digest", "content")

        new = chosen(missing.where("n = 1"))
        if repeated:  # whole rows given more than once: only these are grouped with their bytes
            new = new.unionByName(chosen(missing.where("n > 1")).groupBy("digest").agg(F.any_value("content").alias("content")))
        # a name of its own: a version landed again must not replace payloads that others name
        medallion.publish(new, root, layer, dataset, PAYLOAD, "landing", f"{version}-{uuid.uuid4().hex[:12]}", set_latest=False)
    medallion.publish(named, root, layer, dataset, MANIFEST, version_key, version, set_latest=set_latest)
    return {"files": named.count(), "payloads": added}


def with_payload(manifest_rows: DataFrame, root: str, dataset: str, layer: str = "bronze") -> DataFrame:
    """Manifest rows (of any versions) with ``content``; a NULL digest has NULL content.  One
    payload row per digest is taken."""
    payloads = known_payloads(manifest_rows.sparkSession, root, layer, dataset)
    wanted = payloads.join(manifest_rows.select("digest").distinct(), "digest", "left_semi")
    return manifest_rows.join(wanted.groupBy("digest").agg(F.any_value("content").alias("content")), "digest", "left")
