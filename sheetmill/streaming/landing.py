"""Incremental landing: new source files in a landing folder -> bronze (and silver).

The batch pipelines read "the latest file"; at scale the same work runs as a
Structured Streaming query over the landing folder: the file source tracks which
files were already processed in the checkpoint (under the shared checkpoint folder),
so a restarted or failed run resumes without re-landing or skipping files.
``trigger(availableNow=True)`` processes everything that has arrived and stops,
which is how a scheduled batch job uses it.  Each micro-batch is published as one
historical version (``batch=<stream id>-<batch id>``) through the same publish operator as
batch jobs.  The stream id lives beside the checkpoint: a replayed batch overwrites its own
version, and a new or lost checkpoint cannot reuse the versions of an older one.  ``latest``
is set once, at the end of the run, by one commit record that names all versions of the stream
that no such record has named yet.  These are read from the table's commit records, so a run that
died between landing and that record is made good by the next one, with or without new files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetmill.session import checkpoint_root
from sheetmill.sources import commits, medallion


BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _checkpoint(spark: SparkSession, name: str, location: str | None) -> str:
    return location or f"{checkpoint_root(spark)}/sheetmill-streams/{name}"


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id kept beside a checkpoint; a new one if it has none yet."""
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.schema("stream string").json(f"{checkpoint}/_landing").first()
    except AnalysisException:  # a new checkpoint
        row = None
    if row:
        return row["stream"]
    stream = uuid.uuid4().hex[:12]
    spark.range(1).select(F.lit(stream).alias("stream")).write.mode("overwrite").json(f"{checkpoint}/_landing")
    return stream


def landed_since_latest(spark: SparkSession, root: str, layer: str, dataset: str, table: str, stream_id: str) -> list[str]:
    """Versions of the stream published after the last record that made versions of it ``latest``."""
    pending: dict[str, None] = {}
    for record in commits.history(spark, commits.commits_path(root, layer, dataset, table)):
        if record.version is not None and record.version.startswith(f"{stream_id}-"):
            pending[record.version] = None
        elif record.version is None and any(f"={stream_id}-" in f for f in record.latest or ()):
            pending.clear()
    return sorted(pending)


def land_new_files(
    spark: SparkSession,
    landing_dir: str,
    root: str,
    dataset: str,
    glob: str = "*",
    checkpoint_location: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    layer: str = "bronze",
    table: str = "file",
    max_files_per_trigger: int = 1000,
) -> None:
    """Land every file that arrived in ``landing_dir`` since the last run.

    Without ``transform`` the raw bytes are landed as a payload table (filename,
    content, size_bytes) in ``layer``; with it, ``transform`` maps the micro-batch of
    (path, content) rows to the table to publish (e.g. decode + build silver).
    Runs until all available files are processed, then returns.  A backlog is split
    into micro-batches of at most ``max_files_per_trigger`` files (``availableNow``
    honours the limit), so one run over a large backlog never lands everything in one
    batch.
    """
    stream = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", str(max_files_per_trigger))
        .load(landing_dir)
        .select("path", "content")
    )

    checkpoint = _checkpoint(spark, f"{dataset}-{layer}-{table}", checkpoint_location)
    stream_id = _stream_id(spark, checkpoint)

    def publish_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        version = f"{stream_id}-{batch_id:08d}"
        if transform is None:
            medallion.land_raw(batch, root, dataset, "batch", version, layer=layer, set_latest=False)
        else:
            medallion.publish(transform(batch), root, layer, dataset, table, "batch", version, set_latest=False)

    query = (
        stream.writeStream.foreachBatch(publish_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    landed = table if transform else "file"
    versions = landed_since_latest(spark, root, layer, dataset, landed, stream_id)
    if versions:
        medallion.set_latest_versions(spark, root, layer, dataset, landed, "batch", versions)


def bank_holidays_from_payload(batch: DataFrame) -> DataFrame:
    """Micro-batch transform: landed JSON documents -> validated bank-holiday rows."""
    from sheetmill.plans.bank_holidays import DOCUMENT, silver_bank_holidays

    docs = batch.select("path", F.from_json(F.decode("content", "UTF-8"), DOCUMENT).alias("doc"))
    return silver_bank_holidays(docs)
