"""Spark session and shared-storage helpers.

Every job that must cut lineage or write intermediate tables does so under the
shared folder the cluster names in ``spark.checkpoint.dir``.  That setting is read
from the session; only when it is unset (local tests) do we pick a folder ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "sheetmill") -> SparkSession:
    """Build (or reuse) a session with the settings every operator here assumes.

    AQE is on so joins against derived tables pick broadcast or sort-merge at run time
    from measured sizes (static size-estimate broadcasts are off), skewed shuffle
    partitions are split, and small partitions are coalesced.  The session time zone is pinned to UTC so date formatting is stable.

    ``shuffle_partitions`` is only set when given, or (8) for a local master.  On a
    cluster the cluster's own setting is kept: AQE can coalesce shuffle partitions but
    never create more, so the initial number must be sized for the data there (for
    100 TB, tens of thousands, e.g. through
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``), not for a laptop.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = 8
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Broadcast decisions on MEASURED sizes only: static estimates of derived tables
        # (e.g. after explode) can be orders of magnitude low, and a statically planned
        # broadcast cannot be undone at run time.  AQE broadcasts a join side whose
        # actual shuffle output is below the adaptive threshold; explicit hints on
        # fixed literal tables still broadcast.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    Reads ``spark.checkpoint.dir`` (or the directory already registered on the
    SparkContext).  When neither is set: in local mode (tests) a fresh folder is
    created and registered so ``DataFrame.checkpoint()`` works; on a cluster this is an
    error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS / object store): checkpoints and staged tables must survive executor loss")
        root = tempfile.mkdtemp(prefix="sheetmill-ckpt-")  # local mode only (tests)
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint root (never reused)."""
    root = checkpoint_root(spark)
    return f"{root}/sheetmill/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table or folder that this library wrote, through Spark's own file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a parquet table under the shared checkpoint folder and return
    a DataFrame reading it back (lineage cut).  Used where a deep plan feeds several
    actions (eager checks followed by the build): the plan runs exactly once (an eager
    RDD checkpoint would run it twice: once to count, once to write), a lost executor
    recomputes from the written files instead of from the sources, and AQE plans the
    reads from real file sizes.  Never a machine-local checkpoint."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
