"""H1-H3 / K7 over a stream: each landed period is compared without reading history again.

What later rows of a key need from earlier ones is its tail: the last row and the last row with a
value (at most two rows a key).  A micro-batch runs the batch operator of
``operators.timeseries`` over the tail and its own rows, publishes the result as one version,
and writes the new tail.  The rows are those that the batch operator gives for the whole history, because
they come from the same plan.  The tail is a table and not a state store: the rows of a key in one batch
then go through the same window, with ``split_by`` over many tasks where one key holds a large share, and
a period usually touches nearly every key.

* **Late rows.**  A row that does not come after its key's last row of an earlier batch is late: it is
  returned with ``late`` true and NULL changes, and the tail doesn't move.  Within a batch rows may
  come in any order; those of one key with equal ``order`` need a tie-break there, as in batch.
  A row with a NULL order value sorts first, so it is late for any key known already.
* **NULL keys** form no series: changes are NULL, ``filled`` is the value itself, they are never late.
* **Restarts.**  Tails are numbered by batch and lie below the stream's checkpoint.  A batch that runs again reads the
  same tail before it and replaces its own version, so a run that dies at any step is made good by the next.
* **Empty batches and tables** give no version and keep the tail.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetmill.operators.timeseries import period_over_period
from sheetmill.session import remove_path
from sheetmill.sources import commits, medallion
from sheetmill.streaming.landing import _checkpoint, _stream_id

_NEW, _LAST = "__new", "__last_order"


def _order(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(o) for o in order])


def _known(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def tail_of(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """The last row and the last row with a value of every key (one row if they are the same),
    from partial aggregates.  Rows with a NULL key have no tail."""
    at, v = _order(order), F.col(value)
    ends = rows.where(_known(keys)).groupBy(*keys).agg(
        F.max_by(F.struct(*order, value), at).alias("a"),
        F.max_by(F.struct(*order, value), F.when(v.isNotNull(), at)).alias("b"),
    )
    both = F.array_distinct(F.array_compact(F.array("b", "a")))
    return ends.select(*keys, F.inline(both)).select(*keys, *order, value)


def changes_after(
    tail: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    change_col: str = "change",
    pct_col: str = "pct_change",
    filled_col: str = "filled",
    split_by: Column | None = None,
    **how,
) -> DataFrame:
    """Rows of ``batch`` with change, percent change, carried value and ``late``, given the tail of
    all rows before (None: no row).  ``split_by`` reads only keys and order; ``how`` goes to
    ``period_over_period``."""
    rows = batch.withColumn(_NEW, F.lit(True))
    if tail is None:
        marked = rows.withColumn("late", F.lit(False))
        fresh = marked
    else:
        ends = tail.groupBy(*keys).agg(F.max(_order(order)).alias(_LAST))
        marked = rows.join(ends, list(keys), "left").withColumn("late", F.col(_LAST).isNotNull() & (_order(order) <= F.col(_LAST))).drop(_LAST)
        fresh = marked.where(~F.col("late")).unionByName(tail.withColumn(_NEW, F.lit(False)).withColumn("late", F.lit(False)), allowMissingColumns=True)
    out = period_over_period(fresh, keys, order, value, change_col, pct_col, split_by=split_by, filled_col=filled_col, **how)
    if tail is None:
        return out.drop(_NEW)
    late = marked.where("late").withColumns({filled_col: F.lit(None).cast(out.schema[filled_col].dataType), change_col: F.lit(None).cast("double"), pct_col: F.lit(None).cast("double")})
    return out.where(_NEW).unionByName(late).drop(_NEW)


def publish_changes(
    stream: DataFrame,
    root: str,
    dataset: str,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    layer: str = "gold",
    checkpoint_location: str | None = None,
    split_by: Column | None = None,
    **how,
) -> None:
    """Publish the changes of all rows that arrived since the last run, one version per micro-batch.

    ``stream`` is a streaming DataFrame.  At the end of a run ``latest`` names every version of this stream,
    by one record; ``read_latest`` is then the whole series.  The next run resumes from the checkpoint, which the
    caller gives or which lies in the shared checkpoint folder."""
    spark: SparkSession = stream.sparkSession
    checkpoint = _checkpoint(spark, f"{dataset}-{layer}-{table}", checkpoint_location)
    stream_id = _stream_id(spark, checkpoint)
    tail_path = lambda n: f"{checkpoint}/_tail/batch={n:08d}"

    def publish_batch(batch: DataFrame, batch_id: int) -> None:
        before = spark.read.parquet(tail_path(batch_id - 1)) if batch_id else None
        if batch.isEmpty():
            new_tail = before if before is not None else tail_of(batch, keys, order, value)
        else:
            changed = changes_after(before, batch, keys, order, value, split_by=split_by, **how)
            done = medallion.publish(changed, root, layer, dataset, table, "batch", f"{stream_id}-{batch_id:08d}", set_latest=False)
            fresh = spark.read.schema(changed.schema).parquet(done["folder"]).where("NOT late").select(*keys, *order, value)
            new_tail = tail_of(fresh if before is None else fresh.unionByName(before), keys, order, value)
        new_tail.write.mode("overwrite").parquet(tail_path(batch_id))
        if batch_id > 1:  # the batch before this one is committed and never runs again
            remove_path(spark, tail_path(batch_id - 2))

    run = stream.writeStream.foreachBatch(publish_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    versions = [v for v in commits.version_folders(spark, commits.commits_path(root, layer, dataset, table)) if v.startswith(f"{stream_id}-")]
    if versions:
        medallion.set_latest_versions(spark, root, layer, dataset, table, "batch", versions)
