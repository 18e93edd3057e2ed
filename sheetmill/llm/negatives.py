"""Hard-negative mining over lists shared by clusters of anchors.

Anchors are clustered by angle.  For a cluster with centroid c whose members are at most the
angle w away from c, a candidate i at the angle a(i) from c scores at most

    |anchor| * |i| * cos(max(0, a(i) - w))

with any member.  Every cluster has one list: all rows, sorted once by |i| cos(max(0, a(i) - w)),
descending.  Every member walks that list and stops as soon as its own threshold is above
|anchor| times the bound at its place: no later row can enter its result, which certifies it.

1. Centroids come from a bounded sample of anchors (``SAMPLE`` smallest hashes); members and the
   widest angle of each cluster from all anchors.
2. The lists are dealt by range over (cluster, bound), so a cluster's list spreads over many
   tasks however large it is, cut into sorted segments and written once.  The stretch of a list
   that one task holds is a span.
3. Members are dealt into blocks by a hash of the row.  The first thresholds of a member come
   from its peers, the other anchors of its block.
4. A member goes only to the spans of its list whose first bound reaches its threshold, a span
   only to the blocks that still need it.  In a span a member walks segment by segment.
5. Two walks use the same lists: first for the positives (the best rows of the anchor's label),
   then for the negatives, whose scores must lie in a window below each positive's score.  A
   window's threshold is its lower end until ``per_positive`` negatives are found in it.

Scores are exact integers; bounds are rounded up by a margin above the floating-point error.

Defined results: rows with a NULL id, a NULL label, a NULL vector, or a NULL or non-finite
component take no part; labels are compared as 64-bit integers; shorter vectors count as padded
with zeros; rows that repeat an id are rows of their own, as anchors too; ties go to the smaller
id; an anchor without positives, or a positive without negatives, has no rows; an empty table
gives none; components too large for exact 64-bit scores raise ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheetmill.llm.common import as_lists, exact_type, integer_components, quoted, takes_part, written
from sheetmill.llm.topk import best_k, matrix
from sheetmill.session import remove_path

CLUSTERS = 8
#: Fewest anchors for each cluster.
MEMBERS = 64
#: Anchors that fit the centroids.
SAMPLE = 4096
#: Members of a block, rows of a segment, rows of a task's span.
BLOCK = 4096
SEGMENT = 1024
SPAN = 1 << 18
#: Rows of small tables (of known size) that may be broadcast.
FEW = 100_000
NONE = float(-(1 << 62))


@dataclass(frozen=True)
class Mining:
    """Positives per anchor, negatives per positive, and the window of a negative's score:
    low * positive <= 100 * negative <= high * positive."""

    positives: int = 5
    per_positive: int = 3
    low: int = 50
    high: int = 95


def centroids(vectors: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    """Unit centroids by spherical k-means, started from vectors far apart."""
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    unit = vectors[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.eye(1, vectors.shape[1])
    chosen = [0]
    near = unit @ unit[0]
    while len(chosen) < min(clusters, len(unit)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[chosen[-1]])
    out = unit[chosen]
    for _ in range(rounds):
        mine = (unit @ out.T).argmax(axis=1)
        sums = np.zeros_like(out)
        np.add.at(sums, mine, unit)
        size = np.sqrt((sums * sums).sum(axis=1))
        out = np.where(size[:, None] > 1e-12, sums / np.maximum(size, 1e-12)[:, None], out)
    return out


def angles(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the rows and their angles with each centroid (0 for rows of length 0)."""
    norm = np.sqrt((x * x).sum(axis=1))
    cos = np.clip(x @ centers.T / np.maximum(norm, 1e-300)[:, None], -1, 1)
    return norm, np.where(norm[:, None] > 0, np.arccos(cos), 0.0)


def bounds(norm: np.ndarray, angle: np.ndarray, widest: np.ndarray) -> np.ndarray:
    """Most that a row scores with a unit vector at most ``widest`` away from the centroid."""
    return norm[:, None] * np.cos(np.maximum(0.0, angle - widest))


def _margin(norm: np.ndarray | float, other: np.ndarray | float) -> np.ndarray | float:
    return 1e-6 * (1 + norm * other)


@dataclass
class Span:
    """A stretch of a cluster's list, best bounds first."""

    bound: np.ndarray
    key: np.ndarray
    id: np.ndarray
    label: np.ndarray
    v: np.ndarray

    @staticmethod
    def of(segments: pa.Table, dim: int, kind: type) -> Iterator[Span]:
        """The segments of one span, in order; each was sorted when the list was written."""
        tops = segments.column("top").to_numpy()
        for at in np.argsort(-tops, kind="stable").tolist():
            row = segments.slice(at, 1)
            flat = lambda c: row.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)  # noqa: B023, E731
            yield Span(flat("bounds"), flat("keys"), flat("ids"), flat("labels"), flat("vs").astype(kind).reshape(-1, dim))


def _member_arrays(members: pa.Table, dim: int, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return members.column("key").to_numpy(), members.column("label").to_numpy(), members.column("norm").to_numpy(), matrix(members.column("v"), dim).astype(kind)


class Best:
    """The best k rows of each owner so far, and each owner's threshold."""

    def __init__(self, theta: np.ndarray, k: int):
        self.theta, self.k = theta.astype(np.float64).copy(), k
        self.owner, self.score, self.id, self.key = (np.zeros(0, dtype=np.int64) for _ in range(4))

    def add(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        if not len(owner):
            return
        owner, score = np.r_[self.owner, owner], np.r_[self.score, score.astype(np.int64)]
        ids, keys = np.r_[self.id, ids], np.r_[self.key, keys]
        by_key = np.argsort(keys, kind="stable")  # best_k is stable, so equal ids go by row key
        keep = by_key[best_k(owner[by_key], score[by_key], ids[by_key], self.k)]
        self.owner, self.score, self.id, self.key = owner[keep], score[keep], ids[keep], keys[keep]
        last = np.flatnonzero(np.r_[self.owner[1:] != self.owner[:-1], True])
        full = np.bincount(self.owner, minlength=len(self.theta))[self.owner[last]] == self.k
        here = self.owner[last][full]
        self.theta[here] = np.maximum(self.theta[here], self.score[last][full])


def walk_positives(span: Iterator[Span], key: np.ndarray, label: np.ndarray, norm: np.ndarray, v: np.ndarray, theta: np.ndarray, k: int) -> tuple[Best, int]:
    """Best rows of each member's label in the span, and how many products that took."""
    best, products = Best(theta, k), 0
    for s in span:
        live = np.flatnonzero(norm * s.bound[0] + _margin(norm, abs(s.bound[0])) >= best.theta)
        if not len(live):
            break  # later rows have no larger bound: every member is certified
        products += len(live) * len(s.key)
        scores = v[live] @ s.v.T
        i, j = np.nonzero((label[live, None] == s.label) & (scores >= best.theta[live, None]) & (key[live, None] != s.key))
        best.add(live[i], scores[i, j], s.id[j], s.key[j])
    return best, products


def walk_negatives(span: Iterator[Span], label: np.ndarray, norm: np.ndarray, v: np.ndarray, theta: np.ndarray, high: np.ndarray, k: int) -> tuple[Best, int]:
    """Best rows of other labels in each member's windows [theta, high] (members x windows);
    owners are member * windows + window."""
    best, products, windows = Best(theta.ravel(), k), 0, theta.shape[1]
    top = high.max(axis=1)
    for s in span:
        lowest = np.where(best.theta.reshape(high.shape) <= high, best.theta.reshape(high.shape), np.inf).min(axis=1)
        live = np.flatnonzero(norm * s.bound[0] + _margin(norm, abs(s.bound[0])) >= lowest)
        if not len(live):
            break
        products += len(live) * len(s.key)
        scores = v[live] @ s.v.T
        i, j = np.nonzero((label[live, None] != s.label) & (scores >= lowest[live, None]) & (scores <= top[live, None]))
        score = scores[i, j]
        for w in range(windows):
            owner = live[i] * windows + w
            fits = (score >= best.theta[owner]) & (score <= high[live[i], w])
            best.add(owner[fits], score[fits], s.id[j[fits]], s.key[j[fits]])
    return best, products


def _rows(table: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    fine = table.filter(takes_part(F.col(quoted(vec_col))) & F.col(quoted(id_col)).isNotNull() & F.col(quoted(label_col)).isNotNull())
    return fine.select(F.monotonically_increasing_id().alias("key"), F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(label_col)).cast("long").alias("label"), integer_components(F.col(quoted(vec_col))).alias("v"))


def _placed(centers: np.ndarray, dim: int):
    """mapInArrow: the cluster of each anchor, its angle with the centroid, its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norm, angle = angles(matrix(batch.column("v"), dim).astype(np.float64), centers)
            mine = angle.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mine.astype(np.int32)), pa.array(angle[np.arange(len(mine)), mine]), pa.array(norm)], names=[*batch.schema.names, "cluster", "angle", "norm"])

    return run, "key long, id long, label long, v array<bigint>, cluster int, angle double, norm double"


def narrow(most: int) -> tuple[str, type]:
    """The smallest SQL and numpy integer types that hold components up to ``most``."""
    return next(t for bits, t in ((15, ("smallint", np.int16)), (31, ("int", np.int32)), (64, ("bigint", np.int64))) if most < 1 << bits)


def _listed(centers: np.ndarray, widest: np.ndarray, dim: int, small: tuple[str, type]):
    """mapInArrow: one row per row and cluster, with its bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"), dim)
            bound = bounds(*angles(x.astype(np.float64), centers), widest)
            columns = [*(batch.column(c) for c in ("key", "id", "label")), as_lists(x.astype(small[1]))]
            for c in range(len(centers)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, c, dtype=np.int32)), pa.array(bound[:, c]), *columns], names=["cluster", "bound", "key", "id", "label", "v"])

    return run, f"cluster int, bound double, key long, id long, label long, v array<{small[0]}>"


def _segments(dim: int, segment: int, small: tuple[str, type]):
    """mapInArrow over sorted rows: rows of one cluster together, at most ``segment`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        span = TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            cluster = batch.column("cluster").to_numpy()
            edges = np.flatnonzero(np.r_[True, cluster[1:] != cluster[:-1]])
            cuts = np.concatenate([np.arange(a, b, segment) for a, b in zip(edges, np.r_[edges[1:], len(cluster)], strict=True)])
            offsets = pa.array(np.r_[cuts, len(cluster)].astype(np.int32))
            lists = lambda c: pa.ListArray.from_arrays(offsets, batch.column(c))  # noqa: B023, E731
            v = pa.ListArray.from_arrays(pa.array(np.r_[cuts, len(cluster)].astype(np.int32) * dim), pa.array(matrix(batch.column("v"), dim).astype(small[1]).ravel()))
            columns = [pa.array(cluster[cuts]), pa.array(np.full(len(cuts), span, dtype=np.int32)), batch.column("bound").take(pa.array(cuts)), lists("bound"), lists("key"), lists("id"), lists("label"), v]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "span", "top", "bounds", "keys", "ids", "labels", "vs"])

    return run, f"cluster int, span int, top double, bounds array<double>, keys array<bigint>, ids array<bigint>, labels array<bigint>, vs array<{small[0]}>"


def _few(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint for a table known to have no more than ``FEW`` narrow rows; beyond that
    Spark decides by its measured size."""
    return F.broadcast(df) if rows <= FEW else df


def _dealt(members: DataFrame, lists: DataFrame, spans: DataFrame, n_spans: int, n_blocks: int) -> tuple[DataFrame, DataFrame]:
    """Members at every span of their list that may matter to them; segments at every block that
    may need them.  ``members`` has ``least``: the lowest score that still helps the member."""
    reach = lambda top: F.col("norm") * top + 1e-6 * (1 + F.col("norm") * F.abs(top))
    left = members.join(_few(spans, n_spans), "cluster").filter(reach(F.col("first")) >= F.col("least"))
    # the same condition solved for the bound, with more margin
    need = F.when(F.col("norm") > 0, (F.col("least") - 2e-6) / F.col("norm")).otherwise(F.lit(NONE))
    floors, _ = written(members.groupBy("cluster", "block").agg(F.min(need).alias("floor")), "negatives-floors")
    right = lists.join(_few(floors, n_blocks), "cluster").filter(F.col("top") + 2e-6 * F.abs("top") >= F.col("floor")).drop("floor")
    return left, right


def _merged(found: DataFrame, owner: list[str], score: str, id_: str, key: str, k: int) -> DataFrame:
    """The best k rows of each owner over all spans, as ``rank``."""
    w = Window.partitionBy(*owner).orderBy(F.desc(score), id_, key)
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def mine_hard_negatives(table: DataFrame, every: int = 50, mining: Mining = Mining(), id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every row
    whose id is divisible by ``every``."""
    spark = table.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows, _ = written(_rows(table, id_col, vec_col, label_col), "negatives-rows")
    is_anchor = F.col("id") % every == 0
    facts = rows.agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors"), F.max(F.size("v")).alias("dim"), F.max(F.greatest(F.array_max("v"), -F.array_min("v"))).alias("most")).first()
    if not facts["anchors"]:
        return spark.createDataFrame([], schema)
    dim = max(1, facts["dim"])
    kind = exact_type(dim * (facts["most"] or 0) ** 2 * max(mining.high, 100))
    k, per, small = mining.positives, mining.per_positive, narrow(facts["most"] or 0)

    sample = rows.filter(is_anchor).orderBy(F.xxhash64("id"), "key").limit(SAMPLE).select("v").toArrow()  # SAMPLE rows
    centers = centroids(matrix(sample.column("v"), dim).astype(np.float64), max(1, min(CLUSTERS, facts["anchors"] // MEMBERS)))
    placed, placed_path = written(rows.filter(is_anchor).mapInArrow(*_placed(centers, dim)), "negatives-anchors")
    clusters = placed.groupBy("cluster").agg(F.count("*").alias("n"), F.max("angle").alias("widest")).collect()  # at most CLUSTERS rows
    widest = np.zeros(len(centers))
    blocks = np.ones(len(centers), dtype=np.int64)
    for c in clusters:
        widest[c["cluster"]], blocks[c["cluster"]] = c["widest"] + 1e-7, -(-c["n"] // BLOCK)

    ordered = rows.mapInArrow(*_listed(centers, widest, dim, small)).withColumn("descending", -F.col("bound"))
    order = ["cluster", "descending", "key"]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-facts["n"] * len(centers) // SPAN))
    lists = ordered.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("cluster", "bound", "key", "id", "label", "v").mapInArrow(*_segments(dim, SEGMENT, small))
    lists, _ = written(lists, "negatives-lists")
    spans, _ = written(lists.groupBy("cluster", "span").agg(F.max("top").alias("first")), "negatives-spans")
    n_spans, n_blocks = tasks + len(centers), int(blocks.sum())

    deal = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("cluster") + 1)
    members = placed.withColumn("block", F.pmod(F.xxhash64("key"), deal).cast("int")).drop("angle")
    found = _positives(members, lists, spans, n_spans, n_blocks, dim, kind, k)
    ranked = _merged(found, ["key"], "score", "other_id", "other", k)
    listed = ranked.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "other_id", "score"))).alias("p"))  # at most k each
    with_p = members.join(listed, "key")
    positives, _ = written(with_p.select("key", "id", "label", "v", "cluster", "norm", "block", F.col("p.other_id").alias("p_ids"), F.col("p.score").alias("p_scores")), "negatives-positives")
    remove_path(spark, placed_path)
    mined = _negatives(positives, lists, spans, n_spans, n_blocks, dim, kind, mining)
    final = _merged(mined, ["key", "positive"], "negative_score", "negative_id", "other", per)
    return final.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _peers(members: pa.Table, dim: int, kind: type) -> Iterator[Span]:
    """A block's own members as segments without order: their bounds are never the last."""
    key, label, _, v = _member_arrays(members, dim, kind)
    ids = members.column("id").to_numpy()
    for at in range(0, len(key), SEGMENT):
        here = slice(at, at + SEGMENT)
        yield Span(np.full(len(key[here]), np.inf), key[here], ids[here], label[here], v[here])


def _positives(members: DataFrame, lists: DataFrame, spans: DataFrame, n_spans: int, n_blocks: int, dim: int, kind: type, k: int) -> DataFrame:
    def seed(t: pa.Table) -> pa.Table:
        key, label, norm, v = _member_arrays(t, dim, kind)
        best, _ = walk_positives(_peers(t, dim, kind), key, label, np.ones(len(key)), v, np.full(len(key), NONE), k)
        return t.append_column("least", pa.array(best.theta))

    schema = "key long, id long, label long, v array<bigint>, cluster int, norm double, block int, least double"
    seeded, _ = written(members.select("key", "id", "label", "v", "cluster", "norm", "block").groupBy("cluster", "block").applyInArrow(seed, schema), "negatives-seeds")

    def walk(m: pa.Table, s: pa.Table) -> pa.Table:
        names = ["key", "other", "other_id", "score"]
        if not m.num_rows or not s.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names=names)
        key, label, norm, v = _member_arrays(m, dim, kind)
        best, _ = walk_positives(Span.of(s, dim, kind), key, label, norm, v, m.column("least").to_numpy(), k)
        return pa.table([pa.array(key[best.owner]), pa.array(best.key), pa.array(best.id), pa.array(best.score)], names=names)

    left, right = _dealt(seeded, lists, spans, n_spans, n_blocks)
    group = ("cluster", "block", "span")
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(walk, "key long, other long, other_id long, score long")


def _windows(p_scores: pa.ChunkedArray, mining: Mining) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest negative score of each positive; lowest above highest where none fits."""
    p = matrix(p_scores, mining.positives)
    there = np.arange(mining.positives) < pc.list_value_length(p_scores).to_numpy()[:, None]
    low, high = -((-mining.low * p) // 100), (mining.high * p) // 100
    return np.where(there, low, 1).astype(np.float64), np.where(there, high, 0).astype(np.float64)


def _negatives(members: DataFrame, lists: DataFrame, spans: DataFrame, n_spans: int, n_blocks: int, dim: int, kind: type, mining: Mining) -> DataFrame:
    windows, k = mining.positives, mining.per_positive

    def seed(t: pa.Table) -> pa.Table:
        key, label, _, v = _member_arrays(t, dim, kind)
        low, high = _windows(t.column("p_scores"), mining)
        best, _ = walk_negatives(_peers(t, dim, kind), label, np.ones(len(key)), v, low, high, k)
        theta = best.theta.reshape(low.shape)
        least = np.where(theta <= high, theta, np.inf).min(axis=1)
        return t.append_column("thetas", as_lists(theta)).append_column("least", pa.array(least))

    columns = "key long, id long, label long, v array<bigint>, cluster int, norm double, block int, p_ids array<bigint>, p_scores array<bigint>"
    seeded = members.groupBy("cluster", "block").applyInArrow(seed, columns + ", thetas array<double>, least double")
    seeded, _ = written(seeded.filter(F.col("least") < float("inf")), "negatives-windows")  # no window fits a positive of a negative score

    def walk(m: pa.Table, s: pa.Table) -> pa.Table:
        names = ["anchor_id", "key", "positive", "positive_id", "positive_score", "other", "negative_id", "negative_score"]
        if not m.num_rows or not s.num_rows:
            return pa.table([pa.array([], pa.int64())] * len(names), names=names)
        key, label, norm, v = _member_arrays(m, dim, kind)
        _, high = _windows(m.column("p_scores"), mining)
        theta = np.stack(m.column("thetas").to_numpy())
        best, _ = walk_negatives(Span.of(s, dim, kind), label, norm, v, theta, high, k)
        member, window = best.owner // windows, best.owner % windows
        p_ids, p_scores = (matrix(m.column(c), windows)[member, window] for c in ("p_ids", "p_scores"))
        return pa.table([pa.array(x) for x in (m.column("id").to_numpy()[member], key[member], window, p_ids, p_scores, best.key, best.id, best.score)], names=names)

    left, right = _dealt(seeded, lists, spans, n_spans, n_blocks)
    group = ("cluster", "block", "span")
    schema = "anchor_id long, key long, positive long, positive_id long, positive_score long, other long, negative_id long, negative_score long"
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(walk, schema)


def relabelled(table: DataFrame) -> DataFrame:
    """The table with label (label + 1) % 10 where the id is divisible by 7."""
    label: Column = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return table.select("vec_id", "embedding", label.alias("label"))
