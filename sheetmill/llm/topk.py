"""Exact top-k by inner product with norm-sorted pruning.

Vectors become integers, floor(256 x) per component.  Queries and candidates are dealt into
blocks of bounded size by a hash of the id (so equal vectors spread evenly); each pair of a
query block and a candidate block is one group of a cogroup.  Within a group candidates are
processed by descending length:

* A query's threshold is its k-th best score so far.  It starts from a bounded set of seeds,
  the longest vectors of all, so pruning works from the first candidate on.
* Cauchy-Schwarz on whole vectors: once |q| times the length of the next candidates is below
  the threshold, the query has finished the block.
* Vectors are rotated by the eigenvectors of the Gram matrix of all vectors (SVD), so the
  first coordinates carry most of the product.  The partial sum over these plus the product of
  the lengths of the residuals bounds the score; only candidates whose bound reaches the
  threshold get the exact integer product.

Bounds are rounded up by a margin above the floating-point error; scores are exact integers.
Each block returns at most k rows per query; a last window keeps the best k.

Defined results: vectors that are NULL or hold a NULL or non-finite component, and rows with
a NULL id, take no part; shorter vectors count as padded with zeros; rows that repeat an id are
rows of their own, as queries too (each is a candidate of the others); ties go to the smaller
id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheetmill.llm.common import integer_components, quoted, takes_part
from sheetmill.session import materialize

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 4096
SEEDS = 256
STEP = 512


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(key, id, v, norm2): every row that takes part; ``key`` tells rows of one id apart once the
    table is written."""
    fine = table.filter(takes_part(F.col(quoted(vec_col))) & F.col(quoted(id_col)).isNotNull())
    whole = fine.select(F.monotonically_increasing_id().alias("key"), F.col(quoted(id_col)).cast("long").alias("id"), integer_components(F.col(quoted(vec_col))).alias("v"))
    return whole.select("key", "id", "v", F.aggregate("v", F.lit(0).cast("long"), lambda a, c: a + c * c).alias("norm2"))


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of an Arrow list column as an int64 matrix, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
    offsets = np.asarray(column.offsets, dtype=np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64)
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), dim), dtype=np.int64)
    out[np.arange(dim) < lengths[:, None]] = values
    return out


def gram(vectors: DataFrame, dim: int) -> np.ndarray:
    """Sum of outer products over all vectors; dim x dim numbers reach the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_ = np.zeros((dim, dim)), False
        for batch in batches:
            m = matrix(batch.column(0), dim).astype(np.float64)
            total += m.T @ m
            any_ = any_ or len(m) > 0
        if any_:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim * dim)), pa.array(total.ravel())], names=["i", "s"])

    out = np.zeros(dim * dim)
    for r in vectors.select("v").mapInArrow(sums, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
        out[r["i"]] = r["s"]
    return out.reshape(dim, dim)


def best_k(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of each owner's k best (score descending, id ascending), sorted by owner."""
    order = np.lexsort((ids, -score, owner))
    o = owner[order]
    starts = np.flatnonzero(np.r_[True, o[1:] != o[:-1]]) if len(o) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(o)) - np.repeat(starts, np.diff(np.r_[starts, len(o)]))
    return order[place < k]


def search_block(q: np.ndarray, q_keys: np.ndarray, theta: np.ndarray, c: np.ndarray, c_ids: np.ndarray, rotation: np.ndarray, k: int, c_keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query index, candidate id, score) of up to k candidates per query, and how many exact
    products were needed.  ``theta``: scores that a candidate must reach; ``c_keys``: row keys of the
    candidates (their ids if not given), a query's own row is none of its candidates."""
    order = np.argsort(-(c * c).sum(axis=1), kind="stable")
    c_keys = (c_ids if c_keys is None else c_keys)[order]
    c, c_ids = c[order], c_ids[order]
    head = max(1, rotation.shape[0] // 4)
    qr, cr = q @ rotation, c @ rotation
    q_norm, c_norm = np.sqrt((q * q).sum(axis=1)), np.sqrt((c * c).sum(axis=1))
    rest = lambda m: np.sqrt((m[:, head:] ** 2).sum(axis=1))
    q_rest, c_rest = rest(qr), rest(cr)
    margin = 1e-6 * (1 + (q_norm.max(initial=0) * c_norm.max(initial=0)))
    theta = theta.astype(np.float64).copy()
    owner, found, score = (np.zeros(0, dtype=np.int64) for _ in range(3))
    exact = 0
    for at in range(0, len(c), STEP):
        live = np.flatnonzero(q_norm * c_norm[at] + margin >= theta)
        if not len(live):
            break
        stop = at + STEP
        bound = qr[live, :head] @ cr[at:stop, :head].T + np.outer(q_rest[live], c_rest[at:stop]) + margin
        i, j = np.nonzero((bound >= theta[live, None]) & (q_keys[live, None] != c_keys[at:stop]))
        i, j = live[i], j + at
        exact += len(i)
        owner, found = np.r_[owner, i], np.r_[found, c_ids[j]]
        score = np.r_[score, np.concatenate([np.einsum("ij,ij->i", q[i[p : p + 65536]], c[j[p : p + 65536]]) for p in range(0, max(1, len(i)), 65536)])]
        keep = best_k(owner, score, found, k)
        owner, found, score = owner[keep], found[keep], score[keep]
        full = np.bincount(owner, minlength=len(q)) == k
        last = np.flatnonzero(np.r_[owner[1:] != owner[:-1], True]) if len(owner) else owner
        kth = np.full(len(q), -np.inf)
        kth[owner[last]] = score[last]
        theta = np.where(full, np.maximum(theta, kth), theta)
    return owner, found, score, exact


def top_k(table: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for every row whose id is divisible by ``every``."""
    vectors = materialize(integer_vectors(table, id_col, vec_col), "topk-vectors")
    facts = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.count_if(F.col("id") % every == 0).alias("queries")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not facts["n"] or not facts["queries"]:
        return table.sparkSession.createDataFrame([], schema)
    dim = max(1, facts["dim"])
    rotation = np.linalg.eigh(gram(vectors, dim))[1][:, ::-1].copy()
    seeds = vectors.orderBy(F.desc("norm2"), "id", "key").limit(SEEDS).select("key", "v").toPandas()  # SEEDS rows
    seed_keys = seeds["key"].to_numpy(dtype=np.int64)
    seed_vectors = np.zeros((len(seeds), dim), dtype=np.int64)
    for i, v in enumerate(seeds["v"]):
        seed_vectors[i, : len(v)] = v

    def thresholds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, keys = matrix(batch.column("v"), dim), batch.column("key").to_numpy()
            theta = np.full(len(q), np.iinfo(np.int64).min // 2)
            for at in range(0, len(q), 4096):
                s = q[at : at + 4096] @ seed_vectors.T
                s = np.where(keys[at : at + 4096, None] == seed_keys, np.iinfo(np.int64).min // 2, s)
                if s.shape[1] >= k:
                    theta[at : at + 4096] = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "id", "v")), pa.array(theta)], names=["key", "id", "v", "theta"])

    queries = vectors.filter(F.col("id") % every == 0).select("key", "id", "v").mapInArrow(thresholds, "key long, id long, v array<bigint>, theta long")
    n_q, n_c = -(-facts["queries"] // QUERY_BLOCK), -(-facts["n"] // CANDIDATE_BLOCK)
    dealt = lambda n: F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
    left = queries.select(dealt(n_q).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))).alias("cb"), "key", "id", "v", "theta")
    right = vectors.select(F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("qb"), dealt(n_c).alias("cb"), "key", "id", "v")

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        names = ["key", "query_id", "vec_id", "score"]
        if not a.num_rows or not b.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names=names)
        ids, keys = a.column("id").to_numpy(), a.column("key").to_numpy()
        owner, found, score, _ = search_block(matrix(a.column("v"), dim), keys, a.column("theta").to_numpy(), matrix(b.column("v"), dim), b.column("id").to_numpy(), rotation, k, b.column("key").to_numpy())
        return pa.table([pa.array(x, pa.int64()) for x in (keys[owner], ids[owner], found, score)], names=names)

    found = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(search, "key long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
