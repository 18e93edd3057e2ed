"""Vector code compression by active-entry Lloyd iterations.

Vectors become integers, floor(256 x) per component, and are cut into ``parts`` equal
consecutive parts.  Each part position has a codebook of at most ``entries`` integer entries,
at first that part of the rows with the smallest ids.  A round assigns every part to its
nearest entry (squared Euclidean distance, ties to the lower index) and replaces each entry by
the componentwise floor of its parts' mean; unused entries stay.  A last assignment follows.

The written state of a round holds every part's code and exact distance.  The next round knows
which entries moved:

* A part whose entry stayed fixed still has its stored distance, and no other fixed entry can
  have become nearer, so it is compared with the moved entries only.
* Any other part is compared with the whole codebook.

Either way the result is that of a full scan, lower index first on ties.

Spark deals the rows; a task sums its parts per (part, entry) before anything is shuffled, so
``parts x entries`` rows per task reach the shuffle and ``parts x entries`` the driver.  A
state table is deleted once the next one is written.

Distances are exact: in double precision while all terms stay below 2^53, in 64-bit integers
while they stay below 2^62; larger components raise ``ValueError``.

Defined results: vectors that are NULL or hold a NULL or non-finite component take no part;
shorter vectors (and a length that ``parts`` does not divide) count as padded with zeros; a row
with a NULL id is coded but sorts last among the first entries; repeated rows are rows of their
own; fewer rows than entries give smaller codebooks; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetmill.llm.common import as_lists, exact_type, integer_components, quoted, takes_part, written
from sheetmill.llm.topk import matrix
from sheetmill.session import remove_path

PARTS = 16
ENTRIES = 64
ROUNDS = 2


@dataclass
class Compression:
    """``rows``: id, label, code (entry index per part), dist (squared distance per part)."""

    rows: DataFrame
    codebooks: np.ndarray  # parts x entries x components
    compared: int  # (part, entry) distances that the rounds after the first computed


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, rows of ``x`` by rows of ``entries``."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the lowest on ties, and its squared distance."""
    d = distances(x, book)
    code = d.argmin(axis=1)
    return code, d[np.arange(len(x)), code]


def reassign(x: np.ndarray, book: np.ndarray, code: np.ndarray, dist: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """As ``nearest(x, book)``, given the nearest entries and distances before the entries
    ``moved`` changed; and how many distances that took."""
    code, dist = code.copy(), dist.copy()
    rescan = moved[code]
    active = np.flatnonzero(moved)
    keep = np.flatnonzero(~rescan)
    compared = int(rescan.sum()) * len(book) + len(keep) * len(active)
    if len(active) and len(keep):
        place, d = nearest(x[keep], book[active])
        other = active[place]
        better = (d < dist[keep]) | ((d == dist[keep]) & (other < code[keep]))
        code[keep[better]], dist[keep[better]] = other[better], d[better]
    if rescan.any():
        code[rescan], dist[rescan] = nearest(x[rescan], book)
    return code, dist, compared


def _assigned(books: np.ndarray, moved: np.ndarray | None, kind):
    """mapInArrow: adds or renews code and dist of every row."""
    parts, _, d = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books_ = books.astype(kind)
        for batch in batches:
            x = matrix(batch.column("v"), parts * d).astype(kind)
            codes, dists = np.zeros((2, len(x), parts), dtype=np.int64)
            compared = np.zeros(len(x), dtype=np.int64)
            before = None if moved is None else (matrix(batch.column("code"), parts), matrix(batch.column("dist"), parts))
            for p in range(parts):
                part = np.ascontiguousarray(x[:, p * d : (p + 1) * d])
                if before is None:
                    codes[:, p], dists[:, p] = nearest(part, books_[p])
                else:
                    codes[:, p], dists[:, p], n = reassign(part, books_[p], before[0][:, p], before[1][:, p].astype(kind), moved[p])
                    compared[:1] += n
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), batch.column("v"), as_lists(codes.astype(np.int32)), as_lists(dists), pa.array(compared)], names=["id", "label", "v", "code", "dist", "compared"])

    return run


def _sums(parts: int, entries: int, d: int):
    """mapInArrow: number and sum of the parts of each (part, entry) of the task."""
    names = [f"s{j}" for j in range(d)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(parts * entries, dtype=np.int64)
        total = np.zeros((parts * entries, d), dtype=np.int64)
        for batch in batches:
            x = matrix(batch.column("v"), parts * d).reshape(-1, d)
            slot = (matrix(batch.column("code"), parts) + np.arange(parts) * entries).ravel()
            order = np.argsort(slot, kind="stable")
            here, first = np.unique(slot[order], return_index=True)
            n[here] += np.diff(np.r_[first, len(slot)])
            if len(here):
                total[here] += np.add.reduceat(x[order], first, axis=0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), *[pa.array(c) for c in total[some].T]], names=["slot", "n", *names])

    return run, "slot long, n long, " + ", ".join(f"{c} long" for c in names)


def means(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The next codebooks: floor of the mean of each entry's parts; unused entries stay."""
    parts, entries, d = books.shape
    run, schema = _sums(parts, entries, d)
    sums = state.select("v", "code").mapInArrow(run, schema).groupBy("slot").agg(F.sum("n").alias("n"), *[F.sum(f"s{j}").alias(f"s{j}") for j in range(d)])
    out = books.reshape(-1, d).copy()
    for r in sums.collect():  # at most parts x entries rows
        out[r["slot"]] = [r[f"s{j}"] // r["n"] for j in range(d)]
    return out.reshape(books.shape)


def compress(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> Compression | None:
    """Codes and codebooks of all rows that take part; None when there are none."""
    fine = table.filter(takes_part(F.col(quoted(vec_col))))
    columns = [F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).alias("label"), integer_components(F.col(quoted(vec_col))).alias("v")]
    state, path = written(fine.select(*columns), "codes-vectors")
    facts = state.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(F.greatest(F.array_max("v"), -F.array_min("v"))).alias("most")).first()
    if not facts["n"]:
        return None
    d = max(1, -(-facts["dim"] // parts))
    kind = exact_type(d * (2 * (facts["most"] or 0)) ** 2)
    head = state.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").toArrow()  # `entries` rows
    books = np.ascontiguousarray(matrix(head.column("v"), parts * d).reshape(-1, parts, d).transpose(1, 0, 2))
    kinds = {f.name: f.dataType.simpleString() for f in state.schema.fields}
    schema = f"id {kinds['id']}, label {kinds['label']}, v array<bigint>, code array<int>, dist array<bigint>, compared bigint"
    moved, compared = None, 0
    for step in range(rounds + 1):
        old = path
        state, path = written(state.mapInArrow(_assigned(books, moved, kind), schema), "codes-state")
        remove_path(table.sparkSession, old)
        if moved is not None:
            compared += state.agg(F.sum("compared")).first()[0]
        if step < rounds:
            renewed = means(state, books)
            moved, books = (renewed != books).any(axis=2), renewed
    return Compression(state.select("id", "label", "code", "dist"), books, compared)


def compression_report(table: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row that takes part."""
    import hashlib

    found = compress(table)
    if found is None:
        return table.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    digest = hashlib.sha256(",".join(map(str, found.codebooks.ravel().tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    error = F.aggregate("dist", F.lit(0).cast("long"), lambda a, c: a + c)
    rows = found.rows.select(F.col("id").alias("vec_id"), "label", code.alias("code"), error.alias("error"))
    by_label, _ = written(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "codes-labels")
    joined = rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
