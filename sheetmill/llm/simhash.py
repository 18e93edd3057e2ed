"""SimHash near-duplicates through the generalised pigeonhole principle.

Fingerprints: words of the text (A-Z lower-cased), word shingles, XXH64 of each; a bit is 1 if
set in over half the hashes.  Hashing is native; numpy counts the bits of each Arrow batch.

Linking (Hamming distance at most ``tau``) works on distinct fingerprints, so copies collapse
first.  The 64 bits are split into ``m`` partitions with thresholds ``T_i >= -1`` that add up
to ``tau - m + 1``: any two fingerprints within ``tau`` bits are within ``T_i`` in some
partition.

* Correlated bits are grouped (from the 64 x 64 co-occurrence counts of all fingerprints), so
  that the partitions are as independent of one another as possible.
* For each layout (``m`` = 3, 4, 5) the number of candidates per partition is estimated from
  the exact value counts over all fingerprints, and a dynamic program spends the threshold
  budget unequally where it costs least: -1 skips a partition, 0 probes equal values, 1 probes
  equal values with each bit masked out in turn.
* Probing is a shuffle by (mask, masked value).  A bucket with more than ``bucket`` members is
  split by the pigeonhole principle again: the remaining bits are cut in ``tau + 1`` groups,
  one of which must agree.  Up to ``depth`` such rounds, each exact.
* Verifying: sorted runs of a bucket are compared with numpy, block by block.  Instead of all
  links of a bucket it emits a spanning forest of them (a breadth-first search within the
  bucket), which keeps exactly the same components.

Components: alternating large-star / small-star steps over written tables until nothing
changes; no part of it reaches the driver but a count and a checksum per round.

Defined results: a text without words has fingerprint zero and links like any other; NULL
text likewise; a NULL id never names a component, and a component without any id has a NULL
``component_id``; repeated rows give repeated result rows; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetmill.llm.common import let, quoted, text_of, whole_row, words_of
from sheetmill.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Cost of one extra probe key, in candidate pairs.
KEY_COST = 8.0
CHUNK = 1 << 17


def shingle_hashes(text: Column, k: int = 3) -> Column:
    """XXH64 (seed 42) of each k-word shingle; one hash of the whole list if it is shorter."""
    words = words_of(F.translate(text, UPPER, LOWER))

    def hashes(ws: Column) -> Column:
        shingle = lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(ws, i + j) for j in range(k)]))
        return F.when(F.size(ws) >= k, F.transform(F.sequence(F.lit(0), F.size(ws) - k), shingle)).when(F.size(ws) > 0, F.array(F.xxhash64(F.concat_ws(" ", ws)))).otherwise(F.array().cast("array<bigint>"))

    return let(words, hashes)


def majority_bits(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprint (uint64) of each list of 64-bit hashes; at most CHUNK hashes unpacked at once."""
    n = len(offsets) - 1
    counts = np.zeros((n, 64), dtype=np.int64)
    lengths = np.diff(offsets)
    owner = np.repeat(np.arange(n), lengths)
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)
    for at in range(0, len(raw), CHUNK):
        bits = np.unpackbits(raw[at : at + CHUNK], axis=1, bitorder="little")
        own = owner[at : at + CHUNK]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        counts[own[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    return np.packbits(2 * counts > lengths[:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("h")
        offsets = np.asarray(lists.offsets, dtype=np.int64)
        values = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
        fp = majority_bits(values.astype(np.int64, copy=False), offsets - offsets[0]).view(np.int64)
        more = batch.schema.names[2:]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fp), *(batch.column(c) for c in more)], names=["id", "fp", *more])


def fingerprints(docs: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(id, fp): one row per input row; with ``digest`` also a hash of the text."""
    more = [F.xxhash64(text_of(text_col)).alias("digest")] if digest else []
    hashed = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), shingle_hashes(text_of(text_col), k).alias("h"), *more)
    return hashed.mapInArrow(_fingerprint_batches, "id long, fp long" + (", digest long" if digest else ""))


# -- layout -------------------------------------------------------------------------------------


def bit_statistics(fps: DataFrame) -> np.ndarray:
    """Co-occurrence counts of set bits over all fingerprints (64 x 64) with the row count in
    front: each task sums its own matrix, Spark adds them up, 4097 numbers reach the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            v = batch.column(0).to_numpy().astype(np.int64)
            n += len(v)
            for at in range(0, len(v), CHUNK):
                bits = np.unpackbits(v[at : at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(4097)), pa.array(np.r_[n, total.ravel()])], names=["i", "v"])

    out = np.zeros(4097)
    for r in fps.select("fp").mapInArrow(sums, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


def group_correlated(stats: np.ndarray, m: int) -> list[list[int]]:
    """Greedy grouping: each partition starts with the free bit of the strongest correlation
    and takes the bits most correlated with its members until it has its share of 64 / m."""
    n = max(1.0, stats[0])
    joint = stats[1:].reshape(64, 64) / n
    p = np.diag(joint)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((joint - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, groups = set(range(64)), []
    for i in range(m):
        size = 64 // m + (i < 64 % m)
        rest = sorted(free)
        group = [max(rest, key=lambda b: (corr[b, rest].max(initial=0), -b))]
        free.discard(group[0])
        while len(group) < size:
            best = max(sorted(free), key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def allocate(costs: list[dict[int, float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds per partition with the given sum and the least total cost (dynamic program
    over partitions and the sum so far)."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (c, chosen) in best.items():
            for t, extra in cost.items():
                if used + t not in after or c + extra < after[used + t][0]:
                    after[used + t] = (c + extra, [*chosen, t])
        best = after
    return best.get(budget, (float("inf"), []))


def plan_probes(fps: DataFrame, tau: int = 3, layouts: tuple[int, ...] = (3, 4, 5)) -> list[int]:
    """Masks to probe by equality, chosen as the module text describes."""
    stats = bit_statistics(fps)
    n = max(1.0, stats[0])
    agree = np.array([(p := stats[1 + 65 * b] / n) ** 2 + (1 - p) ** 2 for b in range(64)])
    grouped = {m: group_correlated(stats, m) for m in layouts}
    arms = [(m, i, mask_of(g)) for m, groups in grouped.items() for i, g in enumerate(groups)]
    probes = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.col("fp").bitwiseAND(F.lit(signed(mask))).alias("v")) for a, (_, _, mask) in enumerate(arms)]))
    pairs = fps.select(probes.alias("p")).groupBy("p.a", "p.v").count().groupBy("a").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("c"))
    equal = {r["a"]: r["c"] for r in pairs.collect()}  # one row per partition of each layout
    best: tuple[float, list[int]] = (float("inf"), [])
    for m, groups in grouped.items():
        costs = []
        for i, group in enumerate(groups):
            same = equal.get(next(a for a, x in enumerate(arms) if x[:2] == (m, i)), 0.0)
            near = float(np.sum((1 - agree[group]) / agree[group]))  # pairs one bit apart per equal pair, if bits were independent
            costs.append({-1: 0.0, 0: same + KEY_COST * n, 1: same * len(group) + same * near + KEY_COST * n * len(group)})
        cost, thresholds = allocate(costs, tau - m + 1)
        if cost < best[0]:
            masks = []
            for group, t in zip(groups, thresholds, strict=True):
                masks += {-1: [], 0: [mask_of(group)], 1: [mask_of([b for b in group if b != x]) for x in group]}[t]
            best = (cost, masks)
    return best[1]


# -- links --------------------------------------------------------------------------------------


def spanning_links(fp: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links (distance <= tau) among distinct fingerprints."""
    rest, a, b = fp, [], []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            near = np.bitwise_count(rest ^ node) <= tau
            if near.any():
                found, rest = rest[near], rest[~near]
                a.append(np.full(len(found), node, dtype=fp.dtype))
                b.append(found)
                queue.extend(found)
    if not a:
        return fp[:0], fp[:0]
    return np.concatenate(a), np.concatenate(b)


def _verify(tau: int, small: int = 48):
    """Links within runs of equal (mask, value); the input is sorted by them."""

    def links(mask: np.ndarray, val: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (val[1:] != val[:-1])])
        sizes = np.diff(np.r_[starts, len(fp)])
        run = np.repeat(np.arange(len(starts)), sizes)
        out_a, out_b = [fp[:0]], [fp[:0]]
        short = sizes[run] <= small
        for d in range(1, int(sizes[sizes <= small].max(initial=1))):
            ok = short[:-d] & (run[d:] == run[:-d])
            at = np.flatnonzero(ok)
            if not len(at):
                break
            at = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= tau]
            out_a.append(fp[at])
            out_b.append(fp[at + d])
        for r in np.flatnonzero(sizes > small):
            a, b = spanning_links(fp[starts[r] : starts[r] + sizes[r]], tau)
            out_a.append(a)
            out_b.append(b)
        return np.concatenate(out_a), np.concatenate(out_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []  # the last run may go on in the next batch

        def closed(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            if parts:
                a, b = links(*[np.concatenate(x) for x in zip(*parts, strict=True)])
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b).view(np.int64)), pa.array(np.minimum(a, b).view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = tuple(batch.column(i).to_numpy().astype(np.int64).view(np.uint64) for i in range(3))
            change = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            tail = int(change[-1]) + 1 if len(change) else 0
            if tail == 0 and kept and (kept[-1][0][-1], kept[-1][1][-1]) == (cols[0][0], cols[1][0]):
                kept.append(cols)
                continue
            yield from closed([*kept, tuple(c[:tail] for c in cols)] if tail else kept)
            kept = [tuple(c[tail:] for c in cols)]
        yield from closed(kept)

    return run


def probe_rows(fps: DataFrame, masks: list[int], tau: int, bucket: int, depth: int) -> DataFrame:
    """(mask, val, fp) for every probe; buckets above ``bucket`` members refined ``depth`` times."""
    probe = lambda ms: F.explode(F.array(*[F.lit(signed(x)) for x in ms]))
    val = F.col("mask").bitwiseAND(F.col("fp")).alias("val")
    rows = fps.select(probe(masks).alias("mask"), "fp").select("mask", val, "fp")
    done = []
    for _ in range(depth):
        hot = materialize(rows.groupBy("mask", "val").count().filter(F.col("count") > bucket).select("mask", "val"), "simhash-hot")
        if hot.isEmpty():
            break
        done.append(rows.join(hot, ["mask", "val"], "left_anti").select("mask", "val", "fp"))
        finer = {}
        for mask in masks:
            rest = [b for b in range(64) if not mask >> b & 1]
            if len(rest) > tau:
                finer[mask] = [mask | mask_of(rest[g :: tau + 1]) for g in range(tau + 1)]
            else:
                finer[mask] = [mask]
        table = F.create_map(*[x for m, subs in finer.items() for x in (F.lit(signed(m)), F.array(*[F.lit(signed(s)) for s in subs]))])
        dense = rows.join(hot, ["mask", "val"], "left_semi").select("mask", "fp")
        rows = dense.select(F.explode(F.element_at(table, F.col("mask"))).alias("mask"), "fp").select("mask", val, "fp")
        masks = sorted({s for subs in finer.values() for s in subs})
    for other in done:
        rows = rows.unionByName(other)
    return rows


def near_links(fps: DataFrame, tau: int = 3, bucket: int = 4096, depth: int = 3) -> DataFrame:
    """Links (a > b) between distinct fingerprints that connect all pairs within ``tau`` bits."""
    rows = probe_rows(fps, plan_probes(fps, tau), tau, bucket, depth)
    dealt = rows.repartition("mask", "val").sortWithinPartitions("mask", "val")
    return dealt.mapInArrow(_verify(tau), "a long, b long").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reached."""
    edges = materialize(edges, "simhash-edges")
    seen = None

    def minima(pairs: DataFrame) -> DataFrame:
        return materialize(pairs.groupBy("u").agg(F.min("v").alias("m")), "simhash-min")

    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = minima(both).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = materialize(large.distinct(), "simhash-large")  # u > v in every row
        low = minima(large)
        small = large.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = materialize(small.distinct(), "simhash-edges")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = state


def near_duplicates(docs: DataFrame, k: int = 3, tau: int = 3, id_col: str = "doc_id", text_col: str = "text", bucket: int = 4096, depth: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    by_doc, named = _components(fingerprints(docs, k, id_col, text_col), tau, bucket, depth)
    return by_doc.join(named, "fp").select(F.col("id").alias("doc_id"), "fp", "component_id")


def _components(printed: DataFrame, tau: int, bucket: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``printed`` (id, fp, ...) written, and (fp, root, component_id) of every fp."""
    by_doc = materialize(printed, "simhash-docs")
    fps = materialize(by_doc.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-fps")
    roots = connected(near_links(fps, tau, bucket, depth))
    rooted = materialize(fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "rep", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    names = materialize(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "simhash-names")
    return by_doc, materialize(rooted.join(names, "root").select("fp", "root", "component_id"), "simhash-named")


def simhash_report(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, k: int = 3, tau: int = 3, id_col: str = "doc_id", text_col: str = "text", bucket: int = 4096, depth: int = 3) -> DataFrame:
    """One row of each component: of the smallest id (rows without one come last), then of the
    smallest text hash; of rows that agree in both, one.  So a component keeps a row whatever else
    its ids stand for, and rows without an id are near duplicates like any other."""
    print_of = fingerprints(docs, k, id_col, text_col, digest=True)
    by_doc, named = _components(print_of, tau, bucket, depth)
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "digest"))
    keep = by_doc.join(named.select("fp", "root"), "fp").groupBy("root").agg(first.alias("k"))
    # two components never share (id, digest): equal texts have one fingerprint
    nullable = lambda c: [F.coalesce(c, F.lit(0)).alias("i"), c.isNull().alias("z")]
    keep = materialize(keep.select(*nullable(F.col("k.id")), F.col("k.digest").alias("digest")), "simhash-keep")
    id_ = F.col(quoted(id_col)).cast("long")
    mine = docs.select(whole_row(docs).alias("row"), *nullable(id_), F.xxhash64(text_of(text_col)).alias("digest"))
    other = F.xxhash64(*[F.col(f"row.{quoted(f.name)}") for f in docs.schema.fields if "map" not in f.dataType.simpleString()])
    # one exchange serves the join and the choice among rows that agree in id and text
    one = mine.join(keep, ["i", "z", "digest"], "left_semi").groupBy("i", "z", "digest").agg(F.min_by("row", other).alias("row"))
    return one.select("row.*")
