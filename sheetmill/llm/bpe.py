"""Byte-level BPE encoding and decoding with padded numpy matrices.

A text is split by the pattern; the distinct pieces of an Arrow batch are encoded once and the
ids put together per document.  Pieces go into buckets of similar length, one matrix per
bucket, a row per piece, padded with -1.  Each round every row merges its leftmost pair of
minimum rank: the row's pair ranks are kept beside it, so a round needs one argmin, one shift
and two new look-ups per row, in an open-addressing table of (left id, right id) -> merged id.
Rows without a known pair are finished and leave the matrix (compaction).  A piece that is a
token itself needs no merging.  Pieces above ``LONG`` bytes would cost their length squared
there; they merge in the same order from a heap.

Decoding gathers the bytes of the ids.

Defined results: NULL text counts as empty (no ids, empty bytes); NULL ids and repeated rows
are encoded like any other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetmill.llm.common import gather, quoted, text_of

LONG = 2048
NONE = np.int32(2**31 - 1)
BUCKETS = (4, 8, 12, 16, 24, 32, 64, 128, 256, 512, 1024, LONG)
CELLS = 1 << 21
BLOCK = 1 << 22


class PairTable:
    """(left id, right id) -> merged id: open addressing, linear probing, all in numpy."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, merged = [], [], []
        get = ranks.get
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        keys = np.array(left, dtype=np.int64) << 32 | np.array(right, dtype=np.int64)
        self.bits = max(4, int(np.ceil(np.log2(4 * max(1, len(keys))))))
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int32)
        values, slots = np.array(merged, dtype=np.int32), self._slots(keys)
        while len(keys):
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[free]  # of several keys for one slot the last stays
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, NONE for unknown pairs and for padding."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        keys = np.where((left < 0) | (right < 0), -2, keys)
        slots = self._slots(keys)
        out = np.full(keys.shape, NONE, dtype=np.int32)
        todo = np.flatnonzero(keys != -2)
        while len(todo):
            seen = self.keys[slots[todo]]
            hit = seen == keys[todo]
            out[todo[hit]] = self.values[slots[todo[hit]]]
            todo = todo[~hit & (seen != -1)]
            slots[todo] = (slots[todo] + 1) & (len(self.keys) - 1)
        return out


class Codec:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.token_sizes = np.array([len(t) for t in tokens], dtype=np.int64)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the pieces and the number of ids of each."""
        whole = np.array([self.ranks.get(p, -1) for p in pieces], dtype=np.int64)
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        owners, values = [np.flatnonzero(whole >= 0)], [whole[whole >= 0].astype(np.int32)]
        open_ = whole < 0
        low = 0
        for width in BUCKETS:
            rows = np.flatnonzero(open_ & (sizes > low) & (sizes <= width))
            low = width
            for at in range(0, len(rows), max(1, CELLS // width)):
                some = rows[at : at + max(1, CELLS // width)]
                owner, ids = self._merge([pieces[i] for i in some], sizes[some], width)
                owners.append(some[owner])
                values.append(ids)
        for i in np.flatnonzero(open_ & (sizes > LONG)):
            ids = self._merge_long(pieces[i])
            owners.append(np.full(len(ids), i))
            values.append(ids)
        owner, flat = np.concatenate(owners), np.concatenate(values)
        order = np.argsort(owner, kind="stable")
        return flat[order], np.bincount(owner, minlength=len(pieces)).astype(np.int64)

    def _merge(self, pieces: list[bytes], sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(pieces)
        ids = np.full((n, width), -1, dtype=np.int32)
        real = np.arange(width) < sizes[:, None]
        ids[real] = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        rank = np.full((n, width), NONE, dtype=np.int32)  # rank[r, j]: of the pair at j, j + 1
        rank[:, :-1] = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        row = np.arange(n)
        owners, values = [], []
        while len(row):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(row)), at]
            done = best == NONE
            if done.any():
                kept = ids[done]
                owners.append(np.repeat(row[done], (kept >= 0).sum(axis=1)))
                values.append(kept[kept >= 0])
                live = ~done
                ids, rank, row, at, best = ids[live], rank[live], row[live], at[live], best[live]
                if not len(row):
                    break
            lines = np.arange(len(row))
            ids[lines, at] = best
            shift = np.arange(ids.shape[1] - 1) + (np.arange(ids.shape[1] - 1) > at[:, None])
            ids = np.take_along_axis(ids, shift, axis=1)
            shift = np.arange(rank.shape[1] - 1) + (np.arange(rank.shape[1] - 1) >= at[:, None])
            rank = np.take_along_axis(rank, shift, axis=1)
            after = np.where(at + 1 < ids.shape[1], ids[lines, np.minimum(at + 1, ids.shape[1] - 1)], -1)
            rank[lines, np.minimum(at, rank.shape[1] - 1)] = self.pairs.find(ids[lines, at], after)
            some = at > 0
            rank[lines[some], at[some] - 1] = self.pairs.find(ids[lines[some], at[some] - 1], ids[lines[some], at[some]])
        return (np.concatenate(owners), np.concatenate(values)) if owners else (row, np.zeros(0, dtype=np.int32))

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges from a heap of (rank, place), for very long pieces."""
        import heapq

        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(ids)
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.find(np.array(ids[:-1], dtype=np.int32), np.array(ids[1:], dtype=np.int32))
        heap = [(int(first[i]), int(i)) for i in np.flatnonzero(first != NONE)]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}

        def rank(i: int) -> int:
            if i < 0 or following[i] >= n:
                return int(NONE)
            pair = (ids[i], ids[following[i]])
            if pair not in known:
                known[pair] = int(self.pairs.find(np.array([pair[0]], dtype=np.int32), np.array([pair[1]], dtype=np.int32))[0])
            return known[pair]

        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank(i) != r:
                continue  # merged or changed since it was queued
            j = following[i]
            ids[i], ids[j] = r, -1
            following[i] = following[j]
            if following[i] < n:
                previous[following[i]] = i
            for k in (previous[i], i):
                if (q := rank(k)) != NONE:
                    heapq.heappush(heap, (q, k))
        return np.array([x for x in ids if x >= 0], dtype=np.int32)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all lists of ids, and the number of bytes of each."""
        flat, per_id = gather(self.token_bytes, self.token_sizes, ids.astype(np.int64))
        bounds = np.r_[0, np.cumsum(per_id)][np.r_[0, np.cumsum(sizes)]]
        return flat, np.diff(bounds)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _binary(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.r_[0, np.cumsum(sizes)]
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def _round_trip(ranks: dict[bytes, int], pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split, codec = regex.compile(pattern).findall, None
        for whole in batches:
            at = 0
            sizes = pc.binary_length(whole.column("text")).to_numpy(zero_copy_only=False)
            while at < whole.num_rows:  # a bounded number of bytes at a time
                stop = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), BLOCK)))
                batch, at = whole.slice(at, stop - at), stop
                codec = codec or Codec(ranks)
                pieces, counts = [], []
                for text in batch.column("text").to_pylist():
                    found = split(text)
                    pieces += found
                    counts.append(len(found))
                coded = pa.array(pieces, pa.string()).dictionary_encode()
                flat, each = codec.encode([p.encode() for p in coded.dictionary.to_pylist()])
                ids, per_piece = gather(flat, each, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
                n = np.diff(np.r_[0, np.cumsum(per_piece)][np.r_[0, np.cumsum(counts)].astype(np.int64)])
                decoded, bytes_of = codec.decode(ids, n)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), _binary(ids.astype("<u4"), 4 * n), _binary(decoded, bytes_of)], names=["id", "n_tokens", "ids", "decoded"])

    return run


def encode_decode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids as little-endian unsigned 32-bit integers, decoded bytes) per row."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    ranks = read_ranks(ranks_path or default_ranks())  # a vocabulary of fixed size, shipped with the tasks
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(_round_trip(ranks, pattern), "id long, n_tokens long, ids binary, decoded binary")


def bpe_report(docs: DataFrame) -> DataFrame:
    coded = encode_decode(docs)
    return coded.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
