"""Packing by concatenate and cut.

All token ids form one long stream (document after document, each followed by the end id),
cut every ``size`` ids; a piece is what one document has in one sequence.  Nothing is padded
but the last sequence.

Two passes:

1. Every task tokenises its documents and writes, per document, the ids and the running total
   of ids before it within the task (``part``, ``local``).  The table is written once; all
   later steps read it, so a retried or lost task cannot shift offsets.
2. The totals per ``part`` are prefix-summed (one number per task, bounded by the number of
   tasks) and shipped to the tasks that cut: a document's place in the stream is the offset of
   its part plus ``local``.  Each piece is a boundary record (document, start, length,
   sequence, offset).  Token ids are never shuffled.

Tokenising: white space never joins two tokens in this vocabulary, so an Arrow batch is split
at ASCII white space, its distinct chunks are tokenised once, and the ids are put together by
numpy.  Plain lower-case words go to the tokenizer many at a time (one space between them;
the last token of a word is known by the word-end mark); all other chunks one by one.

Defined results: NULL text counts as empty (one piece with only the end id); repeated rows
and NULL ids are packed like any other; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetmill.llm.common import gather, quoted, text_of
from sheetmill.session import materialize

SIZE = 2048
END_ID = 1
#: Words that go to the tokenizer together: lower-case letters that its normaliser leaves as
#: they are, perhaps with one capital letter or trailing full stop or comma around them.
PLAIN = r"[A-Za-zÀ-ÖØ-Þß-öø-ÿœ]+[.,]?"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _flags(mask: pa.BooleanArray) -> np.ndarray:
    return mask.to_numpy(zero_copy_only=False).astype(bool)


class ChunkEncoder:
    """Token ids of white-space-free chunks."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True

    def one(self, chunk: str) -> list[int]:
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def many(self, chunks: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all chunks, and the number of ids of each."""
        plain = pc.match_substring_regex(chunks, f"^(?:{PLAIN})$")
        some = chunks.filter(plain)
        stems = pc.utf8_lower(pc.utf8_rtrim(some, characters=".,")).dictionary_encode()
        mark = np.where(_flags(pc.ends_with(some, ".")), 1, np.where(_flags(pc.ends_with(some, ",")), 2, 0))
        ids, bounds = self.words(stems.dictionary.to_pylist())
        odd = chunks.filter(pc.invert(plain)).to_pylist()
        other = [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)]
        # every chunk is two rows of one table: stem and mark, or an odd chunk and nothing
        rest = [np.zeros(0, dtype=np.uint32), *(np.array(self.one(m), dtype=np.uint32) for m in ".,"), *other]
        n, is_plain = len(bounds) - 1, _flags(plain)
        rows = np.full((len(chunks), 2), n, dtype=np.int64)
        rows[is_plain, 0], rows[is_plain, 1] = stems.indices.to_numpy(zero_copy_only=False), n + mark
        rows[~is_plain, 0] = n + 3 + np.arange(len(odd))
        flat, lengths = gather(np.concatenate([ids, *rest]), np.r_[np.diff(bounds), [len(r) for r in rest]], rows.ravel())
        return flat, lengths.reshape(-1, 2).sum(axis=1)

    def words(self, words: list[str], block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of plain words and the bounds of each word in them."""
        ids, sizes = [np.zeros(0, dtype=np.uint32)], [np.zeros(0, dtype=np.int64)]
        texts = [words[i : i + block] for i in range(0, len(words), block)]
        for at in range(0, len(texts), 16):
            some = texts[at : at + 16]
            for block_words, encoding in zip(some, self.tokenizer.encode_batch_fast([" ".join(b) for b in some], add_special_tokens=False), strict=True):
                got = np.array(encoding.ids, dtype=np.uint32)
                ends = np.flatnonzero(self.ends[got])
                if len(ends) != len(block_words):  # not one word end per word: encode one by one
                    each = [np.array(self.one(w), dtype=np.uint32) for w in block_words]
                    got, ends = np.concatenate(each), np.cumsum([len(e) for e in each]) - 1
                ids.append(got)
                sizes.append(np.diff(np.r_[-1, ends]))
        return np.concatenate(ids), np.r_[0, np.cumsum(np.concatenate(sizes))]


def _token_batches(spec: str, end_id: int):
    """mapInArrow: (id, text) -> (id, part, local, n, ids as little-endian unsigned integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, part, before = None, TaskContext.get().partitionId(), 0
        for whole in batches:
            at = 0
            sizes = pc.binary_length(whole.column("text")).to_numpy(zero_copy_only=False)
            while at < whole.num_rows:  # a bounded number of characters at a time
                stop = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), 1 << 24)))
                batch, at = whole.slice(at, stop - at), stop
                encoder = encoder or ChunkEncoder(spec)
                lists = pc.ascii_split_whitespace(batch.column("text"))
                offsets = np.asarray(lists.offsets, dtype=np.int64)
                coded = lists.flatten().dictionary_encode()
                flat, each = encoder.many(coded.dictionary)
                which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                ids, lengths = gather(flat, each, which)
                bounds = np.r_[0, np.cumsum(lengths)][offsets - offsets[0]]
                n = np.diff(bounds) + 1
                stream = np.insert(ids, bounds[1:], end_id).astype("<u2" if end_id < 1 << 16 and len(encoder.ends) <= 1 << 16 else "<u4")
                width = stream.dtype.itemsize
                ends = np.cumsum(n)
                local = before + ends - n
                before += int(ends[-1]) if len(ends) else 0
                buffers = [None, pa.py_buffer(np.r_[0, ends * width].astype(np.int32).tobytes()), pa.py_buffer(stream.tobytes())]
                data = pa.Array.from_buffers(pa.binary(), len(n), buffers)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.full(len(n), part)), pa.array(local), pa.array(n), pa.array(np.full(len(n), width)), data], names=["id", "part", "local", "n", "width", "ids"])

    return run


def token_table(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """First pass, written once: (id, part, local, n, width, ids)."""
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:  # a vocabulary of fixed size, shipped with the tasks
        spec = f.read()
    schema = "id long, part long, local long, n long, width long, ids binary"
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), text_of(text_col).alias("text"))
    return materialize(rows.mapInArrow(_token_batches(spec, end_id), schema), "packing-tokens")


def _cut(offset_of, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, local, n, width = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("part", "local", "n", "width"))
            parts, totals = offset_of.value
            begin = totals[np.searchsorted(parts, part)] + local
            first, last = begin // size, (begin + n - 1) // size
            pieces = last - first + 1
            doc = np.repeat(np.arange(len(n)), pieces)
            sequence = np.repeat(first, pieces) + np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            lo = np.maximum(begin[doc], sequence * size)
            hi = np.minimum((begin + n)[doc], (sequence + 1) * size)
            start = lo - begin[doc]
            ids = batch.column("ids")
            crc = []
            at, view, wide = -1, None, None
            for d, a, b in zip(doc.tolist(), start.tolist(), (hi - lo).tolist(), strict=True):
                if d != at:
                    at, wide = d, np.frombuffer(ids[d].as_buffer(), dtype=f"<u{width[d]}").astype("<u4")
                    view = memoryview(wide).cast("B")
                crc.append(zlib.crc32(view[4 * a : 4 * (a + b)]))
            out = [batch.column("id").take(pa.array(doc)), pa.array(start), pa.array(hi - lo), pa.array(crc, pa.int64()), pa.array(n[doc]), pa.array(sequence), pa.array(lo - sequence * size), pa.array(sequence > np.repeat(first, pieces)), pa.array(sequence < np.repeat(last, pieces))]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "continued", "continues"])

    return run


def cut_sequences(tokens: DataFrame, size: int = SIZE) -> DataFrame:
    """Second pass: the boundary records of every sequence."""
    totals = tokens.groupBy("part").agg(F.max(F.col("local") + F.col("n")).alias("n")).orderBy("part").toPandas()  # one row per task of the first pass
    n = totals["n"].to_numpy(dtype=np.int64)
    offsets = tokens.sparkSession.sparkContext.broadcast((totals["part"].to_numpy(dtype=np.int64), np.cumsum(n) - n))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, continued boolean, continues boolean"
    return tokens.mapInArrow(_cut(offsets, size), schema)


def pack(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None) -> DataFrame:
    return cut_sequences(token_table(docs, tokenizer), size)
