"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of about ``PASSAGE`` bytes, cut at the end of a word.  Every
passage of the whole text is encoded; gated attention, learned from labels of documents only,
weighs the passages, and the weighted sum of their codes is scored:

    h_k = relu(W x_k + b)                                  code of passage k
    a_k = softmax_k(w . (tanh(V h_k) * sigmoid(U h_k)))     its weight in the document
    score = sigmoid(c . sum_k a_k h_k + d)

``x_k`` describes the passage's bytes: shares of classes of characters, lengths and repetition
of words, and counts of words by ``BUCKETS`` hashed slots.  Numpy computes it for whole blocks
of bytes; no work is done per word in Python.

Training takes at most ``per_class`` labelled texts of each class (smallest hashes of the id;
equal texts once, contradictory labels as 0), and at most ``BAG`` passages of each, spread
evenly over its whole text: so many encoded passages reach the driver.  Classes are weighted
back to their share among all labels, so a score is a probability.  Scoring is row-local.

Labels are learned only from rows with crc32(id as text) mod 5 <> 0.

Defined results: NULL counts as the empty text, which has one empty passage; a NULL id is not
held out and has no label; repeated rows score alike; without labels of both classes every
score is the only class's label, or 1 without any; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetmill.llm.common import gather, quoted, text_of, whole_row

PASSAGE = 512
#: Most bytes by which the end of a passage moves to the end of a word.
REACH = 64
#: Most bytes that are encoded at once.
BLOCK = 1 << 20
BUCKETS = 256
#: Most passages of a document in training.
BAG = 12
HIDDEN = 32
GATES = 16
THRESHOLD = 0.3

#: Classes of bytes: blank, line end, lower, upper, digit, and by use of the sign.
CLASSES = (b" \t\v\f\r", b"\n", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b"!?", b".,;:", b"'\"()[]{}-", b"@/\\_=+~^`")
OTHER, WIDE = len(CLASSES), len(CLASSES) + 1  # control characters; bytes of any other letter
CLASS = np.full(256, OTHER, dtype=np.uint8)
for _c, _signs in enumerate(CLASSES):
    CLASS[list(_signs)] = _c
CLASS[128:] = WIDE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
N_CLASSES = len(CLASSES) + 2
SHAPE = 8  # features beside the shares of classes and the hashed words
FEATURES = N_CLASSES + SHAPE + BUCKETS

#: Powers of an odd base and of its inverse modulo 2^64: hashes of all words from one running sum.
_BASE = 0x9E3779B97F4A7C15
_LONGEST = BLOCK + PASSAGE + REACH


def _powers(base: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.r_[np.uint64(1), np.full(_LONGEST, base, dtype=np.uint64)])


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of every passage and the end of the last, number of passages per text)."""
    lengths = np.diff(offsets)
    counts = np.maximum(1, -(-lengths // PASSAGE))
    first = np.repeat(np.cumsum(counts) - counts, counts)
    place = np.arange(len(first)) - first
    starts = np.repeat(offsets[:-1], counts) + place * PASSAGE
    ends = np.repeat(offsets[1:], counts)
    inner = np.flatnonzero(place > 0)
    for at in range(0, len(inner), 1 << 14):
        some = inner[at : at + (1 << 14)]
        reach = np.minimum(starts[some, None] + np.arange(REACH), ends[some, None] - 1)
        blank = CLASS[data[reach]] <= 1
        starts[some] += np.where(blank.any(axis=1), blank.argmax(axis=1), 0)
    return np.r_[starts, offsets[-1]], counts


def encode(data: np.ndarray, edges: np.ndarray, powers: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Features of the passages data[edges[i] : edges[i + 1]]."""
    n = len(edges) - 1
    out = np.zeros((n, FEATURES), dtype=np.float32)
    data, edges = data[edges[0] : edges[-1]], edges - edges[0]
    sizes = np.diff(edges)
    out[:, N_CLASSES] = np.log1p(sizes) / 8
    if not len(data):
        return out
    kind = CLASS[data]
    owner = np.repeat(np.arange(n), sizes)
    counts = np.bincount(owner * N_CLASSES + kind, minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    out[:, :N_CLASSES] = counts / np.maximum(1, sizes)[:, None]
    inside = kind > 1
    new = np.zeros(len(data), dtype=bool)
    new[edges[:-1][sizes > 0]] = True  # a word that a border cuts counts on either side
    starts = np.flatnonzero(inside & np.r_[True, ~inside[:-1] | new[1:]])
    ends = np.flatnonzero(inside & np.r_[~inside[1:] | new[1:], True]) + 1
    if not len(starts):
        return out
    of = owner[starts]
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * powers[: len(data)])]
        words = (sums[ends] - sums[starts]) * inverse[starts]
        words = (words ^ (words >> np.uint64(31))) * np.uint64(_BASE)
    words ^= words >> np.uint64(29)
    n_words = np.bincount(of, minlength=n)
    some = np.maximum(1, n_words)
    mass = ends - starts
    with np.errstate(over="ignore"):
        mine = np.unique(words + of.astype(np.uint64) * np.uint64(0xD1342543DE82EF95), return_index=True)[1]
    upper, letters = (np.r_[0, np.cumsum(m)] for m in (kind == 3, (kind == 2) | (kind == 3) | (kind == WIDE)))
    capital = (letters[ends] - letters[starts] > 1) & (letters[ends] - letters[starts] == upper[ends] - upper[starts])
    signs = np.r_[0, np.cumsum((kind == 5) | (kind == 6))]
    again = np.r_[False, (words[1:] == words[:-1]) & (of[1:] == of[:-1])]
    share = lambda m: np.bincount(of, m, minlength=n) / some
    shape = (n_words / np.maximum(1, sizes) * 5, np.bincount(of, mass, minlength=n) / some / 10, np.bincount(of[mine], minlength=n) / some, share(again), share(capital), share(signs[ends] > signs[starts]), share(mass > 24))
    out[:, N_CLASSES + 1 : N_CLASSES + SHAPE] = np.stack(shape, axis=1)
    slots = (words >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    out[:, N_CLASSES + SHAPE :] = np.log1p(np.bincount(of * BUCKETS + slots, minlength=n * BUCKETS).reshape(n, BUCKETS)) / 3
    return out


def blocks(edges: np.ndarray) -> Iterator[slice]:
    """Runs of passages of at most BLOCK bytes (or one passage)."""
    at = 0
    while at < len(edges) - 1:
        stop = max(at + 1, int(np.searchsorted(edges, edges[at] + BLOCK, side="right")) - 1)
        yield slice(at, stop)
        at = stop


def text_bytes(column: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow text column without NULLs, and the bounds of each text."""
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)), offsets


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    encode_w: np.ndarray  # FEATURES x HIDDEN
    encode_b: np.ndarray
    gate_v: np.ndarray  # HIDDEN x GATES
    gate_u: np.ndarray
    gate_w: np.ndarray  # GATES
    out_w: np.ndarray  # HIDDEN
    out_b: np.ndarray  # 1

    NAMES = ("encode_w", "encode_b", "gate_v", "gate_u", "gate_w", "out_w", "out_b")

    def codes(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) * self.scale @ self.encode_w + self.encode_b, 0)

    def gates(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t, s = np.tanh(h @ self.gate_v), _sigmoid(h @ self.gate_u)
        return t, s, (t * s) @ self.gate_w

    def score(self, h: np.ndarray, logits: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score of every bag of ``counts`` passages, and the weight of every passage."""
        first = np.cumsum(counts) - counts
        weight = _softmax(logits, first, counts)
        z = np.add.reduceat(weight[:, None] * h, first, axis=0) if len(first) else np.zeros((0, h.shape[1]))
        return _sigmoid(z @ self.out_w + self.out_b[0]), weight


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _softmax(logits: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not len(first):
        return logits
    e = np.exp(logits - np.repeat(np.maximum.reduceat(logits, first), counts))
    return e / np.repeat(np.add.reduceat(e, first), counts)


def gradients(m: Model, x: np.ndarray, counts: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted mean log loss of the bags, and its gradient; ``x`` is standardised already."""
    first = np.cumsum(counts) - counts
    h = np.maximum(x @ m.encode_w + m.encode_b, 0)
    t, s, logits = m.gates(h)
    a = _softmax(logits, first, counts)
    z = np.add.reduceat(a[:, None] * h, first, axis=0)
    p = _sigmoid(z @ m.out_w + m.out_b[0])
    loss = -(w * (y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12))).sum() / w.sum()
    dz = ((p - y) * w / w.sum())[:, None] * m.out_w
    each = np.repeat(dz, counts, axis=0)
    da = (each * h).sum(axis=1)
    dl = a * (da - np.repeat(np.add.reduceat(a * da, first), counts))
    dt, ds = (dl[:, None] * m.gate_w) * s * (1 - t * t), (dl[:, None] * m.gate_w) * t * s * (1 - s)
    dh = (a[:, None] * each + dt @ m.gate_v.T + ds @ m.gate_u.T) * (h > 0)
    grads = {"encode_w": x.T @ dh, "encode_b": dh.sum(axis=0), "gate_v": h.T @ dt, "gate_u": h.T @ ds, "gate_w": (t * s).T @ dl, "out_w": z.T @ ((p - y) * w / w.sum()), "out_b": np.array([((p - y) * w).sum() / w.sum()])}
    return float(loss), grads


def fit(x: np.ndarray, counts: np.ndarray, y: np.ndarray, w: np.ndarray, epochs: int = 16, batch: int = 64, rate: float = 4e-3, decay: float = 1e-3) -> Model:
    """Adam on shuffled batches of bags, from a fixed seed."""
    rng = np.random.default_rng(7)
    x = x.astype(np.float32)
    mean, scale = x.mean(axis=0), 1 / np.maximum(x.std(axis=0), 0.02)
    init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    zero = lambda n: np.zeros(n, dtype=np.float32)
    m = Model(mean, scale, init(FEATURES, HIDDEN), zero(HIDDEN), init(HIDDEN, GATES), init(HIDDEN, GATES), init(GATES), init(HIDDEN), zero(1))
    x = (x - mean) * scale
    first = np.cumsum(counts) - counts
    one, two = ({name: np.zeros_like(getattr(m, name)) for name in Model.NAMES} for _ in range(2))
    step, steps = 0, epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            size = counts[some]
            rows = np.repeat(first[some] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            _, g = gradients(m, x[rows], size, y[some], w[some])
            step += 1
            for name in Model.NAMES:
                grad = g[name] + decay * getattr(m, name) * name.endswith(("_w", "_v", "_u"))
                one[name] = 0.9 * one[name] + 0.1 * grad
                two[name] = 0.999 * two[name] + 0.001 * grad * grad
                move = one[name] / (1 - 0.9**step) / (np.sqrt(two[name] / (1 - 0.999**step)) + 1e-8)
                setattr(m, name, (getattr(m, name) - rate * (1 - step / (steps + 1)) * move).astype(np.float32))
    return m


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: (digest, y, t) -> (digest, y, n, x): at most BAG encoded passages, as float16."""
    powers, inverse = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
    for batch in batches:
        data, offsets = text_bytes(batch.column("t"))
        edges, counts = cut(data, offsets)
        taken = np.minimum(counts, BAG)
        first, ends = np.cumsum(counts) - counts, np.cumsum(taken)
        place = np.arange(taken.sum()) - np.repeat(ends - taken, taken)
        rows = np.repeat(first, taken) + place * np.repeat(counts, taken) // np.repeat(taken, taken)
        flat, sizes = gather(data[edges[0] :], np.diff(edges), rows)
        mine = np.r_[0, np.cumsum(sizes)]
        x = [encode(flat, mine[b.start : b.stop + 1], powers, inverse).astype("<f2") for b in blocks(mine)]
        x = np.concatenate(x) if x else np.zeros((0, FEATURES), dtype="<f2")
        packed = [x[e - n : e].tobytes() for e, n in zip(ends, taken, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("y"), pa.array(taken.astype(np.int32)), pa.array(packed, pa.binary())], names=["digest", "y", "n", "x"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2_500, id_col: str = "doc_id", label_col: str = "quality", text_col: str = "text") -> Model | float:
    """The model; a constant score where labels of both classes aren't there."""
    known = labels.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).cast("int").alias("y")).filter(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.min("y").alias("y"))
    share = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = known.withColumn("h", F.xxhash64("id"))
    some = chosen.filter("y = 1").orderBy("h", "id").limit(per_class).unionByName(chosen.filter("y = 0").orderBy("h", "id").limit(per_class))
    texts = docs.select(F.col(quoted(id_col)).alias("id"), text_of(text_col).alias("t")).join(F.broadcast(some.select(F.col("id").alias("__id"), "y")), F.col("id") == F.col("__id"))  # at most 2 x per_class ids
    once = texts.groupBy(F.sha2("t", 256).alias("digest")).agg(F.min("y").alias("y"), F.first("t").alias("t"))
    sample = once.select("digest", "y", "t").mapInArrow(_encoded, "digest string, y int, n int, x binary").toArrow()  # 2 x per_class rows of BAG passages
    y = sample.column("y").to_numpy().astype(np.float64) if sample.num_rows else np.zeros(0)
    if len(np.unique(y)) < 2:
        return float(y[0]) if len(y) else 1.0
    order = np.argsort(np.array(sample.column("digest").to_pylist()))  # rows come in any order
    sample, y = sample.take(pa.array(order)), y[order]
    counts = sample.column("n").to_numpy().astype(np.int64)
    x = np.concatenate([np.frombuffer(b, dtype="<f2") for b in sample.column("x").to_pylist()]).reshape(-1, FEATURES)
    weights = np.where(y == 1, share[1] / (y == 1).sum(), share[0] / (y == 0).sum())
    return fit(x, counts, y, weights / weights.mean())


def _scored(model, schema_names: list[str]):
    """mapInArrow: (row, t) -> row with the score, the passage of most weight and its weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, powers, inverse = model.value, _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
        for batch in batches:
            data, offsets = text_bytes(batch.column("t"))
            edges, counts = cut(data, offsets)
            h, logits = np.zeros((len(edges) - 1, HIDDEN)), np.zeros(len(edges) - 1)
            for b in blocks(edges):
                h[b] = m.codes(encode(data, edges[b.start : b.stop + 1], powers, inverse).astype(np.float64))
                logits[b] = m.gates(h[b])[2]
            score, weight = m.score(h, logits, counts)
            first = np.cumsum(counts) - counts
            by_weight = np.lexsort((-weight, np.repeat(np.arange(len(counts)), counts)))
            top = by_weight[first] if len(first) else first
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(score), pa.array(counts), pa.array(top - first), pa.array(weight[top])], names=schema_names)

    return run


def score_documents(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", **training) -> DataFrame:
    """(row, score, n_passages, passage, weight): every document (the columns ``keep`` of it) with
    its score, and the place and weight of the passage that counts most."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **training)
    rows = docs.select(whole_row(docs.select(*map(quoted, keep)) if keep else docs).alias("row"), text_of(text_col).alias("t"))
    names = ["row", "score", "n_passages", "passage", "weight"]
    if isinstance(model, float):
        return rows.select("row", F.lit(model).alias("score"), F.lit(None).cast("long").alias("n_passages"), F.lit(None).cast("long").alias("passage"), F.lit(None).cast("double").alias("weight"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # about 10,000 numbers
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_scored(shared, names), f"row {kind}, score double, n_passages long, passage long, weight double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_passages, passage, weight) per document."""
    id_ = F.col("row.doc_id")
    return score_documents(docs, labels, ["doc_id"]).select(id_.alias("doc_id"), held_out(id_).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_passages", "passage", "weight")
