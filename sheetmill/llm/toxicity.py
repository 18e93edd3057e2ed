"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated bigram models, one of toxic and one of ordinary text, share their lowest
level: a word's shared backoff probability follows the number of distinct contexts it occurs
in anywhere in the corpus (Kneser-Ney continuation counts).  A context is a document, so the
counts add up over tasks, and every document counts, labelled or not.  An expression neither
class has really seen costs both models the same but for their freed mass.

    P_c(w)     = (max(n_c(w) - D_c, 0) + freed_c * P_shared(w)) / n_c
    P_c(w | u) = (max(n_c(u w) - D'_c, 0)) / n_c(u) + freed_c(u) * P_c(w)

All counts are numbers of documents (a word repeated in one text is one piece of evidence).
The absolute discounts lie between 0 and 1 and are estimated for each class and order from the
numbers n1 and n2 of words or pairs with a count of one and two, as n1 / (n1 + 2 n2); so every
word and pair that a class has, even once, is evidence for it.

Words go by their 64-bit hash.  The counts of all words of all documents form one table, written
once, that grows with the corpus.  Class counts come from a sample of labelled texts, bounded in
rows (``per_class`` smallest hashes of ids per class) and in words (``max_words`` per class);
every text counts once, however often it or its id repeats.  So what models need of that
table is bounded as well: the words and pairs of the sample, 12 bytes for each pair and class.
Any other word has no class evidence, and its shared probability cancels out.

A document is scored by the length-normalised difference of the two log-likelihoods, over the
whole text and over its most toxic stretches of ``STRETCHES`` words, for the bigram and the
backoff level.  Rare evidence is noisy, so the same features are taken a second time from models
with the discounts ``SUPPORTED``, as features next to those of all evidence, not in their
place.  A logistic curve turns these into a score in 0..1.  The sample is dealt into
``FOLDS`` parts by text; the curve is fitted on features from models that have not seen
the part, the final models use all parts.

Labels are learned only from rows with crc32(id as text) mod 3 <> 1.

Defined results: NULL or wordless text scores like a text without evidence (all features
zero); a NULL id is not held out and has no label; contradictory labels of one id or one text
count as toxic; without labels of both classes every score is 0; repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheetmill.llm.common import let, quoted, text_of, whole_row
from sheetmill.session import materialize

FOLDS = 4
#: Stands for the start of a text where a pair names the word before.
START = 0
#: Most words of the labelled texts of each class: bounds the pairs that models hold.
MAX_WORDS = 2_500_000
#: Most words that numpy handles at once.
BLOCK = 1 << 19
#: Lengths in words of the stretches whose best length-normalised difference is a feature.
STRETCHES = (1, 3, 8)
#: Word and pair discount of the second reading, of well supported evidence only.
SUPPORTED = (2.0, 8.0)
#: Readings (all evidence, well supported evidence) x levels (pair, word) x (text, stretches).
FEATURES = 2 * 2 * (1 + len(STRETCHES))
#: Absolute discounts of word and pair counts where no count of one or no count of two occurs.
DISCOUNT = 0.5
PAIR_DISCOUNT = 0.5
THRESHOLD = 0.7


def word_hashes(text: Column) -> Column:
    """Hash of every word (run of letters and digits, lower-cased)."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return let(words, lambda ws: F.transform(ws, lambda w: F.xxhash64(w)))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def label_sample(docs: DataFrame, labels: DataFrame, per_class: int, id_col: str = "doc_id", label_col: str = "toxic", text_col: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """(y, fold, w): learnable texts with their class, part and word hashes.  One row per text; of
    each class at most ``per_class`` ids (smallest hashes), and texts of together at most
    ``max_words`` words (in the order of their hashes; one text at least)."""
    known = labels.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).alias("y")).filter(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("y").cast("int").alias("y")).withColumn("h", F.xxhash64("id"))
    some = known.filter("y = 1").orderBy("h", "id").limit(per_class).unionByName(known.filter("y = 0").orderBy("h", "id").limit(per_class))
    texts = docs.select(F.col(quoted(id_col)).alias("id"), text_of(text_col).alias("text"))
    mine = texts.join(F.broadcast(some.select(F.col("id").alias("__id"), "y")), F.col("id") == F.col("__id"))  # at most 2 x per_class ids
    once = mine.groupBy(F.xxhash64("text").alias("t")).agg(F.max("y").alias("y"), F.first(word_hashes(F.col("text"))).alias("w"))
    one = materialize(once.select("t", "y", "w", F.size("w").alias("n")), "toxicity-texts")  # at most 2 x per_class rows
    before = F.sum("n").over(Window.partitionBy("y").orderBy("t").rowsBetween(Window.unboundedPreceding, 0))
    within = one.select("t", "y", "n", before.alias("until"), F.row_number().over(Window.partitionBy("y").orderBy("t")).alias("place")).filter((F.col("until") <= max_words) | (F.col("place") == 1))
    kept = one.join(F.broadcast(within.select(F.col("t").alias("__t"))), F.col("t") == F.col("__t"))
    return materialize(kept.select("y", F.pmod("t", F.lit(FOLDS)).cast("int").alias("fold"), "w"), "toxicity-sample")


def neighbours(words: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    """The word before each word; ``start`` at the start of a text."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    ends = np.cumsum(lengths)
    before[(ends - lengths)[lengths > 0]] = start
    return before


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and list lengths of an Arrow list column."""
    offsets = np.asarray(column.offsets, dtype=np.int64)
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64, copy=False), np.diff(offsets)


def _blocks(lengths: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Slices of whole lists (and of their flat values) with about BLOCK values each."""
    ends = np.r_[0, np.cumsum(lengths)]
    at = 0
    while at < len(lengths):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK, side="right")) - 1)
        yield slice(at, stop), slice(int(ends[at]), int(ends[stop]))
        at = stop


COUNTS = "before long, word long, kind int, n long"


def _counted(before: np.ndarray | None, word: np.ndarray, kind: int, n: np.ndarray) -> pa.RecordBatch:
    first = pa.nulls(len(word), pa.int64()) if before is None else pa.array(before)
    return pa.RecordBatch.from_arrays([first, pa.array(word), pa.array(np.full(len(word), kind, dtype=np.int32)), pa.array(n.astype(np.int64))], names=["before", "word", "kind", "n"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that have a word, as kind -1 (``before`` NULL)."""
    for batch in batches:
        flat, sizes = _lists(batch.column("w"))
        for docs, span in _blocks(sizes):
            w, lengths = flat[span], sizes[docs]
            if not len(w):
                continue
            keys, code = np.unique(w, return_inverse=True)
            once = np.unique(np.repeat(np.arange(len(lengths)), lengths) * len(keys) + code)
            yield _counted(None, keys, -1, np.bincount(once % len(keys), minlength=len(keys)))


def _count_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the sample that have a word or a pair, per kind: 2 * fold + class."""
    for batch in batches:
        kinds = batch.column("kind").to_numpy(zero_copy_only=False)
        flat, sizes = _lists(batch.column("w"))
        for docs, span in _blocks(sizes):
            w, lengths, kind = flat[span], sizes[docs], kinds[docs]
            if not len(w):
                continue
            keys, code = np.unique(w, return_inverse=True)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            once = np.unique(owner * len(keys) + code)
            wide = len(keys) + 1
            before = neighbours(code, lengths, len(keys))
            names = np.r_[keys, START]
            for k in np.unique(kind):
                n = np.bincount(once[kind[once // len(keys)] == k] % len(keys), minlength=len(keys))
                yield _counted(None, keys[n > 0], int(k), n[n > 0])
                here = kind[owner] == k
                # one row per text and pair, then texts per pair
                pair, dense = np.unique(before[here] * wide + code[here], return_inverse=True)
                of_doc = np.unique(owner[here] * max(1, len(pair)) + dense) % max(1, len(pair))
                yield _counted(names[pair // wide], keys[pair % wide], int(k), np.bincount(of_doc, minlength=len(pair)))


@dataclass
class Model:
    """Class models over the words of the sample.  Index V stands for any other word, V + 1 for
    the start of a text.  Lists are by reading: all evidence, then well supported evidence."""

    vocabulary: np.ndarray  # sorted hashes of V words
    total: np.ndarray  # 2 x (V + 2): pairs that begin with the word
    word: list[np.ndarray]  # 2 x (V + 1): probability (that of the unknown up to a shared factor)
    weight: list[np.ndarray]  # 2 x (V + 2): share of the mass that backs off
    pairs: list[list[tuple[np.ndarray, np.ndarray]]]  # per class: sorted pair keys, counts less the discount
    curve: tuple[float, ...] = ()  # weight of each feature, then the constant

    def index(self, hashes: np.ndarray) -> np.ndarray:
        return index_in(self.vocabulary, hashes)

    def log_ratios(self, words: np.ndarray, lengths: np.ndarray, reading: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """log P_toxic - log P_ordinary of every word: given the word before, and alone."""
        size, word = len(self.vocabulary), self.word[reading]
        before = neighbours(words, lengths, size + 1)
        key = before * (size + 2) + words
        logs = []
        for c in (0, 1):
            seen = np.zeros(len(words))
            keys, counts = self.pairs[reading][c]
            if len(keys):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                seen = np.where(keys[at] == key, counts[at], 0) / np.maximum(self.total[c, before], 1)
            logs.append(np.log(np.minimum(seen, 1) + self.weight[reading][c, before] * word[c, words]))
        alone = np.log(word[1]) - np.log(word[0])
        return logs[1] - logs[0], alone[words]

    def features(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Mean difference over the text, and over its most toxic stretch of each length."""
        parts = [self._features(self.index(hashes[span]), sizes[docs]) for docs, span in _blocks(sizes)]
        return np.concatenate(parts) if parts else np.zeros((0, FEATURES))

    def _features(self, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.zeros((len(lengths), FEATURES))
        if not len(words):
            return out
        ends = np.cumsum(lengths)
        starts = ends - lengths
        some = lengths > 0
        column = 0
        for ratio in (r for reading in range(len(self.word)) for r in self.log_ratios(words, lengths, reading)):
            sums = np.r_[0.0, np.cumsum(ratio)]
            mean = column
            out[some, mean] = (sums[ends] - sums[starts])[some] / lengths[some]
            for column, n in enumerate(STRETCHES, mean + 1):
                out[:, column] = out[:, mean]
                long = np.flatnonzero(lengths > n)
                if len(long):
                    stretch = np.full(len(sums), -np.inf)
                    stretch[: len(sums) - n] = (sums[n:] - sums[:-n]) / n
                    bounds = np.stack([starts[long], ends[long] - n + 1], axis=1).ravel()
                    out[long, column] = np.maximum.reduceat(stretch, bounds)[::2]
            column += 1
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ np.array(self.curve[:-1]) + self.curve[-1], -40, 40)))


def index_in(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted vocabulary; its size for any other."""
    if not len(vocabulary):
        return np.zeros(len(hashes), dtype=np.int64)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, len(vocabulary))


def discount(counts: np.ndarray, default: float) -> float:
    """Absolute discount of these counts, from how many of them are one and two."""
    n1, n2 = int((counts == 1).sum()), int((counts == 2).sum())
    return n1 / (n1 + 2 * n2) if n1 and n2 else default


@dataclass
class Counts:
    """The count tables of the sample; the last axis of length FOLDS is the part."""

    vocabulary: np.ndarray
    shared: np.ndarray  # V: share of all (document, word) occurrences
    words: np.ndarray  # V x 2 x FOLDS
    kinds: list[tuple[np.ndarray, np.ndarray]]  # per kind (2 * fold + class): pair keys, counts

    def _first(self, kind: int) -> np.ndarray:
        keys, n = self.kinds[kind]
        return np.bincount(keys // self.width, n, self.width).astype(np.int64)

    @property
    def width(self) -> int:
        return len(self.vocabulary) + 2

    @property
    def keys(self) -> np.ndarray:
        """P: every pair, as vocabulary index of its first word x (V + 2) + that of its second."""
        return np.unique(np.concatenate([keys for keys, _ in self.kinds]))

    @property
    def before(self) -> np.ndarray:
        return self.keys // self.width

    @property
    def after(self) -> np.ndarray:
        return self.keys % self.width

    @property
    def pairs(self) -> np.ndarray:
        """P x 2 x FOLDS."""
        every = self.keys
        out = np.zeros((len(every), 2, FOLDS), dtype=np.int64)
        for kind, (keys, n) in enumerate(self.kinds):
            out[np.searchsorted(every, keys), kind % 2, kind // 2] = n
        return out

    @property
    def totals(self) -> np.ndarray:
        """(V + 2) x 2 x FOLDS: pairs beginning with the word."""
        return np.stack([self._first(kind) for kind in range(2 * FOLDS)], axis=-1).reshape(-1, FOLDS, 2).swapaxes(1, 2)

    def class_pairs(self, c: int, use: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of the pairs that a class has in the parts ``use``, and their counts."""
        keys = np.concatenate([self.kinds[2 * f + c][0] for f in use])
        n = np.concatenate([self.kinds[2 * f + c][1] for f in use])
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        return keys[starts], np.add.reduceat(n, starts) if len(starts) else n

    def model(self, without: int | None = None) -> Model | None:
        """The two models from all parts, or all but one; None when a class has no word."""
        use = [f for f in range(FOLDS) if f != without]
        count = self.words[..., use].sum(axis=-1).T
        n = count.sum(axis=1)
        if (n == 0).any():
            return None
        size = len(self.vocabulary)
        total = np.zeros((2, size + 2), dtype=np.float32)
        word = [np.ones((2, size + 1), dtype=np.float32) for _ in range(2)]
        weight = [np.ones((2, size + 2), dtype=np.float32) for _ in range(2)]
        floor = np.finfo(np.float32).tiny
        pairs: list[list] = [[], []]
        for c in (0, 1):
            keys, seen = self.class_pairs(c, use)
            total[c] = np.bincount(keys // self.width, seen, size + 2)
            for reading, (d, e) in enumerate(((discount(count[c], DISCOUNT), discount(seen, PAIR_DISCOUNT)), SUPPORTED)):
                freed = np.minimum(count[c], d).sum()
                word[reading][c] = freed / n[c]
                word[reading][c, :size] = (np.maximum(count[c] - d, 0) + freed * self.shared) / n[c]
                word[reading][c] = np.maximum(word[reading][c], floor)
                some = seen > e  # all of them unless a reading of supported evidence
                left = (seen[some] - e).astype(np.float32)
                weight[reading][c] = np.clip(1 - np.bincount(keys[some] // self.width, left, size + 2) / np.maximum(total[c], 1), 1e-4, 1.0)
                pairs[reading].append((keys[some], left))
        return Model(self.vocabulary, total, word, weight, pairs)


def count_corpus(docs: DataFrame, sample: DataFrame, text_col: str = "text") -> Counts:
    """Count every document once; the table of all words grows with the corpus, what reaches
    the driver is bounded by the sample."""
    every_text = docs.select(word_hashes(text_of(text_col)).alias("w")).mapInArrow(_count_words, COUNTS)
    evidence = sample.select((2 * F.col("fold") + F.col("y")).cast("int").alias("kind"), "w").mapInArrow(_count_sample, COUNTS)
    found = every_text.unionByName(evidence)
    kinds = range(2 * FOLDS)
    names = [f"n{k}" for k in kinds]
    of = lambda k: F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0))
    counted = materialize(found.groupBy("before", "word").agg(of(-1).alias("docs"), *[of(k).cast("int").alias(f"n{k}") for k in kinds]), "toxicity-counts")
    words, pairs = counted.filter("before is null"), counted.filter("before is not null")

    vocabulary = words.filter(F.greatest(*names) > 0).toArrow()
    hashes = vocabulary.column("word").to_numpy()
    order = np.argsort(hashes)
    hashes, size = hashes[order], len(hashes)
    every = words.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    mine = np.stack([vocabulary.column(n).to_numpy()[order] for n in names], axis=-1).reshape(-1, FOLDS, 2).swapaxes(1, 2)
    shared = vocabulary.column("docs").to_numpy()[order] / max(1, every)
    del vocabulary

    place = docs.sparkSession.sparkContext.broadcast(hashes)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per pair and kind that has it: key, and count * kinds + kind."""
        for batch in batches:
            before, word = (batch.column(n).to_numpy() for n in ("before", "word"))
            key = np.where(before == START, size + 1, index_in(place.value, before)) * (size + 2) + index_in(place.value, word)
            n = np.stack([batch.column(name).to_numpy() for name in names])
            kind, row = np.nonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(key[row]), pa.array((n[kind, row].astype(np.int64) * len(names) + kind).astype(np.int32))], names=["key", "n"])

    found = pairs.select("before", "word", *names).mapInArrow(packed, "key long, n int").toArrow()  # bounded by the sample: 12 bytes a row
    place.destroy()
    key, n = found.column("key").to_numpy(), found.column("n").to_numpy()
    del found
    return Counts(hashes, shared, mine, [(key[here], n[here] // len(names)) for here in (n % len(names) == k for k in kinds)])


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, ...]:
    """Logistic regression by Newton steps, halved until they improve it, on standardised features; ridge 1 / (2 n)."""
    mean, sd = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / sd, np.ones(len(x))]
    penalty = 0.5 / len(y) * np.r_[np.ones(x.shape[1]), 1e-6]
    loss = lambda b: (np.logaddexp(0, z @ b) - y * (z @ b)).mean() + (penalty * b * b).sum() / 2
    beta = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -40, 40)))
        grad = z.T @ (p - y) / len(y) + penalty * beta
        hess = (z * (p * (1 - p) + 1e-12)[:, None]).T @ z / len(y) + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        now = loss(beta)
        while loss(beta - step) > now - 1e-4 * (grad @ step) and np.abs(step).max() > 1e-7:
            step = step / 2
        beta -= step
        if np.abs(step).max() < 1e-7:
            break
    weights = beta[:-1] / sd
    return (*map(float, weights), float(beta[-1] - weights @ mean))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 20_000, id_col: str = "doc_id", text_col: str = "text", max_words: int = MAX_WORDS) -> Model | None:
    sample = label_sample(docs, labels, per_class, id_col, text_col=text_col, max_words=max_words)
    counts = count_corpus(docs, sample, text_col)
    if (counts.words.sum(axis=(0, 2)) == 0).any():
        return None
    names = [f"f{j}" for j in range(FEATURES)]
    parts = []
    for fold in range(FOLDS):  # one at a time: a model holds all pairs of the sample
        part = counts.model(without=fold)
        if part is None:
            continue
        shared = docs.sparkSession.sparkContext.broadcast(vars(part))
        del part

        def features(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                f = Model(**shared.value).features(*_lists(batch.column("w")))
                yield pa.RecordBatch.from_arrays([batch.column("y"), *[pa.array(c) for c in f.T]], names=["y", *names])

        mine = sample.filter(F.col("fold") == fold).select("y", "w")
        parts.append(mine.mapInArrow(features, "y int, " + ", ".join(f"{n} double" for n in names)).toArrow())
        shared.destroy()
    model = counts.model()
    seen = pa.concat_tables(parts) if parts else None
    y = seen.column("y").to_numpy() if seen else np.zeros(0)
    if len(np.unique(y)) == 2:
        model.curve = fit_curve(np.stack([seen.column(n).to_numpy() for n in names], axis=1), y)
    else:
        model.curve = (*[0.5] * FEATURES, -8.0)
    return model


def score_column(docs: DataFrame, model: Model | None, text_col: str = "text") -> Column:
    """Score of each document as a column: words are hashed by Spark, Arrow batches scored by
    numpy against the broadcast tables (bounded by the sample)."""
    if model is None:
        return F.lit(0.0)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def score(w: pd.Series) -> pd.Series:
        lengths = np.array([len(x) for x in w], dtype=np.int64)
        hashes = np.concatenate(w.to_list()).astype(np.int64, copy=False) if lengths.sum() else np.zeros(0, dtype=np.int64)
        tables = Model(**shared.value)
        return pd.Series(tables.scores(tables.features(hashes, lengths)))

    return F.pandas_udf(score, "double")(word_hashes(text_of(text_col)))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    scored = docs.select(F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), score_column(docs, model).alias("score"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    model = train(docs, labels, text_col=text_col)
    return docs.select(whole_row(docs).alias("row"), score_column(docs, model, text_col).alias("score")).filter(F.col("score") < THRESHOLD).select("row.*")
