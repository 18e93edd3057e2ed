"""Vector codes, hard negatives and the passage classifier against brute force."""

from __future__ import annotations

import collections
import hashlib
import zlib

import numpy as np
import pytest

from sheetmill.llm import codes, negatives, passages

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v int, key int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


def integers(row):
    return [int(np.floor(256 * np.float64(np.float32(x)))) for x in row]


def usable(e):
    return e is not None and all(x is not None and np.isfinite(x) for x in e)


def some_rows(n=400, dim=32, seed=5, hot=True):
    """Rows with ties, copies of one vector, repeated rows, and rows that take no part."""
    rng = np.random.default_rng(seed)
    base = np.round(rng.standard_normal((n, dim)) * 6) / 64
    rows = [(i, base[i].tolist(), int(rng.integers(0, 4))) for i in range(n)]
    if hot:
        rows += [(n + i, base[50].tolist(), i % 4) for i in range(n // 2)]
    rows += [rows[7], rows[7], rows[50], (200, base[3].tolist(), 1)]
    rows += [(9001, None, 1), (9002, [float("nan"), *base[0][1:].tolist()], 1), (9003, [None, *base[0][1:].tolist()], 2), (9004, [float("inf"), *base[0][1:].tolist()], 0), (9005, base[9].tolist(), None), (None, base[11].tolist(), 3)]
    return rows


# -- vector codes ---------------------------------------------------------------------------------


def lloyd(rows, parts, entries, rounds):
    kept = [(i, integers(e), label) for i, e, label in rows if usable(e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * d : (p + 1) * d]
    books = [[cut(r[1], p) for r in kept[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))
    for step in range(rounds + 1):
        assigned = [[near(cut(r[1], p), books[p]) for p in range(parts)] for r in kept]
        for p in range(parts if step < rounds else 0):
            for j in range(len(books[p])):
                mine = [cut(r[1], p) for r, a in zip(kept, assigned, strict=True) if a[p][1] == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    errors = [sum(dist for dist, _ in a) for a in assigned]
    by_label = collections.Counter()
    for r, e in zip(kept, errors, strict=True):
        by_label[r[2]] += e
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{j:02x}" for _, j in a), e, by_label[r[2]], digest) for r, a, e in zip(kept, assigned, errors, strict=True)), key=repr)


@pytest.mark.parametrize("n", [400, 20])
def test_codes_equal_lloyd(spark, n):
    rows = some_rows(n, hot=n > 100) if n > 100 else [r for r in some_rows(60, hot=False)[:20]]
    got = codes.compression_report(vectors(spark, rows)).collect()
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got), key=repr) == lloyd(rows, 16, 64, 2)


def test_codes_edge_tables(spark):
    assert codes.compression_report(vectors(spark, [])).count() == 0
    assert codes.compression_report(vectors(spark, [(1, None, 2)])).count() == 0
    short = codes.compression_report(vectors(spark, [(1, [0.5, 0.25], None), (2, [], None), (3, [1.0], 1)])).collect()  # padded to 16 parts of one
    assert {r["vec_id"]: r["error"] for r in short} == {1: 0, 2: 0, 3: 0}
    with pytest.raises(ValueError):
        codes.compress(vectors(spark, [(1, [1e20] * 16, 1)]))


def test_reassign_is_a_full_scan():
    rng = np.random.default_rng(0)
    spared = 0
    for _ in range(200):
        x, book = rng.integers(-4, 5, (50, 2)).astype(float), rng.integers(-4, 5, (9, 2)).astype(float)
        code, dist = codes.nearest(x, book)
        moved = rng.random(9) < 0.3
        book[moved] = rng.integers(-4, 5, (int(moved.sum()), 2))
        c, d, compared = codes.reassign(x, book, code, dist, moved)
        full = codes.nearest(x, book)
        assert (c == full[0]).all() and (d == full[1]).all()
        spared += x.shape[0] * len(book) - compared
    assert spared > 0.3 * 200 * 50 * 9


# -- hard negatives -------------------------------------------------------------------------------


def brute_negatives(rows, every=50, m=negatives.Mining()):
    kept = [(k, i, integers(e), label) for k, (i, e, label) in enumerate(rows) if usable(e) and i is not None and label is not None]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    out = []
    for k, i, v, label in kept:
        if i % every:
            continue
        ranked = sorted((-dot(v, w), j, k2, other) for k2, j, w, other in kept if k2 != k)
        for s, j, _, _ in [r for r in ranked if r[3] == label][: m.positives]:
            fits = [(n, -t) for t, n, _, other in ranked if other != label and m.low * -s <= -100 * t <= m.high * -s]
            out += [(i, j, rank, n, -s, t) for rank, (n, t) in enumerate(fits[: m.per_positive], 1)]
    return sorted(out)


def mined(df, **kw):
    return sorted(tuple(r) for r in negatives.mine_hard_negatives(df, **kw).collect())


def test_negatives_are_exact(spark):
    rows = some_rows(400)
    assert mined(vectors(spark, rows)) == brute_negatives(rows)


def test_negatives_over_many_clusters_blocks_spans(spark, monkeypatch):
    for name, value in (("MEMBERS", 4), ("BLOCK", 7), ("SEGMENT", 16), ("SPAN", 64)):
        monkeypatch.setattr(negatives, name, value)
    rows = some_rows(300, dim=6, seed=8)
    m = negatives.Mining(positives=2, per_positive=4, low=30, high=90)
    assert mined(vectors(spark, rows), every=5, mining=m) == brute_negatives(rows, 5, m)


def test_negatives_edge_tables(spark):
    assert mined(vectors(spark, [])) == []
    assert mined(vectors(spark, [(0, [1.0, 0.0], 1)])) == []
    assert mined(vectors(spark, [(0, [0.0, 0.0], 1), (1, [0.0, 0.0], 1), (2, [0.0], 2), (3, [], 0)])) == [(0, 1, 1, 2, 0, 0), (0, 1, 2, 3, 0, 0)]
    below = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.6, 0.0], 2)]  # no window below a negative score
    assert mined(vectors(spark, below)) == []


def test_walks_stop_early():
    """On vectors in narrow cones a certified walk needs a small part of all products."""
    rng = np.random.default_rng(3)
    cones = np.repeat(np.eye(8) * 256, 400, axis=0) + rng.standard_normal((3200, 8)) * 8
    v = np.floor(cones * np.linspace(0.3, 1, 3200)[rng.permutation(3200), None])
    key, label = np.arange(3200), rng.integers(0, 3, 3200)
    centers = negatives.centroids(v[:400], 8)
    norm, angle = negatives.angles(v, centers)
    mine = angle.argmin(axis=1)
    members = np.flatnonzero(mine == mine[0])[:40]
    bound = negatives.bounds(norm, angle, np.array([angle[mine == c, c].max(initial=0) for c in range(len(centers))]))[:, mine[0]]
    order = np.argsort(-bound, kind="stable")
    span = (negatives.Span(bound[o], key[o], key[o], label[o], v[o]) for o in np.split(order, 100))
    best, products = negatives.walk_positives(span, key[members], label[members], norm[members], v[members], np.full(40, negatives.NONE), 5)
    assert products < 0.25 * 40 * 3200
    exact = np.where((label[members, None] == label) & (key[members, None] != key), v[members] @ v.T, -np.inf)
    assert (np.sort(best.score.reshape(40, 5), axis=1) == np.sort(np.partition(exact, -5, axis=1)[:, -5:], axis=1)).all()


# -- passages -------------------------------------------------------------------------------------


def test_passages_cover_the_text():
    texts = ["", "one", "word " * 2000, "x" * 3000, "ä" * 700 + " b", "a\n" * 600]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), dtype=np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])]
    edges, counts = passages.cut(data, offsets)
    assert counts.tolist() == [max(1, -(-len(r) // passages.PASSAGE)) for r in raw]
    first = np.cumsum(counts) - counts
    assert (edges[first] == offsets[:-1]).all() and (np.diff(edges) >= 0).all() and edges[-1] == offsets[-1]
    inner = np.setdiff1d(np.arange(len(edges) - 1), first)
    cut_words = [e for e in edges[inner] if data[e] not in b" \n" and data[e - 1] not in b" \n"]
    assert all(offsets[3] <= e < offsets[5] for e in cut_words)  # only in runs without a blank


def test_encoding_does_not_depend_on_blocks():
    text = ("Some words, SOME WORDS!! some more ### 12 words.\n" * 200).encode()
    data = np.frombuffer(text, dtype=np.uint8)
    powers, inverse = passages._powers(passages._BASE), passages._powers(pow(passages._BASE, -1, 1 << 64))
    edges, _ = passages.cut(data, np.array([0, len(data)]))
    whole = passages.encode(data, edges, powers, inverse)
    each = np.concatenate([passages.encode(data, edges[i : i + 2], powers, inverse) for i in range(len(edges) - 1)])
    assert np.allclose(whole, each, atol=1e-7)
    counts = collections.Counter(text[edges[1] : edges[2]].lower().split())
    assert np.isclose(whole[1, passages.N_CLASSES + 3], len(counts) / sum(counts.values()))
    slots = np.round(np.expm1(whole[1, passages.N_CLASSES + passages.SHAPE :].astype(float) * 3)).astype(int)
    assert slots.sum() == sum(counts.values())


def test_gradients_by_differences():
    rng = np.random.default_rng(1)
    n = lambda *shape: rng.standard_normal(shape) * 0.5
    m = passages.Model(np.zeros(5), np.ones(5), n(5, 4), n(4), n(4, 3), n(4, 3), n(3), n(4), n(1))
    x, counts, y, w = n(9, 5), np.array([1, 5, 3]), np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    _, grads = passages.gradients(m, x, counts, y, w)
    for name in passages.Model.NAMES:
        p = getattr(m, name)
        for at in np.ndindex(p.shape):
            old = p[at]
            losses = []
            for step in (1e-6, -1e-6):
                p[at] = old + step
                losses.append(passages.gradients(m, x, counts, y, w)[0])
            p[at] = old
            assert abs((losses[0] - losses[1]) / 2e-6 - grads[name][at]) < 1e-6
    h = m.codes(x)
    score, weight = m.score(h, m.gates(h)[2], counts)
    z = [sum(a * b for a, b in zip(weight[s], h[s], strict=True)) for s in (slice(0, 1), slice(1, 6), slice(6, 9))]
    assert np.allclose(score, [1 / (1 + np.exp(-(q @ m.out_w + m.out_b[0]))) for q in z])
    assert np.allclose(np.add.reduceat(weight, [0, 1, 6]), 1)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(2)
    vocabulary = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(300)]
    good = lambda n: " ".join(rng.choice(vocabulary, n)) + "."
    bad = lambda n: rng.choice([lambda: " ".join([str(rng.choice(vocabulary))] * n), lambda: " ".join(w.upper() + "!!" for w in rng.choice(vocabulary, n)), lambda: "### ".join(rng.choice(vocabulary, n))])()
    rows = [(i, good(int(rng.integers(20, 400))) if i % 3 else good(40) + "\n" + bad(120) + "\n" + good(200), int(i % 3 > 0)) for i in range(900)]
    docs = spark.createDataFrame([(i, t, "en", 0.5) for i, t, _ in rows], "doc_id long, text string, y string, score double").repartition(4).cache()
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int").cache(), {i: y for i, _, y in rows}


def test_classifier_learns_from_document_labels(spark, labelled):
    docs, labels, truth = labelled
    got = {r["doc_id"]: r for r in passages.quality_scores(docs, labels).collect()}
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(got) == len(truth) and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert np.mean([got[i]["predicted"] == truth[i] for i in out]) > 0.97
    assert all((r["score"] >= 0.3) == (r["predicted"] == 1) for r in got.values())
    # attention: the passage of most weight of a bad document is one that touches its bad stretch
    bad = [r for i, r in got.items() if not truth[i]]
    assert np.mean([r["passage"] < r["n_passages"] - 2 for r in bad if r["n_passages"] > 3]) > 0.9
    other = passages.quality_scores(docs, labels.filter("crc32(cast(doc_id as string)) % 5 <> 0"))
    assert {r["doc_id"]: r["score"] for r in other.collect()} == {i: r["score"] for i, r in got.items()}  # held-out labels change nothing


def test_classifier_edge_rows(spark, labelled):
    docs, labels, _ = labelled
    long_text = "plain words of a text " * 20000
    odd = spark.createDataFrame([(5001, None, "a", 1.0), (5002, "", "a", 1.0), (None, "a few words", "a", 1.0), (5003, long_text, "a", 1.0), (5003, long_text, "a", 1.0), (5004, " \n\t", None, None)], docs.schema)
    got = passages.quality_scores(docs.unionByName(odd), labels).filter("doc_id is null or doc_id > 5000").collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 and 0 <= r["weight"] <= 1 for r in got)
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r["score"])
    assert by_id[5001] == by_id[5002] and len(set(by_id[5003])) == 1
    assert next(r for r in got if r["doc_id"] is None)["held_out"] is False
    empty = docs.limit(0)
    assert passages.quality_scores(empty, labels).count() == 0
    assert {r["score"] for r in passages.quality_scores(docs, labels.limit(0)).collect()} == {1.0}
    assert {r["score"] for r in passages.quality_scores(docs, labels.filter("quality = 0")).collect()} == {0.0}
    whole = passages.score_documents(odd, labels)
    assert whole.select("row.*").columns == odd.columns and whole.count() == 6
