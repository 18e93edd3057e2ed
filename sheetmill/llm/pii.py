"""Personal data by exact patterns plus a semi-Markov conditional random field.

Base findings (``email``, ``ip``, ``card``, ``phone``) come from fixed patterns with their
checks and always stay.  A semi-Markov CRF adds findings the patterns miss: numbers without
the usual prefix, spelled-out addresses and the like.

* A text is cut into regions around digits, "@" and spelled-out at signs; the rest of it can
  only be "outside".  A region's tokens are runs of letters, digits, blanks, or single others.
* A segment is up to ``MAX_TOKENS`` words and ``MAX_CHARS`` characters of one type.  Its features look at the whole span:
  counts of digits, letters, dots, blanks, checksums, octets, ends, and the words and
  characters next to it.
* Viterbi over (position, segment length, type) chooses boundaries and types together; the
  bound on the length keeps it linear in the region.
* Weights maximise the likelihood of segmentations (forward-backward over segments, AdaGrad).
  They are trained on a bounded sample (``PER_KIND`` regions of every kind and as many without
  a finding, smallest hashes) whose base findings are the labels, and on rewritten copies of
  these (another separator, no prefix, "(at)") with failing look-alikes as negatives.
* Base findings are fixed segments of every segmentation: the path chooses among the segments
  that touch none of them, so what is found beside a base finding is the best there is.

All of it is row-local: documents are never shuffled.  Offsets are code points.

Defined results: NULL text counts as empty; NULL ids and repeated rows are scanned like any
other; without any labelled region the CRF adds nothing; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheetmill.llm.common import quoted, text_of

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 16
MAX_CHARS = 80
#: Regions trained on: of each kind, and without any finding.
PER_KIND = 40
#: Longest region trained on; of a longer one, the surroundings of each finding are.
LONGEST = 240
EPOCHS = 6
#: Characters to either side of a digit, and of the regions trained on.
MARGIN = 24
TRIGGER = r"(?i)[0-9@]|[\[({]\s?at\s?[\])}]|\bat\s[a-z0-9-]{1,63}\sdot\s"

_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.S)
_TRIGGER = re.compile(TRIGGER)
_SPELLED = re.compile(r"(?i)\s?[\[({]\s?(at|dot)\s?[\])}]\s?")
_BARE = re.compile(r"(?i)(?<=\w)\s(at|dot)\s(?=\w)")

Span = tuple[int, int, int]  # start, kind, stop


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def octets(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its check, sorted."""
    out: list[Span] = []
    end = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start() and m.start() >= end:
            end = m.end()
            out.append((start, 0, end))
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if octets(m[0])]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


# -- regions and features ------------------------------------------------------------------------


def _same_token(a: str, b: str) -> bool:
    return len(_TOKEN.findall(a + b)) == 1


def regions(text: str, reach: int = MAX_CHARS) -> Iterator[tuple[int, int]]:
    """Stretches around the triggers, merged: MARGIN characters to either side of a digit, and
    ``reach`` to either side of an at sign, where they end between tokens (a token cut by the
    bound is in no segment with the at sign)."""
    spans: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        digit = m[0].isdigit()
        a, b = (m.start() - MARGIN, m.end() + MARGIN) if digit else (m.start() - reach, m.end() + reach)
        a, b = max(0, a), min(len(text), b)
        if not digit and reach > MARGIN:
            while 0 < a < m.start() and _same_token(text[a - 1], text[a]):
                a += 1
            while m.end() < b < len(text) and _same_token(text[b - 1], text[b]):
                b -= 1
        while spans and a <= spans[-1][1]:
            last = spans.pop()
            a, b = min(a, last[0]), max(b, last[1])
        spans.append([a, b])
    yield from ((a, b) for a, b in spans)


def plain(span: str) -> str:
    """The span with spelled-out at signs and dots as characters."""
    mark = lambda m: "@" if m[1].lower() == "at" else "."
    out = _SPELLED.sub(mark, span)
    low = out.lower()
    return _BARE.sub(mark, out) if " at " in low and " dot " in low else out


_CUES = ("tel", "phone", "call", "fax", "mobile", "cell", "mail", "email", "contact", "card", "visa", "credit", "ip", "host", "server", "address", "at", "order", "page", "year", "version")
_CUE = {w: f"cue={w}" for w in _CUES}


def _bucket(n: int, *edges: int) -> int:
    return sum(n >= e for e in edges)


def span_features(span: str, left: str, right: str, cue: str) -> list[str]:
    """Names of the binary features of a whole candidate span."""
    spelled, span = span, plain(span)
    digits = "".join(c for c in span if "0" <= c <= "9")
    letters = sum(c.isalpha() for c in span)
    n = len(digits)
    at = span.count("@")
    dots, blanks, hyphens = span.count("."), sum(c.isspace() for c in span), span.count("-")
    others = len(span) - n - letters - dots - blanks - hyphens
    out = [
        f"digits={_bucket(n, 1, 4, 7, 9, 10, 11, 12, 16, 17, 20)}",
        f"letters={_bucket(letters, 1, 3, 8)}",
        f"at={min(at, 2)}",
        f"dots={min(dots, 4)}",
        f"blanks={min(blanks, 4)}",
        f"hyphens={min(hyphens, 4)}",
        f"others={min(others, 4)}",
        f"spelled={spelled != span}",
        f"first={'d' if span[0].isdigit() else 'a' if span[0].isalpha() else span[0] if span[0] in '+(' else 'o'}",
        f"last={'d' if span[-1].isdigit() else 'a' if span[-1].isalpha() else 'o'}",
        f"left={'-' if not left else 'w' if left.isspace() else 'x' if left.isalnum() or left in '.@+-' else 'p'}",
        f"right={'-' if not right else 'w' if right.isspace() else 'x' if right.isalnum() or right in '@-' else 'p'}",
        f"at={min(at, 1)},letters={min(letters, 1)},digits={_bucket(n, 1, 7)}",
        f"digits={_bucket(n, 7, 9, 10, 11, 12, 16, 17, 20)},letters={min(letters, 1)},dots={min(dots, 4)}",
        _CUE.get(cue, "cue"),
    ]
    if 12 <= n <= 19:
        out.append(f"luhn={luhn(digits)},letters={min(letters, 1)},blanks={min(blanks, 4)}")
    if dots >= 3:
        out.append(f"octets={octets(span)}")
    if at:
        tail = span.rsplit("@", 1)[-1]
        out.append(f"domain={bool(re.search(r'[A-Za-z0-9-][.][A-Za-z]{2,}$', tail))},blanks={min(blanks, 2)}")
    return out


def segments(tokens: list[str], before: str, after: str, fixed: list[bool] | None = None) -> list[tuple[int, int, list[str]]]:
    """Candidate segments (first token, token after the last, features) without ``fixed`` tokens."""
    n = len(tokens)
    out = []
    words = [t.lower() if t[0].isalpha() else "" for t in tokens]
    for i in range(n):
        if tokens[i].isspace() or not (tokens[i][0].isalnum() or tokens[i] in "+(") or (fixed and fixed[i]):
            continue
        cue = next((w for w in reversed(words[max(0, i - 4) : i]) if w), "")
        span, some, count, at = "", False, 0, False
        for j in range(i, n):
            token = tokens[j]
            span += token
            count += token[0].isalnum()
            if len(span) > MAX_CHARS or count > MAX_TOKENS or "\n" in token or (fixed and fixed[j]):
                break
            at = at or words[j] == "at"
            some = some or token[0].isdigit() or token == "@" or (words[j] == "at" and j > i and ("".join(tokens[max(i, j - 2) : j]).rstrip()[-1:] or " ") in "([{") or (at and words[j] == "dot")
            if some and token[0].isalnum():
                out.append((i, j + 1, span_features(span, tokens[i - 1][-1] if i else before, tokens[j + 1][0] if j + 1 < n else after, cue)))
    return out


# -- model ---------------------------------------------------------------------------------------


def indexed(candidates: list[tuple[int, int, list[str]]], names: dict[str, int], grow: bool = False) -> list[tuple[int, int, np.ndarray]]:
    out = []
    for i, j, feats in candidates:
        if grow:
            for f in feats:
                names.setdefault(f, len(names))
        out.append((i, j, np.array([names[f] for f in feats if f in names], dtype=np.int64)))
    return out


def _logsum(values: list[float]) -> float:
    top = max(values)
    return top + float(np.log(sum(np.exp(v - top) for v in values))) if top > -np.inf else top


def likelihood_gradient(n: int, cands: list[tuple[int, int, np.ndarray]], gold: set[tuple[int, int, int]], w: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(feature indices, per-type gradient) of each candidate: observed minus expected."""
    scores = np.array([w[:, f].sum(axis=1) for _, _, f in cands]).reshape(len(cands), len(KINDS))
    total = np.logaddexp.reduce(scores, axis=1) if len(cands) else np.zeros(0)
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    starting: list[list[int]] = [[] for _ in range(n + 1)]
    for c, (i, j, _) in enumerate(cands):
        ending[j].append(c)
        starting[i].append(c)
    alpha, beta = np.zeros(n + 1), np.zeros(n + 1)
    for j in range(1, n + 1):
        alpha[j] = _logsum([alpha[j - 1], *(alpha[cands[c][0]] + total[c] for c in ending[j])])
    for i in range(n - 1, -1, -1):
        beta[i] = _logsum([beta[i + 1], *(beta[cands[c][1]] + total[c] for c in starting[i])])
    out = []
    for c, (i, j, f) in enumerate(cands):
        expected = np.exp(np.minimum(alpha[i] + scores[c] + beta[j] - alpha[n], 0))
        observed = np.array([float((i, j, k) in gold) for k in range(len(KINDS))])
        out.append((f, observed - expected))
    return out


def train(examples: list[tuple[str, list[Span]]]) -> tuple[dict[str, int], np.ndarray]:
    """Feature names and weights (types x features) from regions with their spans."""
    names: dict[str, int] = {}
    data = []
    for text, spans in examples:
        tokens = _TOKEN.findall(text)
        edges = np.r_[0, np.cumsum([len(t) for t in tokens])].tolist()
        place = {e: i for i, e in enumerate(edges)}
        gold = {(place[a], place[b], k) for a, k, b in spans if a in place and b in place}
        data.append((len(tokens), indexed(segments(tokens, "", ""), names, grow=True), gold))
    w = np.zeros((len(KINDS), len(names)))
    square = np.full_like(w, 1e-6)
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for d in order.permutation(len(data)):
            n, cands, gold = data[d]
            gradient = np.zeros_like(w)
            for f, g in likelihood_gradient(n, cands, gold, w):
                gradient[:, f] += g[:, None]
            gradient -= 1e-4 * w
            square += gradient**2
            w += 0.3 * gradient / np.sqrt(square)
    return names, w


def decode(text: str, names: dict[str, int], w: np.ndarray, before: str = "", after: str = "", base: list[tuple[int, int]] | None = None) -> list[Span]:
    """Best segmentation of a region (Viterbi) in which the stretches ``base`` (disjoint, sorted)
    are fixed; the spans chosen beside them, relative to the region."""
    tokens = _TOKEN.findall(text)
    n = len(tokens)
    edges = np.r_[0, np.cumsum([len(t) for t in tokens])].tolist()
    fixed = None
    if base:  # a fixed stretch adds the same score to every path: its tokens are in no other segment
        fixed = [False] * n
        for a, b in base:
            for t in range(bisect_right(edges, a) - 1, min(n, bisect_left(edges, b))):
                fixed[t] = True
    best = [0.0] * (n + 1)
    back: list[tuple[int, int]] = [(-1, -1)] * (n + 1)
    ending: list[list[tuple[int, float, int]]] = [[] for _ in range(n + 1)]
    for i, j, f in indexed(segments(tokens, before, after, fixed), names):
        scores = w[:, f].sum(axis=1)
        k = int(scores.argmax())
        if scores[k] > 0:  # a segment below "outside" is never on the best path
            ending[j].append((i, float(scores[k]), k))
    for j in range(1, n + 1):
        best[j], back[j] = best[j - 1], (j - 1, -1)
        for i, s, k in ending[j]:
            if best[i] + s > best[j]:
                best[j], back[j] = best[i] + s, (i, k)
    out, j = [], n
    while j > 0:
        i, k = back[j]
        if k >= 0:
            out.append((edges[i], k, edges[j]))
        j = i
    return out[::-1]


def all_spans(text: str, names: dict[str, int], w: np.ndarray) -> tuple[list[Span], list[Span]]:
    """Base findings, and all findings (those that the CRF adds beside the base ones)."""
    base = base_spans(text)
    added: list[Span] = []
    if w.size:
        taken: list[list[int]] = []  # what base findings cover
        for a, _, b in base:
            if taken and a <= taken[-1][1]:
                taken[-1][1] = max(b, taken[-1][1])
            else:
                taken.append([a, b])
        first = 0
        for lo, hi in regions(text):
            while first < len(taken) and taken[first][1] <= lo:
                first += 1
            last = first
            while last < len(taken) and taken[last][0] < hi:
                last += 1
            inside = [(max(a - lo, 0), min(b, hi) - lo) for a, b in taken[first:last]]
            added += [(lo + a, k, lo + b) for a, k, b in decode(text[lo:hi], names, w, text[lo - 1 : lo], text[hi : hi + 1], inside)]
    return base, sorted([*base, *added])


# -- sample --------------------------------------------------------------------------------------


def rewritten(text: str, spans: list[Span], seed: int) -> list[tuple[str, list[Span]]]:
    """Copies of a labelled region with its spans in another form, and with look-alikes."""
    out = []
    for form in range(3):
        pieces, kept, at, size = [], [], 0, 0
        for a, k, b in spans:
            if a < at:
                continue
            s = text[a:b]
            wrong = (form + seed) % 3 == 2
            if k == 0:
                s, wrong = s.replace("@", ("(at)", " @ ", " (at) ")[form]), False
            elif k == 3:
                groups = [d for d in re.findall(r"[0-9]+", s)]
                groups = groups[1:] if len(groups) > 2 else groups
                s = ("-".join(groups), ".".join(groups), "(" + groups[0] + ") " + "-".join(groups[1:]))[form]
                wrong = False
            elif k == 2 and wrong:
                digits = re.sub(r"[^0-9]", "", s)
                s = digits[:-1] + str((int(digits[-1]) + 3) % 10)
            elif k == 1 and wrong:
                s = s.rsplit(".", 1)[0] + ".777"
            pieces += [text[at:a], s]
            size += a - at
            if not wrong:
                kept.append((size, k, size + len(s)))
            size += len(s)
            at = b
        out.append(("".join(pieces) + text[at:], kept))
    form = (" (at) ", " [AT] ", "{at}", " at ")[seed % 4]
    mails = [x for x in spans if x[1] == 0]
    if mails:  # one more copy with spelled-out dots
        pieces, kept, at, size = [], [], 0, 0
        for a, k, b in mails:
            dot = form.lower().replace("at", "dot")
            s = text[a:b].replace(".", dot).replace("@", form)
            pieces += [text[at:a], s]
            size += a - at
            kept.append((size, k, size + len(s)))
            size += len(s)
            at = b
        out.append(("".join(pieces) + text[at:], kept))
    return out


def _sample_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Regions with the kinds found in them (``len(KINDS)`` stands for none)."""
    for batch in batches:
        found, kinds = [], []
        for text in batch.column("t").to_pylist():
            spans = base_spans(text)
            if not spans:
                continue
            bounds = list(regions(text, MARGIN))
            starts = [a for a, _ in bounds]
            short = [(a, b) for a, b in bounds if b - a <= LONGEST]
            for a, _, b in spans:
                at = bisect_right(starts, a) - 1
                if b - a <= MAX_CHARS and at >= 0 and bounds[at][1] - bounds[at][0] > LONGEST:
                    short.append((max(0, a - MARGIN), b + MARGIN))
            for a, b in short:
                region = text[a:b]
                mine = {k for _, k, _ in base_spans(region)} or {len(KINDS)}
                found += [region] * len(mine)
                kinds += sorted(mine)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(kinds, pa.int32())], names=["region", "kind"])


def sample_regions(docs: DataFrame, text_col: str = "text", per_kind: int = PER_KIND) -> list[str]:
    """At most ``per_kind`` distinct regions of each kind and as many without a finding, so that
    no kind is crowded out by another; every task ranks its own before the rows meet."""
    t = text_of(text_col)
    found = docs.select(t.alias("t")).filter(F.col("t").rlike(TRIGGER)).mapInArrow(_sample_regions, "region string, kind int")
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("region"), "region"))
    rows = found.distinct().withColumn("n", rank).filter(F.col("n") <= per_kind)
    return [r["region"] for r in rows.select("region").distinct().orderBy(F.xxhash64("region"), "region").collect()]


def fit(docs: DataFrame, text_col: str = "text", per_kind: int = PER_KIND) -> tuple[dict[str, int], np.ndarray]:
    """Train on at most ``per_kind`` regions of each kind (and of none) of at most LONGEST characters."""
    rows = sample_regions(docs, text_col, per_kind)
    examples = []
    for n, region in enumerate(rows):
        spans, at = [], 0
        for s in base_spans(region):
            if s[0] >= at:
                spans.append(s)
                at = s[2]
        examples.append((region, spans))
        examples += rewritten(region, spans, n)
    if not any(spans for _, spans in examples):
        return {}, np.zeros((len(KINDS), 0))
    return train(examples)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): spans as (start, rank, kind, stop, base), sorted, for each row."""
    names, w = fit(docs, text_col)  # a few hundred features x four types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("kind", pa.string()), ("stop", pa.int64()), ("base", pa.bool_())])
        for batch in batches:
            rows = []
            for text in batch.column("t").to_pylist():
                base, every = all_spans(text, names, w) if text else ([], [])
                mine = set(base)
                rows.append([{"start": a, "rank": k, "kind": KINDS[k], "stop": b, "base": (a, k, b) in mine} for a, k, b in every])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.list_(kind))], names=["id", "spans"])

    t = text_of(text_col)
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.when(t.rlike(TRIGGER), t).otherwise("").alias("t"))  # nothing can be found without a trigger
    return rows.mapInArrow(run, "id long, spans array<struct<start:bigint,rank:int,kind:string,stop:bigint,base:boolean>>")


def pii_report(docs: DataFrame) -> DataFrame:
    df = find_pii(docs)
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{k}")
    return df.select(F.col("id").alias("doc_id"), *[count(k) for k in KINDS], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
