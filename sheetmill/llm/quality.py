"""Quality rules with risk-controlled cutoffs (native).

Every document gets a handful of measures (symbols, shouting, capitals, digits, repeated
lines and words).  A rule rejects a document whose measure is above a cutoff.  Cutoffs are
chosen per stratum (language) on labelled documents:

* For each rule and stratum the candidate cutoffs form a fixed grid, tested from the loosest
  to the strictest.  With ``n`` good labelled documents of which ``k`` would be rejected, a
  cutoff is certified when the exact binomial tail ``P(Bin(n, alpha / rules) <= k)`` is at most
  ``delta / (strata * rules)``.  That is the Clopper-Pearson upper bound of the false
  rejection rate being at most ``alpha / rules``.
* ``k`` can only grow along the grid, so the tests form a fixed sequence and need no
  correction over cutoffs; Bonferroni covers strata and rules.  With probability
  ``1 - delta`` the rules together reject at most a share ``alpha`` of the good documents of
  every stratum.
* Of the certified cutoffs the one with the largest (share of bad documents rejected minus
  ``penalty`` times share of good documents rejected) is taken, the loosest on ties; none when
  that is not positive.

The strata are a parameter, so the table of cutoffs is bounded by strata x rules.

Defined results: NULL text has no words (so ``base_failed``); a NULL or unlisted stratum
belongs to the stratum "other"; NULL labels do not count; every repeated row is judged by
itself; a text counts once per stratum in the calibration, however often it or its id repeats,
and as good if any of its labels says so; without labels nothing is certified and only the
base rules reject.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheetmill.llm.common import let, quoted, text_of, whole_row, words_of

RULES = ("symbol_rate", "shout_rate", "upper_share", "digit_share", "dup_line_share", "repeat_share")
OTHER = "other"


@dataclass(frozen=True)
class RiskControl:
    alpha: float = 0.06
    delta: float = 0.05
    penalty: float = 5.0
    step: float = 0.05
    steps: int = 60
    strata: tuple[str, ...] = ("en", "fr", "de", "es")
    rules: tuple[str, ...] = field(default=RULES)

    @property
    def alpha_rule(self) -> float:
        return self.alpha / len(self.rules)

    @property
    def level(self) -> float:
        return self.delta / ((len(self.strata) + 1) * len(self.rules))


def repeated_words(words: Column) -> Column:
    """Number of words inside 3-word windows that occur at least twice in the list.

    A list without equal windows is recognised by one hash pass.  Otherwise the windows are
    sorted with their positions, those equal to a neighbour are kept, and the covered words
    are counted in one scan over the sorted positions: O(n log n), nothing leaves the row."""
    window = lambda ws, i: F.concat_ws(" ", F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2))
    starts = lambda ws: F.sequence(F.lit(0), F.size(ws) - 3)

    def covered(ws: Column) -> Column:
        def flagged(s: Column) -> Column:
            same = lambda j, k: F.get(s, j)["w"] == F.get(s, k)["w"]
            twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: F.coalesce(F.when(j > 0, same(j, j - 1)), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)))
            return F.array_sort(F.transform(twice, lambda j: F.get(s, j)["i"]))

        placed = F.array_sort(F.transform(starts(ws), lambda i: F.struct(window(ws, i).alias("w"), i.alias("i"))))
        return F.aggregate(
            let(placed, flagged),
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
            lambda acc, p: F.struct((acc["n"] + p + 3 - F.greatest(p, acc["end"])).cast("long").alias("n"), (p + 3).alias("end")),
        )["n"]

    def count(ws: Column) -> Column:
        distinct = let(F.transform(starts(ws), lambda i: window(ws, i)), lambda w: F.size(F.array_distinct(w)) == F.size(w))
        return F.when(F.size(ws) < 4, F.lit(0).cast("long")).when(distinct, F.lit(0).cast("long")).otherwise(covered(ws))

    return let(words, count)


def _removed(text: Column, pattern: str) -> Column:
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def measures(docs: DataFrame, text_col: str = "text", stratum_col: str = "lang", control: RiskControl = RiskControl()) -> DataFrame:
    """``row`` (all input columns as a struct) and the measures of each document; row-local."""
    df = docs.select(whole_row(docs).alias("row"), text_of(text_col).alias("t"), F.col(quoted(stratum_col)).cast("string").alias("s"))
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        "row",
        F.xxhash64("t").alias("digest"),
        F.when(F.col("s").isin(*control.strata), F.col("s")).otherwise(OTHER).alias("stratum"),
        let(words_of(F.col("t")), lambda ws: F.struct(F.size(ws).cast("long").alias("n"), repeated_words(ws).alias("r"))).alias("w"),
        _removed(F.col("t"), r"[^\x20\x09-\x0D]+").alias("word_chars"),
        _removed(F.col("t"), r"[#*$%&|<>]+").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("l"),
        _removed(F.col("t"), r"[!?]+").alias("n_shouts"),
        _removed(F.col("t"), r"\p{Lu}+").alias("n_upper"),
        _removed(F.col("t"), r"[0-9]+").alias("n_digits"),
    )
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    n, r = F.col("w.n"), F.col("w.r")
    return df.select(
        "row",
        "digest",
        "stratum",
        n.alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("l.dup").alias("n_dup_lines"),
        r.alias("n_repeat_words"),
        ((n < 50) | (100 * r > 50 * n)).alias("base_failed"),
        share(F.col("n_symbols"), n).alias("symbol_rate"),
        share(F.col("n_shouts"), n).alias("shout_rate"),
        share(F.col("n_upper"), F.col("word_chars")).alias("upper_share"),
        share(F.col("n_digits"), F.col("word_chars")).alias("digit_share"),
        share(F.col("l.dup"), F.col("l.n")).alias("dup_line_share"),
        share(r, n).alias("repeat_share"),
    )


def _log_gamma(x: Column) -> Column:
    """log Gamma(x) for x >= 1, by Stirling's series at x + 8 (error below 1e-12)."""
    import math

    y = x + 8.0
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    shift = F.lit(0.0)
    for i in range(8):
        shift = shift + F.log(x + float(i))
    return series - shift


def log_binomial_tail(n: Column, k: Column, p: float) -> Column:
    """log P(Bin(n, p) <= k) for k <= n p.  From the largest term, that of k, downwards; terms more
    than 12 standard deviations below (under e^-70 of the sum) are not added, so the series grows
    with the root of n only."""
    import math

    at, of = k.cast("double"), n.cast("double")
    largest = _log_gamma(of + 1) - _log_gamma(at + 1) - _log_gamma(of - at + 1) + at * math.log(p) + (of - at) * math.log1p(-p)
    odds = (1 - p) / p

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] * (i / (n - i + 1)) * F.lit(odds)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    reach = F.ceil(12 * F.sqrt(of * p * (1 - p))).cast("long") + 40
    terms = F.when(k > 0, F.sequence(k, F.greatest(F.lit(1).cast("long"), k - reach), F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return largest + F.log(F.aggregate(terms, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")), add)["total"])


def calibration_table(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", control: RiskControl = RiskControl()) -> DataFrame:
    """One row per (stratum, rule, cutoff index): good/bad counts, rejections, certified, gain.

    ``measured`` has ``id``, ``digest`` (of the text) and the measures.  A text is one draw of its
    stratum, however many rows and labelled ids have it; it is good if any label says so.
    Counts come from a histogram over the grid (partial aggregation), then a suffix sum over at
    most ``steps + 1`` bins."""
    lab = labels.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).alias("good")).filter(F.col("good").isin(0, 1))
    known = measured.filter(~F.col("base_failed")).select("id", "digest", "stratum", *control.rules).join(lab, "id")
    rows = known.groupBy("stratum", "digest").agg(F.max("good").alias("good"), *[F.max(r).alias(r) for r in control.rules])
    bins = F.array(*[F.struct(F.lit(r).alias("rule"), F.least(F.ceil(F.col(r) / F.lit(control.step)), F.lit(control.steps + 1)).cast("int").alias("bin")) for r in control.rules])
    hist = (
        rows.select("stratum", "good", F.explode(bins).alias("b"))
        .groupBy("stratum", F.col("b.rule").alias("rule"), F.col("b.bin").alias("bin"))
        .agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((1 - F.col("good")).cast("long")).alias("bad"))
    )
    # a grid row for each cutoff: bins 0 .. steps + 1; cutoff index c rejects the bins above c
    base = hist.groupBy("stratum", "rule").agg(F.collect_list(F.struct("bin", "good", "bad")).alias("h"))  # at most steps + 2 elements
    above = lambda c, f: F.aggregate(F.filter("h", lambda x: x["bin"] > c), F.lit(0).cast("long"), lambda a, x: a + x[f])
    grid = base.select("stratum", "rule", "h", F.explode(F.sequence(F.lit(1), F.lit(control.steps))).alias("c"))
    counts = grid.select("stratum", "rule", "c", above(F.lit(-1), "good").alias("n_good"), above(F.lit(-1), "bad").alias("n_bad"), above(F.col("c"), "good").alias("good_rejected"), above(F.col("c"), "bad").alias("bad_rejected"))
    import math

    tail = F.when((F.col("n_good") > 0) & (F.col("good_rejected") <= F.col("n_good") * F.lit(control.alpha_rule)), log_binomial_tail(F.col("n_good"), F.col("good_rejected"), control.alpha_rule))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    loosest_first = Window.partitionBy("stratum", "rule").orderBy(F.desc("c"))  # at most `steps` rows
    return (
        counts.withColumn("passes", F.coalesce(tail <= F.lit(math.log(control.level)), F.lit(False)))
        .withColumn("certified", F.min("passes").over(loosest_first))
        .withColumn("gain", share("bad_rejected", "n_bad") - F.lit(control.penalty) * share("good_rejected", "n_good"))
    )


def choose_cutoffs(table: DataFrame) -> dict[tuple[str, str], int]:
    """The chosen cutoff (index in the grid) per (stratum, rule); at most strata x rules rows
    reach the driver."""
    best = table.filter(F.col("certified") & (F.col("gain") > 1e-9)).groupBy("stratum", "rule").agg(F.max(F.struct(F.round("gain", 9).alias("g"), F.col("c"))).alias("b"))
    return {(r["stratum"], r["rule"]): r["c"] for r in best.select("stratum", "rule", F.col("b.c").alias("c")).collect()}


def kept_by(cutoffs: dict[tuple[str, str], int], control: RiskControl = RiskControl()) -> Column:
    """True where no base rule and no chosen cutoff rejects."""
    kept = ~F.col("base_failed")
    for (stratum, rule), c in sorted(cutoffs.items()):
        kept = kept & ~((F.col("stratum") == stratum) & (F.ceil(F.col(rule) / F.lit(control.step)) > c))
    return kept


def reject_low_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", control: RiskControl = RiskControl()) -> DataFrame:
    """The rows of ``docs`` that every rule keeps, with all their columns.  The rows are written
    once with their measures, which both the calibration and the verdict read; texts are
    measured once and never shuffled."""
    from sheetmill.session import materialize

    measured = materialize(measures(docs, control=control).select("row", F.col("row")[id_col].alias("id"), *MEASURED), "quality-rows")
    cutoffs = choose_cutoffs(calibration_table(measured, labels, id_col, control=control))
    return measured.filter(kept_by(cutoffs, control)).select("row.*")


def quality_report(docs: DataFrame, labels: DataFrame, control: RiskControl = RiskControl()) -> DataFrame:
    """One row per document: base counts, base verdict, final verdict and the measures.  The
    measures (a few numbers per document) are written once and read by both the calibration
    and the verdict."""
    from sheetmill.session import materialize

    measured = materialize(measures(docs, control=control).select(F.col("row.doc_id").alias("id"), *[c for c in MEASURED]), "quality-measures")
    cutoffs = choose_cutoffs(calibration_table(measured, labels, control=control))
    return measured.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept_by(cutoffs, control).alias("kept"), "stratum", *control.rules
    )


MEASURED = ("digest", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *RULES)
