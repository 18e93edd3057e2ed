"""Secret scan with multipart credential linking (native).

Strong findings stand alone (kinds ``assign``, ``access``, ``hex``).  Weak candidates
(``ident``: account or client identifiers, ``key``: loosely labelled or bare keys,
``endpoint``: addresses) are reported only when their complementary parts occur with them:

* a key next to an identifier (``access`` or ``ident``) or an endpoint,
* an identifier next to a secret (``assign``, ``hex`` or ``key``),
* an endpoint next to both.

Parts belong together when they lie in the same scope, the interval between two blank lines,
however long it is (a caller may ask for a gap of at most ``window`` code points besides).
This interval join runs over the found parts only: one row per part, keyed by the document,
with running maxima from either side (the nearest end before, the nearest start after).  So no
pairs are ever formed and the cost is n log n in a document's parts.  Rows are told apart by
partition and position: input whose order may change when it is computed again (behind a
shuffle) must be written first, as the pipeline does.

Positions come from splitting at the matches: the gap before match i plus its own length,
summed up by a window.  Offsets are code points.

Defined results: NULL text counts as empty; a NULL id keeps its row; each repeated row gets
its own result; overlapping weak and strong findings keep only the strong one; a document
without findings has an empty ``spans`` and the digest of the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheetmill.llm.common import quoted, text_of, whole_row

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs under 24 (20) characters are dropped; as a run always matches whole, asking for the
#: length in the pattern gives the same spans.
HEX = r"[0-9a-f]{24,}"
ACCESS = r"AKIA[A-Z0-9]{16,}"
IDENT = r"""(?i)(?:client_?id|access_?key_?id|account_?id|user_?name|user_?id|login|user)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
KEY = r"""(?i)(?:key|pwd|pass|auth|credential|signature)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8,}|(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{32,}={0,2}"""
ENDPOINT = r"""(?:https?|ftp|s3|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\x00-\x20"'<>]{3,}|(?:host|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}"""
BLANK_LINES = r"\n[\x20\t\r]*\n\s*"

#: Kinds in listing order; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "ident", "key", "endpoint")
PART = "array<struct<kind:int,i:int,gap:bigint,len:bigint,ok:boolean>>"


def _parts(text: Column, kind: int, pattern: str, found: Column, ok: Column | None = None) -> Column:
    """Matches as (kind, index, characters since the previous match, length, accepted)."""
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("g"), found.alias("m"), *([ok.alias("v")] if ok is not None else []))
    part = lambda x, i: F.struct(
        F.lit(kind).alias("kind"),
        i.alias("i"),
        F.char_length(x["g"]).cast("long").alias("gap"),
        F.char_length(x["m"]).cast("long").alias("len"),
        (F.char_length(x["v"]) >= 6 if ok is not None else F.lit(True)).alias("ok"),
    )
    some = F.filter(F.transform(zipped, part), lambda p: p["len"].isNotNull())
    return F.when(F.size(found) > 0, some).otherwise(F.array().cast(PART))


def secret_spans(docs: DataFrame, text_col: str = "text", window: int | None = None, carry: tuple[str, ...] | None = None) -> DataFrame:
    """One row per input row: ``row`` (struct of the ``carry`` columns, all by default) and
    ``spans`` (array of (start, rank, kind, stop, base), sorted)."""
    names = docs.columns if carry is None else list(carry)
    t = F.col("t")
    every = lambda p, g=0: F.regexp_extract_all(t, F.lit(p), F.lit(g))
    df = docs.select(F.struct(*[F.col(quoted(c)) for c in names]).alias("row"), text_of(text_col).alias("t"), F.monotonically_increasing_id().alias("rid"))
    df = df.select("*", every(ASSIGN).alias("m0"), every(ACCESS).alias("m1"), every(HEX).alias("m2"), every(IDENT).alias("m3"), every(KEY).alias("m4"), every(ENDPOINT).alias("m5"))
    weak = F.size("m3") + F.size("m4") + F.size("m5") > 0
    breaks = F.when(weak, every(BLANK_LINES)).otherwise(F.array().cast("array<string>"))
    df = df.select("*", breaks.alias("m6"), F.when(F.size("m0") > 0, every(ASSIGN, 2)).otherwise(F.array().cast("array<string>")).alias("v0"))
    arrays = [_parts(t, 0, ASSIGN, F.col("m0"), F.col("v0"))]
    arrays += [_parts(t, k, p, F.col(f"m{k}")) for k, p in enumerate((ACCESS, HEX, IDENT, KEY, ENDPOINT, BLANK_LINES), 1)]
    exploded = df.select("rid", "row", F.posexplode_outer(F.concat(*arrays)).alias("pos", "p"))
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0  # the carried columns travel once per document
    parts = exploded.select("rid", F.when(first, F.col("row")).alias("row"), F.col("p.kind").alias("kind"), "p.i", "p.gap", "p.len", "p.ok")

    stop = F.sum(F.col("gap") + F.col("len")).over(Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    placed = parts.withColumn("stop", stop).withColumn("start", F.col("stop") - F.col("len"))
    kind = F.col("kind")
    here = Window.partitionBy("rid").orderBy("start", "stop", "kind").rowsBetween(Window.unboundedPreceding, 0)
    scoped = placed.withColumn("scope", F.count(F.when(kind == 6, 1)).over(here))
    base = (kind <= 2) & F.col("ok")
    roles = {"id": (kind == 1) | (kind == 3), "secret": ((kind == 0) & F.col("ok")) | (kind == 2) | (kind == 4), "place": kind == 5}
    before = Window.partitionBy("rid", "scope").orderBy("start", "stop", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("rid", "scope").orderBy(F.desc("start"), F.desc("stop"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    for role, has in roles.items():
        scoped = scoped.withColumn(f"{role}_b", F.max(F.when(has, F.col("stop"))).over(before))
    scoped = scoped.withColumn("base_b", F.max(F.when(base, F.col("stop"))).over(before))
    for role, has in roles.items():
        scoped = scoped.withColumn(f"{role}_a", F.min(F.when(has, F.col("start"))).over(after))
    scoped = scoped.withColumn("base_a", F.min(F.when(base, F.col("start"))).over(after))
    if window is None:
        near = lambda r: F.col(f"{r}_b").isNotNull() | F.col(f"{r}_a").isNotNull()
    else:
        near = lambda r: F.coalesce(F.col("start") - F.col(f"{r}_b") <= window, F.lit(False)) | F.coalesce(F.col(f"{r}_a") - F.col("stop") <= window, F.lit(False))
    overlaps = F.coalesce(F.col("base_b") > F.col("start"), F.lit(False)) | F.coalesce(F.col("base_a") < F.col("stop"), F.lit(False))
    linked = F.when(kind == 3, near("secret")).when(kind == 4, near("id") | near("place")).when(kind == 5, near("id") & near("secret")).otherwise(False)
    reported = F.coalesce(base, F.lit(False)) | (F.coalesce(linked, F.lit(False)) & ~overlaps)
    name = F.get(F.array(*[F.lit(k) for k in KINDS]), kind)
    span = F.struct("start", kind.alias("rank"), name.alias("kind"), "stop", base.alias("base"))
    return scoped.groupBy("rid").agg(F.first("row", ignorenulls=True).alias("row"), F.array_sort(F.collect_list(F.when(reported, span))).alias("spans")).select("row", "spans")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans, per document."""
    df = secret_spans(docs, carry=("doc_id",))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return df.select(F.col("row.doc_id").alias("doc_id"), count("assign"), count("access"), count("hex"), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def redact_secrets(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", window: int | None = None) -> DataFrame:
    """``docs`` with every reported span replaced by ``[SECRET]`` (overlapping spans by one) and
    the character count brought up to date where the column exists."""
    found = secret_spans(docs, text_col, window)
    text = F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))
    cut = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.struct(
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("[SECRET]"))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["stop"]).alias("at"),
        ),
    )
    clean = F.when(F.size("spans") > 0, F.concat(F.col("cut.out"), F.substring(text, (F.col("cut.at") + 1).cast("int"), F.lit(2**31 - 1)))).otherwise(F.col("row")[text_col])
    df = found.select("row", F.when(F.size("spans") > 0, cut).alias("cut"), "spans").select("row", clean.alias("clean"))
    new = lambda c: F.col("clean") if c == text_col else F.char_length("clean").cast(dict(docs.dtypes)[c]) if c == chars_col else F.col("row")[c]
    return df.select(*[new(c).alias(c) for c in docs.columns])
