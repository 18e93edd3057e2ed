"""F6 / F7 / I7 against a table of expected values of any size.

Both directions use one Bloom filter over the expected values: a fixed number of 64-bit
words, filled by a grouped ``bit_or`` (each task combines its own bits first) and read by the
other plan as a scalar subquery.  Its size is the parameter ``words``, whatever the tables
hold.  What the filter rules out is decided on the spot and never shuffled; the rest meets the
expected values in an exact anti-join, so a full or unlucky filter costs time, never a row.

NULL is no value on either side: it is neither missing nor unexpected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of the filter (1 MB): two bits each for some millions of values leave it half empty.
WORDS = 1 << 17
HASHES = 2


def _places(value: Column, words: int) -> list[tuple[Column, Column]]:
    """(word, bit) of a value, one for each hash."""
    hashes = [F.xxhash64(F.lit(seed), value) for seed in range(HASHES)]
    return [(F.pmod(h, F.lit(words)).cast("int"), F.shiftrightunsigned(h, 58).cast("int")) for h in hashes]


def bloom_filter(values: DataFrame, col: str, words: int = WORDS) -> Column:
    """The words of the filter over a column, as a scalar subquery (array of ``words`` longs)."""
    bits = [F.struct(w.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), b).alias("bits")) for w, b in _places(F.col(col), words)]
    found = values.where(F.col(col).isNotNull()).select(F.inline(F.array(*bits)))
    blank = values.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    filled = found.groupBy("word").agg(F.bit_or("bits").alias("bits")).unionByName(blank).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("words")).scalar()


def may_contain(filter_words: Column, value: Column, words: int = WORDS) -> Column:
    """False where the value is certainly not among those of the filter."""
    out = F.lit(True)
    for w, b in _places(value, words):
        out = out & (F.call_function("shiftright", F.get(filter_words, w), b).bitwiseAND(F.lit(1).cast("long")) == 1)
    return out


def _wanted(df: DataFrame, col: str, expected: DataFrame, expected_col: str) -> DataFrame:
    return expected.select(F.col(expected_col).cast(df.schema[col].dataType).alias("__want")).where(F.col("__want").isNotNull())


def missing_from_table(df: DataFrame, col: str, expected: DataFrame, expected_col: str, out: str = "value", words: int = WORDS) -> DataFrame:
    """F6 the distinct expected values that do not occur in ``col``.  Only rows whose value may
    be expected are shuffled, each task's copies of a value as one."""
    want = _wanted(df, col, expected, expected_col).distinct()
    seen = df.select(F.col(col).alias("__seen")).where(F.col("__seen").isNotNull() & may_contain(bloom_filter(want, "__want", words), F.col("__seen"), words)).distinct()
    return want.join(seen, F.col("__want") == F.col("__seen"), "left_anti").select(F.col("__want").alias(out))


def rows_outside_table(df: DataFrame, col: str, allowed: DataFrame, allowed_col: str, words: int = WORDS) -> DataFrame:
    """I7 the rows whose ``col`` is not among the allowed values (rows with NULL are not returned)."""
    want = _wanted(df, col, allowed, allowed_col)
    src = df.where(F.col(col).isNotNull())
    maybe = may_contain(bloom_filter(want, "__want", words), F.col(col), words)
    return src.where(~maybe).unionByName(src.where(maybe).join(want, F.col(col) == F.col("__want"), "left_anti"))


def unexpected_in_table(df: DataFrame, col: str, allowed: DataFrame, allowed_col: str, words: int = WORDS) -> DataFrame:
    """F7 the distinct values of ``col`` that are not among the allowed ones."""
    want = _wanted(df, col, allowed, allowed_col)
    src = df.select(col).where(F.col(col).isNotNull())
    maybe = may_contain(bloom_filter(want, "__want", words), F.col(col), words)
    undecided = src.where(maybe).distinct().join(want, F.col(col) == F.col("__want"), "left_anti")
    return src.where(~maybe).distinct().unionByName(undecided)
