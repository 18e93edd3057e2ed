"""Sums of doubles that do not depend on the order of the rows.

A double is cut into whole multiples of powers of 2**32 (three of them hold its 53 bits).
Multiples of the same power are whole numbers, so their sums are exact in any order and from
any partitioning; a group holds at most some sixty of them.  They are added in two halves of
64-bit numbers, which hold for 2**46 rows a group.  The exact total is then brought into its one
normal form (digits in base 2**32 of one sign, from the group's lowest power to its highest) and
rounded once, half to even.

Bits below 2**-992 are not counted.  Infinite values and NaN give what plain addition gives.
NULLs are skipped; without any value the sum is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32
LOWEST, HIGHEST = -29, 31
_BASE = 1 << BITS
_MASK = _BASE - 1
_HALF = 16


def _power(limb: Column) -> Column:
    return F.pow(F.lit(2.0), limb * BITS)


def _finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))


def _with_limbs(df: DataFrame, i: int) -> DataFrame:
    """Adds, for the value ``__v<i>``, the whole multiples ``__p<i>_0`` to ``__p<i>_2`` of
    2**(32 * limb) for the limbs ``__t<i>`` and the two below; together they are the value."""
    v, top = F.col(f"__v{i}"), F.col(f"__t{i}")
    guess = F.when(v == 0, 0).otherwise(F.floor(F.log2(F.abs(v)) / BITS).cast("int"))  # one off does no harm: three limbs still hold all bits
    out = df.withColumn(f"__t{i}", F.when(_finite(v), F.greatest(F.lit(LOWEST), F.least(F.lit(HIGHEST), guess))))
    rest = F.when(_finite(v), v)
    for step in range(3):
        out = out.withColumn(f"__r{i}", rest).withColumn(f"__s{i}", _power(top - step))
        quotient = F.col(f"__r{i}") / F.col(f"__s{i}")
        out = out.withColumn(f"__p{i}_{step}", F.when(quotient < 0, F.ceil(quotient)).otherwise(F.floor(quotient)))
        rest = F.col(f"__r{i}") - F.col(f"__p{i}_{step}").cast("double") * F.col(f"__s{i}")
    return out


def _one(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digits(sums: Column) -> Column:
    """Struct(sign, digits, low): base-2**32 digits from 2**(32 * low) upwards, of one sign, of
    the entries ``t, d0, d1, d2, d3`` (each d<k> a multiple of 2**(32 * (t + 1 - k)))."""

    def at(i: Column) -> Column:
        return F.aggregate(sums, F.lit(0).cast("long"), lambda a, s: a + F.when(s["t"] + 1 == i, s["d0"]).when(s["t"] == i, s["d1"]).when(s["t"] - 1 == i, s["d2"]).when(s["t"] - 2 == i, s["d3"]).otherwise(F.lit(0).cast("long")))

    def carry(acc: Column, x: Column) -> Column:
        total = acc["carry"] + x
        return F.struct(F.shiftright(total, BITS).alias("carry"), F.concat(acc["out"], F.array(total.bitwiseAND(F.lit(_MASK)))).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("out"))
    walk = lambda xs: F.aggregate(xs, start, carry)
    low, high = F.array_min(F.transform(sums, lambda s: s["t"])) - 2, F.array_max(F.transform(sums, lambda s: s["t"])) + 3  # room for the carries
    signed = lambda up: F.when(up["carry"] >= 0, F.struct(F.lit(1).alias("sign"), up["out"].alias("digits"))).otherwise(
        F.struct(F.lit(-1).alias("sign"), walk(F.transform(up["out"], lambda d: -d))["out"].alias("digits")))
    return _one(low, lambda first: _one(walk(F.transform(F.sequence(first, high), at)), lambda up: signed(up).withField("low", first)))


def _rounded(number: Column) -> Column:
    """The double nearest to the digits: 62 leading bits, the last of them set if any bit below
    is, so that the conversion rounds once and rightly."""
    return _one(number, _convert)


def _convert(number: Column) -> Column:
    shift = lambda name, x, n: F.call_function(name, x, n.cast("int"))
    digits, size = number["digits"], F.size(number["digits"])
    top = F.aggregate(F.sequence(F.lit(1), size), F.lit(0), lambda a, i: F.when(F.element_at(digits, i) != 0, i).otherwise(a))

    def convert(n: Column) -> Column:
        digit = lambda back: F.coalesce(F.try_element_at(digits, F.greatest(n - back, F.lit(1))), F.lit(0).cast("long")) * F.when(n > back, 1).otherwise(0)
        return _one(F.length(F.bin(digit(0))), lambda bits: _one(
            F.struct(
                (shift("shiftleft", digit(0), 62 - bits) + F.when(bits <= 30, shift("shiftleft", digit(1), F.greatest(30 - bits, F.lit(0)))).otherwise(shift("shiftright", digit(1), F.greatest(bits - 30, F.lit(0))))
                 + F.when(bits <= 30, shift("shiftright", digit(2), bits + 2)).otherwise(0)).alias("lead"),
                (F.when(bits > 30, (F.pmod(digit(1), shift("shiftleft", F.lit(1).cast("long"), F.greatest(bits - 30, F.lit(0)))) != 0) | (digit(2) != 0)).otherwise(F.pmod(digit(2), shift("shiftleft", F.lit(1).cast("long"), F.least(bits + 2, F.lit(32)))) != 0)
                 | F.exists(F.slice(digits, F.lit(1), F.greatest(n - 3, F.lit(0))), lambda d: d != 0)).alias("below"),
            ),
            lambda w: (w["lead"].bitwiseOR(F.when(w["below"], 1).otherwise(0).cast("long"))).cast("double") * F.pow(F.lit(2.0), (n - 1 + number["low"]) * BITS / 2.0) * F.pow(F.lit(2.0), (n - 1 + number["low"]) * BITS / 2.0 + bits - 62)))

    return number["sign"] * _one(top, lambda n: F.when(n == 0, F.lit(0.0)).otherwise(convert(n)))


def _high(s: Column) -> Column:
    """The upper digits of a group's only entry as one number, where they fit."""
    fits = (s["t"] >= -20) & (s["t"] <= 20) & (s["d0"] >= -1) & (s["d0"] <= 0)
    top = s["d0"] * F.lit(_BASE) + s["d1"]
    return F.when(fits & (F.abs(top) < 1 << 29), top * F.lit(_BASE) + s["d2"])


def _short(s: Column, high: Column, bits: Column) -> Column:
    """The double nearest to ``high`` * 2**32 + d3: as many bits of d3 as a 64-bit number has room
    for are moved up, and the last bit is set if a bit below is, so that it rounds once."""
    shift = lambda name, x, n: F.call_function(name, x, n.cast("int"))
    room = F.least(F.lit(62) - bits, F.lit(BITS))
    lead = shift("shiftleft", high, room) + shift("shiftright", s["d3"], F.lit(BITS) - room)
    below = F.pmod(s["d3"], shift("shiftleft", F.lit(1).cast("long"), F.lit(BITS) - room)) != 0
    return lead.bitwiseOR(F.when(below, 1).otherwise(0).cast("long")).cast("double") * F.pow(F.lit(2.0), (s["t"] - 1) * BITS - room)


def exact_sums(df: DataFrame, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """G1 one row per group of ``keys`` with the exactly rounded sum of each expression.

    The whole multiples are added up by (group, measure, limb) with partial aggregation, so a
    hot group costs a few dozen rows a task; the second grouping gathers at most some sixty
    per measure."""
    cols = [F.col(f"`{k}`") for k in keys]
    values = {name: v.cast("double") for name, v in sums.items()}
    source = df.select(*cols, *[v.alias(f"__v{i}") for i, v in enumerate(values.values())])
    for i in range(len(values)):
        source = _with_limbs(source, i)
    entry = lambda i: F.struct(F.lit(i).alias("__m"), F.col(f"__t{i}").alias("__t"), *[F.col(f"__p{i}_{step}").alias(f"__p{step}") for step in range(3)], F.when(~_finite(F.col(f"__v{i}")), F.col(f"__v{i}")).alias("__odd"))
    there = F.filter(F.array(*[entry(i) for i in range(len(values))]), lambda e: e["__t"].isNotNull() | e["__odd"].isNotNull())
    spread = source.select(*cols, F.explode_outer(there).alias("__e")).select(*cols, "__e.*")  # a row without values keeps its group
    halves = [F.sum(F.shiftright(f"__p{step}", _HALF)).alias(f"__h{step}") for step in range(3)] + [F.sum(F.col(f"__p{step}").bitwiseAND(F.lit((1 << _HALF) - 1))).alias(f"__l{step}") for step in range(3)]
    partial = spread.groupBy(*cols, "__m", "__t").agg(*halves, F.sum("__odd").alias("__odd"))
    # what a limb's halves hold above 32 bits goes to the limb above
    above = [F.shiftright(f"__h{step}", BITS - _HALF) for step in range(3)]
    own = [F.shiftleft(F.col(f"__h{step}").bitwiseAND(F.lit((1 << (BITS - _HALF)) - 1)), _HALF) + F.col(f"__l{step}") for step in range(3)]
    digits = {"d0": above[0], "d1": own[0] + above[1], "d2": own[1] + above[2], "d3": own[2]}
    entries = partial.select(*cols, "__m", "__t", "__odd", *[d.alias(f"__{n}") for n, d in digits.items()])
    for n, up in (("3", "2"), ("2", "1"), ("1", "0")):  # every digit but the first in 0 to 2**32 - 1
        entries = entries.withColumn(f"__d{up}", F.col(f"__d{up}") + F.shiftright(f"__d{n}", BITS)).withColumn(f"__d{n}", F.col(f"__d{n}").bitwiseAND(F.lit(_MASK)))
    nothing = (F.col("__d0") == 0) & (F.col("__d1") == 0) & (F.col("__d2") == 0) & (F.col("__d3") == 0)
    entry = F.when(F.col("__t").isNotNull() & ~nothing, F.struct(F.col("__t").alias("t"), *[F.col(f"__{n}").alias(n) for n in digits]))
    entries = entries.select(*cols, "__m", "__t", "__odd", entry.alias("__s"))
    whole = entries.groupBy(*cols).agg(
        *[F.collect_list(F.when(F.col("__m") == i, F.col("__s"))).alias(f"__sums{i}") for i in range(len(values))],
        *[F.count(F.when(F.col("__m") == i, F.col("__t"))).alias(f"__of{i}") for i in range(len(values))],
        *[F.sum(F.when(F.col("__m") == i, F.col("__odd"))).alias(f"__odd{i}") for i in range(len(values))])
    for i in range(len(values)):
        whole = whole.withColumn(f"__first{i}", F.when(F.size(f"__sums{i}") == 1, F.try_element_at(f"__sums{i}", F.lit(1))))
        whole = whole.withColumn(f"__high{i}", _high(F.col(f"__first{i}"))).withColumn(f"__bits{i}", F.length(F.bin(F.abs(F.col(f"__high{i}")))))

    def total(i: int) -> Column:
        short = _short(F.col(f"__first{i}"), F.col(f"__high{i}"), F.col(f"__bits{i}"))
        return F.when(F.col(f"__odd{i}").isNotNull(), F.col(f"__odd{i}")).when(F.col(f"__of{i}") == 0, F.lit(None)).when(F.size(f"__sums{i}") == 0, F.lit(0.0)).when(F.col(f"__high{i}").isNotNull(), short).otherwise(_rounded(_digits(F.col(f"__sums{i}"))))

    return whole.select(*cols, *[total(i).alias(name) for i, name in enumerate(values)])
