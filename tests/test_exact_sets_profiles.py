"""Exact sums, expected values in tables, and profiles kept per version."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from sheetmill.operators import value_sets as V
from sheetmill.operators.contracts import components_sum_to_total
from sheetmill.operators.exact import exact_sums
from sheetmill.sources import medallion, profiles
from sheetmill.sources.files import SourceNotFound


def test_exact_sums_equal_fsum_in_any_order(spark):
    rng = random.Random(1)
    groups = {}
    for g in range(60):
        draw = (lambda: rng.uniform(-1e3, 1e3), lambda: rng.uniform(-1, 1) * 10.0 ** rng.randint(-200, 200), lambda: 2.0 ** rng.randint(-300, 300))
        values = [rng.choice(draw)() for _ in range(rng.randint(1, 30))]
        if g % 3 == 0:  # cancels but for one value
            values += [-v for v in values] + [rng.random() * 10.0 ** rng.randint(-30, 5)]
        groups[g] = values
    groups[60] = [0.1] * 10
    groups[61] = [1.0, 2.0**-53, 2.0**-106]  # above half by a bit far below
    groups[62] = [1.0, 2.0**-53]  # a tie goes to even
    rows = [(g, v) for g, values in groups.items() for v in values]
    odd = [(100, None), (101, math.inf), (101, 1.0), (102, math.nan), (103, 0.0), (104, 1.0), (104, -1.0), (105, math.inf), (105, -math.inf), (None, 2.5), (None, None)]
    seen = []
    for parts in (1, 37):
        rng.shuffle(rows)
        df = spark.createDataFrame([*rows, *odd], "g int, v double").repartition(parts)
        seen.append({r["g"]: (r["x"], r["y"]) for r in exact_sums(df, ["g"], {"x": F.col("v"), "y": -F.col("v")}).collect()})
    assert str(seen[0]) and {g: str(x) for g, x in seen[0].items()} == {g: str(x) for g, x in seen[1].items()}
    got = seen[0]
    for g, values in groups.items():
        assert got[g] == (math.fsum(values), -math.fsum(values)), g
    assert got[100] == (None, None) and got[101] == (math.inf, -math.inf) and math.isnan(got[102][0])
    assert got[103][0] == 0 and got[104][0] == 0 and math.isnan(got[105][0]) and got[None] == (2.5, -2.5)
    assert exact_sums(df.where("false"), ["g"], {"x": F.col("v")}).count() == 0


def test_exact_sums_of_a_group_cost_little(spark):
    """The digits of a group span its own limbs only, and whole numbers are added as 64-bit numbers."""
    df = spark.range(40_000).select(F.expr("id div 2").alias("m"), F.expr("IF(id % 2 = 0, id, -id) * 0.01D").alias("t"))
    sums = exact_sums(df, ["m"], {"x": F.col("t")})
    plan = sums._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal" not in plan
    assert {r["m"]: r["x"] for r in sums.where("m % 997 = 3").collect()} == {m: math.fsum([2 * m * 0.01, -(2 * m + 1) * 0.01]) for m in range(3, 20_000, 997)}


def test_exact_sums_of_many_rows_carry(spark):
    """Parts of one sign whose sums pass 32 bits by far, beside parts of the other sign."""
    big, small = float(2**53 - 1) * 2.0**20, -float(2**53 - 1)
    df = spark.range(0, 300_000, 1, 5).select(F.expr(f"IF(id % 3 = 0, {small!r}D, {big!r}D)").alias("v"))
    exact = 200_000 * int(big) + 100_000 * int(small)
    got = exact_sums(df, [], {"x": F.col("v"), "y": -F.col("v")}).first()
    assert (got["x"], got["y"]) == (float(exact), -float(exact))


def test_exact_sums_of_one_power_round_once(spark):
    """Groups whose multiples lie side by side, ties and bits just below and above them, of either sign."""
    rng = random.Random(8)
    groups = {g: [rng.choice((-1, 1)) * rng.random() * 2.0 ** (32 * rng.choice((k, k)) + rng.randint(0, 31)) for _ in range(rng.randint(1, 4))] for g, k in enumerate(rng.randint(-19, 19) for _ in range(500))}
    for g, (a, b) in enumerate([(2.0**31, 2.0**-22), (2.0**31, 2.0**-23), (2.0**31 + 2.0**-21, 2.0**-22), (2.0**20, -(2.0**-34)), (1.0, -1.0), (2.0**31, 2.0**31)], 1000):
        groups[g], groups[-g] = [a, b, 0.0], [-a, -b]
    df = spark.createDataFrame([(g, v) for g, values in groups.items() for v in values], "g int, v double")
    assert {r["g"]: r["x"] for r in exact_sums(df, ["g"], {"x": F.col("v")}).collect()} == {g: math.fsum(values) for g, values in groups.items()}


def test_components_sum_cancels_exactly(spark):
    rows = [("a", "x", 1e17), ("a", "y", 0.25), ("a", "z", -1e17), ("a", "Total_GB average", 0.25), ("b", "x", None), ("b", None, 1.0), ("b", "Total_GB average", 2.0)]
    df = spark.createDataFrame(rows, "g string, `Tariff component` string, value double").repartition(3)
    got = {r["g"]: (r["components"], r["total"], r["ok"]) for r in components_sum_to_total(df, ["g"], exact=True).collect()}
    assert got == {"a": (0.25, 0.25, True), "b": (1.0, 2.0, False)}


@pytest.mark.parametrize("words", [1, 64, V.WORDS])
def test_value_sets_are_exact_with_any_filter(spark, words):
    """A filter of one word is full and decides nothing: results stay the same."""
    df = spark.createDataFrame([(i, i % 300 * 3) for i in range(900)] + [(-1, None), (-2, 5000)] + [(-3, 5000)], "id int, v int")
    expected = spark.createDataFrame([(x,) for x in [*range(300), *range(100), None]], "w long")
    missing = sorted(r["value"] for r in V.missing_from_table(df, "v", expected, "w", words=words).collect())
    assert missing == [x for x in range(300) if x % 3]
    unexpected = sorted(r["v"] for r in V.unexpected_in_table(df, "v", expected, "w", words).collect())
    assert unexpected == [*range(300, 900, 3), 5000]
    outside = sorted(r["id"] for r in V.rows_outside_table(df, "v", expected, "w", words).collect())
    assert outside == sorted([-3, -2, *(i for i in range(900) if i % 300 * 3 >= 300)])
    none = expected.where("false")
    assert V.missing_from_table(df, "v", none, "w", words=words).count() == 0
    assert V.unexpected_in_table(df, "v", none, "w", words).count() == 301
    assert V.missing_from_table(df.where("false"), "v", expected, "w", words=words).count() == 300


def test_profiles_merge_over_versions(spark, root):
    df = spark.range(9000).select("id", (F.col("id") % 1000).cast("double").alias("v"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    for part in range(3):
        medallion.publish(df.where(F.col("id") % 3 == part), root, "silver", "d", "t", "version", f"v{part}", profile=True)
    read = lambda versions=None: {r["column"]: r for r in profiles.estimates(profiles.merged(profiles.read_profiles(spark, root, "silver", "d", "t", versions))).collect()}
    every = read()
    assert {c: (r["rows"], r["nulls"]) for c, r in every.items()} == {"id": (9000, 0), "v": (9000, 0), "k": (9000, 3000)}
    assert (every["id"]["low"], every["id"]["high"], every["k"]["smallest"], every["k"]["largest"]) == (0.0, 8999.0, "k0", "k9")
    assert abs(every["id"]["distinct"] - 9000) <= 9000 * profiles.DISTINCT_ERROR and every["k"]["distinct"] == 50 and every["k"]["q50"] is None
    assert abs(every["v"]["q50"] - 500) <= 1000 * profiles.RANK_ERROR
    one = read(["v0"])
    assert (one["k"]["rows"], one["k"]["nulls"], one["k"]["distinct"], one["k"]["smallest"]) == (3000, 3000, 0, None)
    medallion.publish(df.where("id < 10"), root, "silver", "d", "t", "version", "v0", profile=["id"])  # again: its new profile counts
    assert read(["v0"])["id"]["rows"] == 10 and set(read(["v0"])) == {"id"}
    with pytest.raises(SourceNotFound):
        profiles.read_profiles(spark, root, "silver", "d", "t", ["v9"])
