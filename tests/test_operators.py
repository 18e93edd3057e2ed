"""D/E/F/G/H/I operators on small frames with hand-written expected values."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from sheetmill.operators import contracts as I
from sheetmill.operators import grid as G
from sheetmill.operators import joins as J
from sheetmill.operators import reshape as D
from sheetmill.operators.timeseries import carry_forward, period_over_period


def test_pct_change_pads_nulls(spark):
    # value series [0, 0, 2, null, 3]: pct padded -> [null, null, inf, 0.0, 50.0]; diff null around the gap
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([0.0, 0.0, 2.0, None, 3.0])], "k string, t int, v double")
    out = period_over_period(df, ["k"], ["t"], "v", "d", "p").orderBy("t").collect()
    assert [r["p"] for r in out][:2] == [None, None]
    assert math.isinf(out[2]["p"]) and out[3]["p"] == 0.0 and out[4]["p"] == 50.0
    assert [r["d"] for r in out] == [None, 0.0, 2.0, None, None]


def test_pct_change_without_pad_and_inf_as_null(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([0.0, 2.0, None, 3.0])], "k string, t int, v double")
    out = period_over_period(df, ["k"], ["t"], "v", None, "p", pad=False, inf_as_null=True).orderBy("t").collect()
    assert [r["p"] for r in out] == [None, None, None, None]


def test_null_group_keys_get_no_change(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0)], "k string, t int, v double")
    out = period_over_period(df, ["k"], ["t"], "v", "d", "p").collect()
    assert all(r["d"] is None and r["p"] is None for r in out)


def test_split_by_matches_single_window(spark):
    rnd = random.Random(7)
    rows = [(k, t, None if rnd.random() < 0.3 else float(rnd.randint(0, 5))) for k in ("hot", "cold") for t in range(200 if k == "hot" else 15)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    plain = period_over_period(df, ["k"], ["t"], "v", "d", "p").orderBy("k", "t").collect()
    split = period_over_period(df, ["k"], ["t"], "v", "d", "p", split_by=F.floor(F.col("t") / 17)).orderBy("k", "t").collect()
    assert plain == split
    ff_plain = carry_forward(df, ["k"], ["t"], "v", "f").orderBy("k", "t").collect()
    ff_split = carry_forward(df, ["k"], ["t"], "v", "f", split_by=F.floor(F.col("t") / 11)).orderBy("k", "t").collect()
    assert ff_plain == ff_split


def test_pivot_mean_drops_all_null_groups_and_averages(spark):
    df = spark.createDataFrame(
        [("x", "Nil", 1.0), ("x", "Nil", 3.0), ("x", "Typ", None), ("y", "Nil", None), ("y", "Typ", None), (None, "Nil", 5.0)],
        "k string, c string, v double",
    )
    out = {r["k"]: (r["Nil"], r["Typ"]) for r in D.pivot_mean(df, ["k"], "c", "v", ["Nil", "Typ"]).collect()}
    assert out == {"x": (2.0, None)}
    with pytest.raises(D.ReshapeError, match="Missing"):
        D.pivot_mean(df, ["k"], "c", "v", ["Nil", "Missing"], require=True)


def test_melt_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "id int, a double, b double")
    out = sorted((r["variable"], r["value"]) for r in D.melt(df, ["id"]).collect())
    assert out == [("a", 2.0), ("b", None)]


def test_flatten_nested_defaults(spark):
    from sheetmill.plans.bank_holidays import DOCUMENT

    doc = {"wales": {"division": None, "events": [{"title": "T", "date": "2025-01-01", "notes": None, "bunting": None}]}}
    df = spark.createDataFrame([(doc,)], f"doc {DOCUMENT.simpleString()}")
    row = D.flatten_nested(df, "doc").first()
    assert (row["division"], row["notes"], row["bunting"]) == ("wales", "", False)


def test_standardise_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    with pytest.raises(D.ReshapeError):
        D.standardise_column_names(df)


def test_full_outer_fill_matches_null_keys(spark):
    left = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "k string, v double")
    right = spark.createDataFrame([(None, 10.0), ("b", 20.0)], "k string, v double")
    out = {(r["k"], r["v_l"], r["v_r"]) for r in J.full_outer_fill(left, right, ["k"], ("_l", "_r")).collect()}
    assert out == {(None, 1.0, 10.0), ("a", 2.0, 0.0), ("b", 0.0, 20.0)}


def test_missing_and_literal_table(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    assert [r["value"] for r in J.missing_values(df, "c", ["a", "z", "it's"]).collect()] == ["z", "it's"]
    assert J.literal_table(spark, [], ["x"]).count() == 0


def test_contract_reports_every_failing_rule(spark):
    df = spark.createDataFrame([("wales-only", -1), ("scotland", 3)], "division string, n bigint")
    contract = I.Contract(
        "c",
        (I.Field("division", None, checks=(I.isin("division", ["scotland"]),)), I.Field("n", None, checks=(I.ge("n", 0),))),
    )
    with pytest.raises(I.ContractError) as e:
        I.apply_contract(df, contract)
    assert "division isin" in str(e.value) and "n >= 0" in str(e.value) and "wales-only" in str(e.value)


def test_contract_strict_columns_and_types(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1, "x")], "a bigint, extra string")
    with pytest.raises(I.ContractError, match="unexpected columns"):
        I.check_schema(df, I.Contract("c", (I.Field("a", T.LongType()),)))
    with pytest.raises(I.ContractError, match="type of a"):
        I.check_schema(df.select("a"), I.Contract("c", (I.Field("a", T.StringType()),)))
    coerced = I.check_schema(df.select("a"), I.Contract("c", (I.Field("a", T.StringType()),), coerce=True))
    assert coerced.schema["a"].dataType == T.StringType()


def test_components_sum_to_total(spark):
    rows = [("g1", "DF", 1.0), ("g1", "NC", 2.0), ("g1", "Total_GB average", 3.0 + 1e-8), ("g2", "DF", 1.0), ("g2", "Total_GB average", 1.0 + 1e-5), ("g3", "DF", None)]
    df = spark.createDataFrame(rows, "g string, `Tariff component` string, value double")
    ok = {r["g"]: r["ok"] for r in I.components_sum_to_total(df, ["g"]).collect()}
    assert ok == {"g1": True, "g2": False, "g3": True}


def test_grid_marker_slice_and_nth(spark):
    cells = [("s", r, 0, v) for r, v in enumerate(["title", "A", "x", "Total inc VAT", "y", "Total inc VAT", "z"])]
    grid = spark.createDataFrame(cells, "sheet_id string, row_idx int, col_idx int, value string")
    starts = G.find_marker_row(grid, G.cell_equals("A"), out="start_row")
    nth = G.nth_marker_after(grid, G.cell_equals("Total inc VAT"), 2, starts=starts).first()
    assert (nth["marker_row"], nth["found"]) == (5, 2)
    short = G.nth_marker_after(grid, G.cell_equals("Total inc VAT"), 3, starts=starts)
    with pytest.raises(G.GridError, match="found only"):
        G.require_nth(short, 3, "Total inc VAT")


def test_ffill_right_densifies_and_fills_from_left(spark):
    cells = [("s", 0, 0, "Gas"), ("s", 0, 3, "Dual"), ("s", 1, 1, "x"), ("s", 1, 2, "y")]
    grid = spark.createDataFrame(cells, "sheet_id string, row_idx int, col_idx int, value string")
    out = {(r["row_idx"], r["col_idx"]): r["value"] for r in G.ffill_right(grid).collect()}
    assert out == {(0, 0): "Gas", (0, 1): "Gas", (0, 2): "Gas", (0, 3): "Dual", (1, 1): "x", (1, 2): "y", (1, 3): "y"}


def test_drop_empty_renumbers(spark):
    cells = [("s", 2, 5, "a"), ("s", 7, 9, "b"), ("s", 7, 5, None)]
    grid = spark.createDataFrame(cells, "sheet_id string, row_idx int, col_idx int, value string")
    assert sorted((r["row_idx"], r["col_idx"], r["value"]) for r in G.drop_empty(grid).collect()) == [(0, 0, "a"), (1, 1, "b")]


def test_apply_notes(spark):
    df = spark.createDataFrame([("2024 Q1 [note 2]", 5), ("2024 Q2", 6)], "`Installation quarter` string, `Total [note 1]` int")
    notes = spark.createDataFrame([("note 1", "Col note."), ("note 2", "Row note.")], "note_ref string, note_text string")
    out = {r["Installation quarter"]: r["Notes"] for r in G.apply_notes(df, notes, "Installation quarter").collect()}
    assert out == {"2024 Q1": " Col note. Row note.", "2024 Q2": " Col note. "}
    assert "Total" in G.apply_notes(df, notes, "Installation quarter").columns


def test_dense_renumber_across_buckets(spark):
    rnd = random.Random(3)
    rows = sorted({rnd.randint(0, 500) for _ in range(120)})
    df = spark.createDataFrame([("s", r) for r in rows] + [("t", 7), ("t", 3)], "sheet_id string, row_idx int")
    got = {(r["sheet_id"], r["row_idx"]): r["__new"] for r in G.dense_renumber(df, ["sheet_id"], "row_idx", bucket=16).collect()}
    assert got == {**{("s", r): i for i, r in enumerate(rows)}, ("t", 3): 0, ("t", 7): 1}


def test_width_renumber_dense_per_key(spark):
    """Duplicate and NULL column numbers; ranks are dense per key and agree with dense_renumber."""
    cells = [("s", 9), ("s", 2), ("s", 9), ("s", 40), ("t", 5), ("t", None), ("u", 0)]
    df = spark.createDataFrame(cells, "sheet_id string, col_idx int")
    got = {(r["sheet_id"], r["col_idx"]): r["__new"] for r in G.width_renumber(df, ["sheet_id"], "col_idx").collect()}
    assert got == {("s", 2): 0, ("s", 9): 1, ("s", 40): 2, ("t", 5): 0, ("u", 0): 0}
    assert got == {(r["sheet_id"], r["col_idx"]): r["__new"] for r in G.dense_renumber(df, ["sheet_id"], "col_idx", bucket=8).collect()}


def test_freshness_and_url_month_rules(spark):
    import datetime as dt

    df = spark.createDataFrame(
        [(dt.datetime(2025, 8, 1), "https://x.org/2025-11/f.xlsx"), (dt.datetime(2025, 7, 31), "https://x.org/2025-10/f.xlsx"), (None, "https://x.org/f.xlsx"), (dt.datetime(2026, 3, 1), None)],
        "d timestamp_ntz, url string",
    )
    asof = F.lit("2025-11-21 00:00:00").cast("timestamp_ntz")
    counts = {r["rule"]: r["violations"] for r in I.violation_counts(df, [I.fresh_within_months("d", asof), I.url_month_is("url", F.lit("2025-11"))]).collect()}
    assert counts == {"d within 3 months": 2, "url month": 2}


def test_lookup_join_is_dict_like(spark):
    """Missing key -> NULL, duplicate lookup keys collapse to one entry, row count unchanged."""
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    lk = spark.createDataFrame([("a", "x", 1), ("a", "w", 9), ("b", "y", 2), (None, "z", 3)], "key string, v string, n int")
    out = J.lookup_join(df, lk, "k", "key", ["v", "n"])
    assert out.columns == ["id", "k", "v", "n"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", "w", 9), (2, "b", "y", 2), (3, None, None, None)]


def test_between_join_bounds(spark):
    df = spark.createDataFrame([(1, 0), (1, 5), (1, 10), (1, 11), (2, 100)], "k int, x int")
    b = spark.createDataFrame([(1, 5, 10), (2, 50, None)], "bk int, lo int, hi int")
    inc = J.between_join(df, b, [("k", "bk")], "x", "lo", "hi")
    assert sorted((r["k"], r["x"]) for r in inc.collect()) == [(1, 5), (1, 10), (2, 100)]
    half = J.between_join(df, b, [("k", "bk")], "x", "lo", "hi", hi_inclusive=False)
    assert sorted((r["k"], r["x"]) for r in half.collect()) == [(1, 5), (2, 100)]


def test_drop_empty_shuffles_a_cell_once(spark):
    """Missing and negative columns, repeated cells and NULL keys, rows and columns; one exchange holds values."""
    import random

    rng = random.Random(4)
    pick = lambda *xs: rng.choice([None, *xs, *xs])
    rows = [(pick("s", "t", "u"), pick(*range(-3, 40, 3)), pick(*(range(-2, 9, 3) if n % 2 else range(6))), pick("v", ""), n) for n in range(900)]
    rows += [("full", r, c, f"{r}.{c}", 0) for r in range(5) for c in range(4)]
    grid = spark.createDataFrame(rows, "sheet_id string, row_idx int, col_idx int, value string, more int").repartition(5)
    cells = [r for r in rows if r[3] is not None]
    place = lambda s, k, x: sorted({r[k] for r in cells if r[0] == s and r[k] is not None}).index(x)
    want = [(s, place(s, 1, r), place(s, 2, c), v, n) for s, r, c, v, n in cells if None not in (s, r, c)]
    out = G.drop_empty(grid, bucket=4)
    assert sorted(map(tuple, out.collect())) == sorted(want) and out.schema["row_idx"].dataType == out.schema["col_idx"].dataType == grid.schema["row_idx"].dataType
    plan = spark._jvm.PythonSQLUtils.explainString(G.drop_empty(grid)._jdf.queryExecution(), "formatted")
    held = [b for b in plan.split("\n\n") if ") Exchange\n" in b and "hashpartitioning" in b and "value#" in b.split("Input", 1)[1].split("\n")[0]]
    assert len(held) == 1
