"""Property tests: Spark operators against brute-force Python on random small inputs."""

from __future__ import annotations

import json
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheetmill.operators import grid as G
from sheetmill.operators import reshape as D
from sheetmill.operators.timeseries import period_over_period
from sheetmill.sources import files, manifest

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.one_of(st.none(), st.integers(-3, 5).map(float))
series = st.dictionaries(st.sampled_from(["a", "b", "c"]), st.lists(values, min_size=1, max_size=12), min_size=1, max_size=3)


def brute_pop(vals):
    """change and padded percent change, written out step by step."""
    out, last, prev, prev_f = [], None, None, None
    for i, v in enumerate(vals):
        f = v if v is not None else last
        change = None if (i == 0 or v is None or prev is None) else v - prev
        if i == 0 or f is None or prev_f is None:
            pct = None
        elif prev_f == 0:
            pct = None if f == 0 else math.copysign(math.inf, f)
        else:
            pct = (f / prev_f - 1) * 100
        out.append((change, pct))
        prev, prev_f, last = v, f, f
    return out


@SETTINGS
@given(series, st.integers(1, 5))
def test_period_over_period_matches_brute_force(spark, data, width):
    rows = [(k, t, v) for k, vs in data.items() for t, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    for split in (None, F.floor(F.col("t") / width)):
        got = {(r["k"], r["t"]): (r["d"], r["p"]) for r in period_over_period(df, ["k"], ["t"], "v", "d", "p", decimals=None, split_by=split).collect()}
        for k, vs in data.items():
            for t, (d, p) in enumerate(brute_pop(vs)):
                gd, gp = got[(k, t)]
                assert gd == d
                assert (gp is None and p is None) or (gp is not None and p is not None and (gp == p or abs(gp - p) < 1e-9))


cells = st.dictionaries(st.tuples(st.integers(0, 6), st.integers(0, 6)), st.sampled_from(["x", "y", "z"]), min_size=1, max_size=20)


@SETTINGS
@given(cells)
def test_ffill_right_and_drop_empty_match_brute_force(spark, grid_cells):
    df = spark.createDataFrame([("s", r, c, v) for (r, c), v in grid_cells.items()], "sheet_id string, row_idx int, col_idx int, value string")
    cols = sorted({c for _, c in grid_cells})
    expected = {}
    for r in {r for r, _ in grid_cells}:
        last = None
        for c in cols:
            last = grid_cells.get((r, c), last)
            if last is not None:
                expected[(r, c)] = last
    assert {(x["row_idx"], x["col_idx"]): x["value"] for x in G.ffill_right(df).collect()} == expected
    rows_rank = {r: i for i, r in enumerate(sorted({r for r, _ in grid_cells}))}
    cols_rank = {c: i for i, c in enumerate(cols)}
    renum = {(rows_rank[r], cols_rank[c]): v for (r, c), v in grid_cells.items()}
    assert {(x["row_idx"], x["col_idx"]): x["value"] for x in G.drop_empty(df, bucket=2).collect()} == renum


pivot_rows = st.lists(st.tuples(st.sampled_from(["p", "q", None]), st.sampled_from(["Nil", "Typ", None]), values), min_size=1, max_size=15)


@SETTINGS
@given(pivot_rows)
def test_pivot_mean_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, c string, v double")
    got = {r["k"]: (r["Nil"], r["Typ"]) for r in D.pivot_mean(df, ["k"], "c", "v", ["Nil", "Typ"]).collect()}
    groups: dict = {}
    for k, c, v in rows:
        if k is None or c is None or v is None:
            continue
        groups.setdefault(k, {}).setdefault(c, []).append(v)
    expected = {k: tuple((sum(g[c]) / len(g[c])) if c in g else None for c in ("Nil", "Typ")) for k, g in groups.items()}
    assert got == expected


def test_read_nested_json_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"links": {"documents": [{"web_url": "u1", "public_updated_at": "2025-01-02"}]}}, indent=2))
    df = files.read_nested_json(spark, str(tmp_path), "links struct<documents: array<struct<web_url: string, public_updated_at: string>>>")
    assert df.select(F.col("links.documents")[0]["web_url"].alias("u")).first()["u"] == "u1"
    try:
        files.read_nested_json(spark, str(tmp_path / "missing"), "x string")
        raise AssertionError("expected SourceNotFound")
    except files.SourceNotFound:
        pass


def test_landing_manifest(spark, tmp_path):
    (tmp_path / "annex.xlsx").write_bytes(b"12345")
    (tmp_path / "other.txt").write_bytes(b"1")
    m = manifest.landing_manifest(spark, str(tmp_path), "Publisher", "https://example.org/c", "1.0", glob="*.xlsx").first()
    assert (m["filename"], m["size_bytes"], m["publisher"]) == ("annex.xlsx", 5, "Publisher")
    assert m["citation"] == "Source: Publisher, annex.xlsx. https://example.org/c."
