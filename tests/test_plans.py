"""End to end: handmade workbooks / JSON -> cell grid -> silver -> gold, and the medallion sink."""

from __future__ import annotations

import json

import pytest
from conftest import SAMPLE_HOLIDAYS
from fixtures import NORMALISED, component_values, notes_sheet, region_sheet, tariff_sheet, type_sheet
from pyspark.sql import functions as F
from xlsx_util import write_xlsx

from sheetmill.operators import grid as G
from sheetmill.operators.contracts import Contract, ContractError, Field, isin, require_components_sum
from sheetmill.plans import bank_holidays as B
from sheetmill.plans import config as C
from sheetmill.plans import heat_pumps as H
from sheetmill.plans import price_cap as K
from sheetmill.sources import files, medallion, workbook


def workbook_cells(spark, tmp_path, sheets, name="book.xlsx"):
    path = tmp_path / name
    write_xlsx(str(path), sheets)
    return workbook.read_workbook_cells(spark, str(tmp_path))


# ------------------------------------------------------------------ A1 workbook decoding


def test_decode_workbook_cells(spark, tmp_path):
    sheets = {"First": {(0, 0): "title", (1, 2): 3.0, (2, 27): "AB col", (3, 1): 2.5, (4, 0): True}, "Second": {(0, 0): "x"}}
    cells = workbook_cells(spark, tmp_path, sheets)
    got = {(r["sheet_name"], r["row_idx"], r["col_idx"]): r["value"] for r in cells.collect()}
    assert got == {("First", 0, 0): "title", ("First", 1, 2): "3", ("First", 2, 27): "AB col", ("First", 3, 1): "2.5", ("First", 4, 0): "True", ("Second", 0, 0): "x"}


def test_decode_missing_sheet_names_file(spark, tmp_path):
    write_xlsx(str(tmp_path / "b.xlsx"), {"Only": {(0, 0): "x"}})
    with pytest.raises(Exception, match="Nope"):
        workbook.read_workbook_cells(spark, str(tmp_path), ["Nope"]).collect()


# ------------------------------------------------------------------ K8/K9 silver, K1-K6 gold


@pytest.fixture
def tariff_grid(spark, tmp_path):
    cells = workbook_cells(spark, tmp_path, {"1c Consumption adjusted levels": tariff_sheet(), "Other": {(0, 0): "ignored"}})
    return workbook.sheet_grid(cells, "1c Consumption adjusted levels")


def test_tidy_tariff_tables(tariff_grid):
    tidy = K.tidy_tariff_tables(tariff_grid)
    rows = tidy.collect()
    assert len(rows) == 3 * (3 * 2 * 3 * 3 + 2 * 4 * 3)  # 3 payments x (3 fuels x 18 + dual 24)
    assert {r[C.PERIOD_COL] for r in rows} == set(NORMALISED)
    pick = [r for r in rows if r[K.PAYMENT] == "PPM" and r[K.FUEL] == "Gas" and r[K.CONSUMPTION] == C.TYPICAL and r[K.COMPONENT] == "NC" and r[C.PERIOD_COL] == NORMALISED[1]]
    assert len(pick) == 1 and float(pick[0]["value"]) == component_values(2, 2, 1, C.TYPICAL)["NC"]


def test_blank_number_filled_from_left(spark, tmp_path):
    cells = workbook_cells(spark, tmp_path, {"s": tariff_sheet(blank_cell=(0, 2, C.NIL, "DF", 1))})
    tidy = K.tidy_tariff_tables(workbook.sheet_grid(cells, "s"))
    pick = tidy.where((F.col(f"`{K.PAYMENT}`") == C.PAYMENT_METHODS[0]) & (F.col(K.FUEL) == "Gas") & (F.col(K.CONSUMPTION) == C.NIL) & (F.col(f"`{K.COMPONENT}`") == "DF") & (F.col(f"`{C.PERIOD_COL}`") == NORMALISED[1])).collect()
    assert float(pick[0]["value"]) == component_values(0, 2, 0, C.NIL)["DF"]  # the previous period's number


def test_single_total_inc_vat_raises(spark, tmp_path):
    cells = workbook_cells(spark, tmp_path, {"s": tariff_sheet(total_inc_vat_rows=1)})
    with pytest.raises(G.GridError, match="Total inc VAT"):
        K.tidy_tariff_tables(workbook.sheet_grid(cells, "s"))


def test_no_total_inc_vat_rows_raises(spark, tmp_path):
    """A section start with no total row at all after it is reported (found only 0), not dropped."""
    cells = workbook_cells(spark, tmp_path, {"s": tariff_sheet(total_inc_vat_rows=0)})
    with pytest.raises(G.GridError, match="found only 0"):
        K.tidy_tariff_tables(workbook.sheet_grid(cells, "s"))


def test_missing_section_raises(spark, tmp_path):
    cells = workbook_cells(spark, tmp_path, {"s": tariff_sheet(payments=C.PAYMENT_METHODS[:2])})
    with pytest.raises(G.GridError, match="payment method"):
        K.tidy_tariff_tables(workbook.sheet_grid(cells, "s"))


def test_silver_and_gold(tariff_grid):
    silver = K.silver_levels(tariff_grid, {"price_cap_period": "1 April to 30 June 2026", "publisher": "regulator"}, "1c Consumption adjusted levels")
    row = silver.where(F.col(f"`{C.PERIOD_COL}`") == NORMALISED[0]).first()
    assert str(row[K.START]) == "2025-04-01 00:00:00" and str(row[K.END]) == "2025-06-30 00:00:00"
    assert str(row[K.INTERVAL]["right"]) == "2025-06-30 23:59:59"
    assert row["metadata"]["excel_sheet_name"] == "1c Consumption adjusted levels"
    with_vat = K.add_derived_component(silver)
    assert with_vat.where(F.col(f"`{K.COMPONENT}`") == C.TOTAL_INC_VAT).count() == 0
    assert with_vat.where(F.col(f"`{K.COMPONENT}`") == "VAT").count() == silver.where(F.col(f"`{K.COMPONENT}`") == C.TOTAL).count()
    require_components_sum(with_vat, [K.CONSUMPTION, K.FUEL, K.PAYMENT, K.START])
    levels = K.levels_with_vat(with_vat, {"price_cap_period": "1 April to 30 June 2026"})
    r = levels.where((F.col(f"`{K.COMPONENT}`") == "DF") & (F.col(K.FUEL) == "Gas") & (F.col(f"`{K.PAYMENT}`") == "PPM") & (F.col(K.CONSUMPTION) == C.NIL)).orderBy(K.START).collect()
    assert [x["change_from_previous_period"] for x in r] == [None, 1.0, 1.0]
    assert r[1]["pct_change_from_previous_period"] == round((13.0 / 12.0 - 1) * 100, 2)
    assert r[0]["Component category"] == "Wholesale"
    rates = K.component_rates(with_vat)
    assert rates.where(F.col(K.FUEL) == C.DUAL_FUEL).count() == 0
    require_components_sum(rates, [K.FUEL, K.PAYMENT, K.START, "Type"])
    ratio = K.price_ratio(K.total_unit_rates(rates))
    assert ratio.count() == 3 * 3 and ratio.where(F.col("value").isNull()).count() == 0
    bill = K.annual_bill_contributions(with_vat)
    require_components_sum(bill, [K.FUEL, K.PAYMENT, K.START, "Type"])


def test_gold_worked_values(spark):
    rows = [("PPM", "Gas", C.TOTAL, "Apr 2025 - Jun 2025", c, v) for c, v in ((C.NIL, 365.0), (C.TYPICAL, 1515.0))]
    rows += [("PPM", f, C.TOTAL, "Apr 2025 - Jun 2025", C.NIL, 1.0) for f in C.BENCHMARK_CONSUMPTION if f != "Gas"]
    df = spark.createDataFrame(rows, f"`{K.PAYMENT}` string, `{K.FUEL}` string, `{K.COMPONENT}` string, `{C.PERIOD_COL}` string, `{K.CONSUMPTION}` string, value double")
    df = K.period_dates(df)
    rates = {(r[K.FUEL], r["Type"]): (r["value"], r["Unit"]) for r in K.component_rates(df).collect()}
    assert rates[("Gas", "Standing charge")] == (100.0, "p/day")
    assert rates[("Gas", "Unit price")][0] == pytest.approx(10.0)
    # typical missing: (NULL - nil) is NULL, then filled with 0; standing charge from nil alone
    assert rates[("Electricity: Single-Rate Metering Arrangement", "Unit price")][0] == 0.0
    assert rates[("Electricity: Single-Rate Metering Arrangement", "Standing charge")][0] == pytest.approx(100.0 / 365.0)
    bill = {(r[K.FUEL], r["Type"]): r["value"] for r in K.annual_bill_contributions(df).collect()}
    assert bill[("Gas", "Standing charge")] == 365.0 and bill[("Gas", "Consumption-based cost")] == 1150.0
    with pytest.raises(ValueError, match="Gas"):
        K.component_rates(df.where(F.col(K.FUEL) != "Gas"))


def test_gas_price_zero_gives_null_ratio(spark):
    rows = [("PPM", f, C.TOTAL, "Unit price", "Apr 2025 - Jun 2025", v) for f, v in (("Gas", 0.0), ("Electricity: Single-Rate Metering Arrangement", 20.0))]
    df = spark.createDataFrame(rows, f"`{K.PAYMENT}` string, `{K.FUEL}` string, `{K.COMPONENT}` string, Type string, `{C.PERIOD_COL}` string, value double")
    df = K.period_dates(df)
    assert K.price_ratio(K.total_unit_rates(df)).first()["value"] is None


# ------------------------------------------------------------------ K10 / K11


@pytest.fixture
def heat_cells(spark, tmp_path):
    return workbook_cells(spark, tmp_path, {"Notes": notes_sheet(), "Table 1.1": type_sheet(), "Table 1.2": region_sheet()})


META = {"publisher": "Department", "filename": "hp.xlsx", "publication_date": "21 November 2025", "page_url": "https://example.org/hp"}


def test_heat_pumps_by_type(heat_cells):
    notes = G.notes_lookup(workbook.sheet_grid(heat_cells, "Notes")).drop("sheet_id")
    out = H.heat_pumps_by_type(workbook.sheet_grid(heat_cells, "Table 1.1"), notes, META)
    assert out.columns == ["installation_quarter", "installation_quarter_start", "installation_quarter_end", "notes", "type", "value", "metadata"]
    rows = out.collect()
    assert len(rows) == 9 and {r["type"] for r in rows} == set(C.TYPE_VALUE_VARS)
    q1 = [r for r in rows if r["installation_quarter"] == "2024 Q1"]
    assert q1[0]["notes"] == " Figures are provisional. Includes late returns."
    assert [r for r in rows if r["installation_quarter"] == "2024 Q2"][0]["notes"] == " Figures are provisional. "
    assert str(q1[0]["installation_quarter_end"]) == "2024-03-31 00:00:00"
    total = [r["value"] for r in q1 if r["type"] == "Total heat pump installations"]
    assert total == [15]
    meta = q1[0]["metadata"]
    assert meta["data_source"] == "Source: Department registry"
    assert meta["citation"] == "Source: Department, hp.xlsx. Table 1.1 Heat pump installations by type. Published 21 November 2025, https://example.org/hp."


def test_heat_pumps_by_region(heat_cells):
    notes = G.notes_lookup(workbook.sheet_grid(heat_cells, "Notes")).drop("sheet_id")
    out = H.heat_pumps_by_region(workbook.sheet_grid(heat_cells, "Table 1.2"), notes, META)
    rows = out.collect()
    assert len(rows) == 2 * len(C.REGION_VALUE_VARS)
    by = {(r["installation_quarter"], r["country_or_region"]): r for r in rows}
    assert by[("2024 Q1", "London")]["area_code"] == "E12000007" and by[("2024 Q1", "London")]["geographic_level"] == "Regional"
    assert by[("2024 Q2", "England and Wales")]["area_code"] == "N/A"
    assert by[("2024 Q2", "Unknown")]["value"] == 100 + len(C.REGION_VALUE_VARS) - 1


def test_notes_stay_with_their_workbook(spark, tmp_path):
    """Two workbooks whose notes differ under the same numbers, one with a repeated number."""
    notes = notes_sheet()
    other = {k: "Other text." if isinstance(v, str) and v.endswith("provisional.") else v for k, v in notes.items()}
    assert other != notes
    write_xlsx(str(tmp_path / "a.xlsx"), {"Notes": notes, "Table 1.1": type_sheet()})
    write_xlsx(str(tmp_path / "b.xlsx"), {"Notes": other, "Table 1.1": type_sheet()})
    cells = workbook.read_workbook_cells(spark, str(tmp_path))
    out = H.heat_pumps_by_type(workbook.sheet_grid(cells, "Table 1.1"), G.notes_lookup(workbook.sheet_grid(cells, "Notes")), META, keep_sheet=True)
    got = {(r["sheet_id"][-6:], r["notes"]) for r in out.where("installation_quarter = '2024 Q2'").collect()}
    assert got == {("a.xlsx", " Figures are provisional. "), ("b.xlsx", " Other text. ")}
    grid = spark.createDataFrame([(0, 0, "Note number"), (0, 1, "Note text"), (1, 0, "note 1"), (1, 1, "old"), (2, 0, "note 1"), (2, 1, "new")], "row_idx int, col_idx int, value string")
    assert [tuple(r) for r in G.notes_lookup(grid.withColumn("sheet_id", F.lit("s"))).collect()] == [("s", "note 1", "new")]


def test_tariff_sheets_of_two_workbooks_stay_apart(spark, tmp_path):
    for name in ("a.xlsx", "b.xlsx"):
        write_xlsx(str(tmp_path / name), {"s": tariff_sheet()})
    tidy = K.tidy_tariff_tables(workbook.sheet_grid(workbook.read_workbook_cells(spark, str(tmp_path)), "s"))
    counts = {r["sheet_id"][-6:]: r["count"] for r in tidy.groupBy("sheet_id").count().collect()}
    assert counts == {"a.xlsx": 234, "b.xlsx": 234}


def test_date_cells_and_bounded_decoder(tmp_path):
    """Date styles give ISO dates; the decoder holds one row, so its peak does not follow the sheet."""
    import tracemalloc
    import zipfile

    def peak(rows):
        path = str(tmp_path / f"{rows}.xlsx")
        write_xlsx(path, {"s": {(r, c): r + 0.5 for r in range(rows) for c in range(4)}})
        content = open(path, "rb").read()
        tracemalloc.start()
        n = sum(1 for _ in workbook.iter_cells(content))
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert n == 4 * rows
        return top

    assert peak(20_000) < 2 * peak(2_000)
    path = str(tmp_path / "d.xlsx")
    write_xlsx(path, {"s": {(0, 0): 45983, (0, 1): 45983.5, (0, 2): 45983}})
    styles = '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><numFmts><numFmt numFmtId="164" formatCode="[Red]dd/mm/yyyy"/><numFmt numFmtId="165" formatCode="&quot;day&quot; 0.0"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>'
    with zipfile.ZipFile(path) as zf:
        parts = {n: zf.read(n) for n in zf.namelist()}
    sheet = parts["xl/worksheets/sheet1.xml"]
    for ref, style in ((b"A1", b"1"), (b"B1", b"2"), (b"C1", b"3")):
        sheet = sheet.replace(b'r="' + ref + b'"', b'r="' + ref + b'" s="' + style + b'"')
    with zipfile.ZipFile(path, "w") as zf:
        for n, data in {**parts, "xl/worksheets/sheet1.xml": sheet, "xl/styles.xml": styles.encode()}.items():
            zf.writestr(n, data)
    assert [v for *_, v in workbook.iter_cells(open(path, "rb").read())] == ["2025-11-22", "2025-11-22 12:00:00", "45983"]


def test_heat_pumps_wrong_header_fails(spark, tmp_path):
    sheet = type_sheet()
    sheet[(4, 2)] = "Hybrid installations"
    cells = workbook_cells(spark, tmp_path, {"Notes": notes_sheet(), "Table 1.1": sheet})
    notes = G.notes_lookup(workbook.sheet_grid(cells, "Notes")).drop("sheet_id")
    with pytest.raises(ContractError, match="Hybrid"):
        H.heat_pumps_by_type(workbook.sheet_grid(cells, "Table 1.1"), notes, META)



def test_heat_pumps_bad_quarter_and_blank_notes_fail(spark, tmp_path):
    """An unparseable quarter is reported with the row count; a Table 1.1 whose notes all
    stay blank (no tag resolves) fails the non-blank check."""
    cells = workbook_cells(spark, tmp_path, {"Notes": notes_sheet(), "Table 1.1": type_sheet(values=((2024, 1, 10, 5), (2024, 2, 12, 6)))})
    grid = workbook.sheet_grid(cells, "Table 1.1").withColumn("value", F.regexp_replace("value", "^2024 Q2$", "2024 Q7"))
    notes = G.notes_lookup(workbook.sheet_grid(cells, "Notes")).drop("sheet_id")
    with pytest.raises(ContractError, match=r"1 row\(s\), e.g. \['2024 Q7'\]"):
        H.heat_pumps_by_type(grid, notes, META)
    no_notes = notes.where(F.lit(False))
    with pytest.raises(G.GridError, match="entirely empty"):
        H.heat_pumps_by_type(workbook.sheet_grid(cells, "Table 1.1"), no_notes, META)

# ------------------------------------------------------------------ K12 + medallion


def test_bank_holidays_end_to_end(spark, tmp_path, root):
    bronze = tmp_path / "bronze"
    bronze.mkdir()
    (bronze / "bank-holidays.json").write_text(json.dumps(SAMPLE_HOLIDAYS))
    out = B.run_silver(spark, str(bronze), root, "2025-06-01 09:30:00")
    assert out["historical"].endswith("historical/bank_holidays")
    latest = files.read_latest(spark, root, "silver", "example", "bank_holidays")
    rows = latest.collect()
    assert len(rows) == 3 and {r["year"] for r in rows} == {2031}
    assert latest.columns == ["division", "title", "date", "notes", "bunting", "year"]
    hist = files.read_historical(spark, root, "silver", "example", "bank_holidays")
    assert {r["ingested"] for r in hist.select("ingested").distinct().collect()} == {"2025-06-01T09-30-00Z"}


def test_bank_holidays_rejects_unknown_division(spark, tmp_path):
    bad = {"wales-only": {"division": "wales-only", "events": [{"title": "Invented", "date": "2025-01-01", "notes": "", "bunting": True}]}}
    (tmp_path / "b.json").write_text(json.dumps(bad))
    with pytest.raises(ContractError, match="wales-only"):
        B.silver_bank_holidays(B.read_documents(spark, str(tmp_path)))


def test_publish_fails_closed_and_versions(spark, root):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v bigint")
    medallion.publish(df, root, "gold", "d", "t", "period", "p1")
    medallion.publish(df.where("v = 2"), root, "gold", "d", "t", "period", "p2")
    assert files.read_latest(spark, root, "gold", "d", "t").count() == 1
    assert medallion.read_version(spark, root, "gold", "d", "t", "period", "p1").count() == 2
    contract = Contract("t", (Field("k", None, checks=(isin("k", ["a"]),)), Field("v", None)))
    with pytest.raises(ContractError):
        medallion.publish(df, root, "gold", "d", "t", "period", "p3", contract=contract)
    assert files.read_latest(spark, root, "gold", "d", "t").count() == 1  # latest untouched
    assert medallion.read_version(spark, root, "gold", "d", "t", "period", "p3").count() == 0
    with pytest.raises(files.SourceNotFound):
        files.read_latest(spark, root, "gold", "d", "missing")


def test_sheet_facts_checked_in_one_job(spark):
    """Bad title and missing source are both reported by the one facts check."""
    from sheetmill.operators.contracts import ContractError
    from sheetmill.plans import heat_pumps as HP

    facts = spark.createDataFrame([("a", "Table 1.1 x", "Source: y"), ("b", "Table 9", None)], "sheet_id string, title string, source string")
    with pytest.raises(ContractError) as e:
        HP._require_starts(facts, {"title": "Table 1.1", "source": "Source:"})
    assert "Table 9" in str(e.value) and "source" in str(e.value)
    HP._require_starts(facts.where("sheet_id = 'a'"), {"title": "table 1.1", "source": "Source:"})
