"""Stage runs end to end: land a workbook (bronze) -> silver -> gold, read back published tables."""

from __future__ import annotations

import json

import pytest
from fixtures import notes_sheet, region_sheet, tariff_sheet, type_sheet
from pyspark.sql import functions as F
from xlsx_util import write_xlsx

from sheetmill.operators.contracts import ContractError
from sheetmill.plans import stages as S
from sheetmill.sources import files, medallion


def land(spark, tmp_path, root, dataset, sheets, metadata):
    path = tmp_path / "landing" / "book.xlsx"
    path.parent.mkdir(parents=True, exist_ok=True)
    write_xlsx(str(path), sheets)
    raw = spark.read.format("binaryFile").load(str(path.parent)).select("path", "content")
    meta = F.create_map(*[F.lit(x) for kv in metadata.items() for x in kv])
    medallion.land_raw(raw.withColumn("metadata", meta), root, dataset, "ingested", "2026-02-25T00-00-00Z")


def test_price_cap_stages(spark, tmp_path, root):
    meta = {"price_cap_period": "1 April to 30 June 2026", "publisher": "Regulator", "file_name": "book.xlsx"}
    land(spark, tmp_path, root, S.PRICE_CAP, {S.LEVELS_SHEET: tariff_sheet()}, meta)
    out = S.price_cap_silver(spark, root)
    assert out["historical"].endswith("1c_consumption_adjusted_levels")
    hist = files.read_historical(spark, root, "silver", S.PRICE_CAP, "1c_consumption_adjusted_levels")
    assert {r["period"] for r in hist.select("period").distinct().collect()} == {"2026-04-01_to_2026-06-30"}
    gold = S.price_cap_gold(spark, root)
    assert set(gold) == {"1c_consumption_adjusted_levels_with_vat", "tariff_component_rates", "price_ratios", "annual_bill_fixed_and_variable_component_contributions"}
    ratios = files.read_latest(spark, root, "gold", S.PRICE_CAP, "price_ratios")
    assert ratios.count() == 9 and ratios.first()["metadata"]["price_cap_period"] == "1 April to 30 June 2026"


def test_price_cap_unknown_period_rejected(spark, tmp_path, root):
    land(spark, tmp_path, root, S.PRICE_CAP, {S.LEVELS_SHEET: tariff_sheet()}, {"price_cap_period": "1 April to 30 June 2019"})
    with pytest.raises(ContractError, match="unrecognised"):
        S.price_cap_silver(spark, root)


def test_heat_pump_stage(spark, tmp_path, root):
    meta = {"publisher": "Department", "filename": "hp.xlsx", "publication_date": "21 November 2025", "page_url": "https://example.org/hp"}
    land(spark, tmp_path, root, S.HEAT_PUMPS, {"Notes": notes_sheet(), "Table 1.1": type_sheet(), "Table 1.2": region_sheet()}, meta)
    S.heat_pumps_silver(spark, root)
    t11 = files.read_historical(spark, root, "silver", S.HEAT_PUMPS, "table_1_1")
    assert t11.count() == 9 and {str(r["published"]) for r in t11.select("published").distinct().collect()} == {"2025-11-21"}  # discovered as DATE
    assert files.read_latest(spark, root, "silver", S.HEAT_PUMPS, "table_1_2").count() == 32


def listing(spark, tmp_path, name, sheets):
    folder = tmp_path / "downloads"
    folder.mkdir(parents=True, exist_ok=True)
    write_xlsx(str(folder / name), sheets)
    (folder / "other.xlsx").write_bytes(b"not read")
    return spark.read.format("binaryFile").load(str(folder))


def test_price_cap_from_page_to_gold(spark, tmp_path, root):
    """Collection page and downloads -> bronze -> silver -> gold; a stale page is refused."""
    found = listing(spark, tmp_path, "annex_9.xlsx", {S.LEVELS_SHEET: tariff_sheet()})
    html = "<h2>About</h2><h3>Cap levels: 1 April to 30 June 2026</h3><a href='/x'>Other</a><a href='/files/2026-02/annex_9.xlsx'>Annex 9 - levels</a>"
    pages = spark.createDataFrame([("https://example.org/cap/", html)], "url string, html string")
    S.price_cap_bronze(spark, pages, found, root, "Regulator", "Annex 9", "2026-03-01 00:00:00", version="1.0")
    landed = files.read_historical(spark, root, "bronze", S.PRICE_CAP, "file").first()
    assert (landed["filename"], landed["period"]) == ("annex_9.xlsx", "2026-04-01_to_2026-06-30")
    assert landed["metadata"]["file_url"] == "https://example.org/files/2026-02/annex_9.xlsx"
    assert landed["metadata"]["citation"] == "Source: Regulator, annex_9.xlsx, 1 April to 30 June 2026. https://example.org/cap/."
    S.price_cap_silver(spark, root)
    S.price_cap_gold(spark, root)
    assert files.read_latest(spark, root, "gold", S.PRICE_CAP, "price_ratios").first()["metadata"]["file_name"] == "annex_9.xlsx"
    for asof, what in (("2026-06-01 00:00:00", "month"), ("2026-01-01 00:00:00", "month")):
        with pytest.raises(ContractError, match=what):
            S.price_cap_bronze(spark, pages, found, root, "Regulator", "Annex 9", asof)
    old = pages.withColumn("html", F.replace("html", F.lit("1 April to 30 June"), F.lit("1 January to 31 March")))
    with pytest.raises(ContractError, match="not the latest"):
        S.price_cap_bronze(spark, old, found, root, "Regulator", "Annex 9", "2026-03-01 00:00:00")
    with pytest.raises(ContractError, match="file_url not null"):
        S.price_cap_bronze(spark, pages, found, root, "Regulator", "Annex 10", "2026-03-01 00:00:00")


def test_heat_pumps_from_release_to_silver(spark, tmp_path, root):
    found = listing(spark, tmp_path, "hp.xlsx", {"Notes": notes_sheet(), "Table 1.1": type_sheet(), "Table 1.2": region_sheet()})

    def doc(url, day):
        files_ = [{"url": url + ".ods", "content_type": "application/ods"}, {"url": url, "content_type": S.XLSX}]
        return json.dumps({"links": {"available_translations": [{"web_url": "https://example.org/" + day}]}, "details": {"attachments": files_, "change_history": [{"public_timestamp": day + "T09:30:00Z"}]}})

    rows = [("2025-08-21T09:30:00Z", doc("https://example.org/f/old.xlsx", "2025-08-21")), ("2025-11-21T09:30:00Z", doc("https://example.org/f/hp.xlsx", "2025-11-21"))]
    releases = spark.createDataFrame(rows, "public_updated_at string, doc string")
    S.heat_pumps_bronze(spark, releases, found, root, "Department", "https://example.org/c", "2026-02-01 00:00:00")
    S.heat_pumps_silver(spark, root)
    row = files.read_historical(spark, root, "silver", S.HEAT_PUMPS, "table_1_1").first()
    assert str(row["published"]) == "2025-11-21" and row["metadata"]["page_url"] == "https://example.org/2025-11-21"
    assert row["metadata"]["publication_date"] == "21 November 2025"
    with pytest.raises(ContractError, match="within 3 months"):
        S.heat_pumps_bronze(spark, releases, found, root, "Department", "https://example.org/c", "2026-03-01 00:00:00")


def test_two_landed_workbooks_are_refused(spark, root):
    raw = spark.createDataFrame([("a.xlsx", bytearray(b"1")), ("b.xlsx", bytearray(b"2"))], "path string, content binary")
    medallion.land_raw(raw, root, S.PRICE_CAP, "ingested", "v1")
    with pytest.raises(ContractError, match="one workbook"):
        S.price_cap_silver(spark, root)
