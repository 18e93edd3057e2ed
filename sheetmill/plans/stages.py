"""Stage runs per dataset: landed workbook (bronze) -> silver -> gold, published with versions.

Each function is one stage; stages hand over through published tables, so a stage can
rerun on its own.  Within a stage the build is one lazy plan; tables consumed by
several outputs (the VAT-inclusive levels feed three gold tables) are checkpointed
once to the shared folder instead of being recomputed per output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetmill.functions.dates import CAP_PERIOD_PATTERN, cap_period_key, normalise_date
from sheetmill.functions.text import basename, slugify
from sheetmill.operators import grid as G
from sheetmill.operators.aggregate import first_by
from sheetmill.operators.calendar import stale_periods, unknown_periods, url_month_is_latest
from sheetmill.operators.contracts import ContractError, fresh_within_months, has_extension, not_null, require_components_sum, validate_rules
from sheetmill.plans import config as C
from sheetmill.plans import heat_pumps as H
from sheetmill.plans import price_cap as K
from sheetmill.session import materialize
from sheetmill.sources import files, medallion, workbook
from sheetmill.sources.html import first_heading_match, first_link_containing
from sheetmill.sources.manifest import first_element_where, manifest_rows, nested_get

PRICE_CAP = "energy_price_cap_levels/annex_9"
HEAT_PUMPS = "heat_pump_deployment_statistics"
LEVELS_SHEET = "1c Consumption adjusted levels"
#: The cap period anywhere in a heading.
HEADING_PERIOD = CAP_PERIOD_PATTERN.removeprefix("^")
XLSX = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"


def _scalar(spark: SparkSession, col) -> object:
    return spark.range(1).select(col.alias("x")).first()["x"]


def latest_bronze(spark: SparkSession, root: str, dataset: str) -> tuple[DataFrame, dict[str, str]]:
    """The landed workbook as a (path, content) row, and its metadata.  A publication is one
    workbook: several in ``latest`` are an error, as their metadata and periods would mix."""
    landed = files.read_latest(spark, root, "bronze", dataset, "file")
    has_meta = "metadata" in landed.columns
    found = landed.select("filename", *(["metadata"] if has_meta else [])).limit(2).collect()
    if len(found) != 1:
        raise ContractError("landed workbook", {"expected one workbook, got": [r["filename"] for r in found]})
    metadata = dict(found[0]["metadata"] or {}) if has_meta else {}
    return landed.select(F.col("filename").alias("path"), "content"), metadata


def _labels(spark: SparkSession, period: str) -> DataFrame:
    return spark.range(1).select(F.lit(period).alias("period"))


def require_known_period(spark: SparkSession, period: str, calendar: DataFrame | None = None) -> None:
    """The period must parse and belong to the publication calendar (compared as intervals)."""
    calendar = C.publication_calendar(spark) if calendar is None else calendar
    if unknown_periods(_labels(spark, period), calendar).isEmpty():
        return
    expected = [r["period"] for r in calendar.select("period").limit(25).collect()]
    raise ContractError("price cap period", {"unrecognised": period, "expected one of": expected})


def _land_one(listing: DataFrame, manifest: dict[str, str], root: str, dataset: str, key: str, version: str) -> dict[str, str]:
    """Land the file that the manifest row names, with the row as its metadata."""
    name = manifest.get("file_name") or manifest["filename"]
    mine = listing.where(basename("path") == F.lit(name)).select("path", "content")
    n = mine.select("path").limit(2).count()
    if n != 1:
        raise ContractError("landing folder", {f"files named {name!r}": n})
    meta = F.create_map(*[F.lit(x) for kv in manifest.items() for x in kv])
    return medallion.land_raw(mine.withColumn("metadata", meta), root, dataset, key, version)


def price_cap_manifest(pages: DataFrame, publisher: str, link_text: str, ingested: str, version: str = "") -> DataFrame:
    """One row per collection page (url, html): A6 first link, A7 period heading, A11 name, A12 row."""
    period = first_heading_match("html", HEADING_PERIOD)
    found = pages.select(F.col("url").alias("collection_url"), first_link_containing("html", "url", link_text).alias("file_url"), period.alias("price_cap_period"))
    extra = {"price_cap_period": F.col("price_cap_period"), "bronze_ingest_timestamp": F.lit(ingested), "pipeline_version": F.lit(version)}
    rows = manifest_rows(found, "file_url", F.lit(publisher), F.col("collection_url"), detail=F.col("price_cap_period"), extra=extra)
    return rows.withColumnRenamed("page_url", "collection_url").withColumnRenamed("filename", "file_name")


def price_cap_bronze(
    spark: SparkSession, pages: DataFrame, listing: DataFrame, root: str, publisher: str, link_text: str, asof: str, calendar: DataFrame | None = None, version: str = ""
) -> dict[str, str]:
    """Bronze: collection page -> manifest -> calendar checks (I7-I9) -> the linked workbook of
    the landing folder (``listing``: path, content) landed under ``period=<start>_to_<end>``."""
    calendar = C.publication_calendar(spark) if calendar is None else calendar
    at = F.lit(asof).cast("timestamp_ntz")
    rows = materialize(price_cap_manifest(pages, publisher, link_text, asof, version), "manifest")
    validate_rules(rows, [not_null("file_url"), not_null("file_name"), not_null("price_cap_period"), url_month_is_latest("file_url", calendar, at)], "price cap manifest")
    stale = stale_periods(rows, calendar, at, "price_cap_period").limit(5).collect()
    if stale:
        raise ContractError("price cap period", {"not the latest of the calendar": [r["period"] for r in stale]})
    found = rows.limit(2).collect()
    if len(found) != 1:
        raise ContractError("price cap manifest", {"collection pages": len(found)})
    manifest = found[0].asDict()
    key = _scalar(spark, cap_period_key(F.lit(manifest["price_cap_period"]), strict=False))
    return _land_one(listing, manifest, root, PRICE_CAP, "period", key)


def heat_pumps_manifest(releases: DataFrame, publisher: str, collection_url: str, ingested: str, version: str = "") -> DataFrame:
    """The manifest row of the latest release (A8; equal stamps: the last document) of a table
    (public_updated_at, doc): A10 page, A9 first workbook attachment, date of the first entry
    of its change history.  ``published`` is that date as a timestamp."""
    latest = first_by(releases, [], "public_updated_at", ["doc"], descending=True, ties=["doc"])
    attachments = F.from_json(F.get_json_object("doc", "$.details.attachments"), "array<struct<url:string,content_type:string>>")
    stamp = nested_get("doc", ["details", "change_history", 0, "public_timestamp"])
    found = latest.select(
        nested_get("doc", ["links", "available_translations", 0, "web_url"]).alias("release_url"),
        first_element_where(attachments, "content_type", XLSX)["url"].alias("file_url"),
        F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).cast("timestamp_ntz").alias("published"),
    )
    day = F.date_format("published", "dd MMMM yyyy")
    extra = {"collection_url": F.lit(collection_url), "publication_date": day, "bronze_ingest_timestamp": F.lit(ingested), "pipeline_version": F.lit(version)}
    return manifest_rows(found, "file_url", F.lit(publisher), F.col("release_url"), published=day, extra=extra, keep=["published"])


def heat_pumps_bronze(spark: SparkSession, releases: DataFrame, listing: DataFrame, root: str, publisher: str, collection_url: str, asof: str, version: str = "") -> dict[str, str]:
    """Bronze: release documents -> manifest -> freshness and extension checks (I10, I12) -> the
    attached workbook of the landing folder landed under ``published=<yyyy-MM-dd>``."""
    rows = materialize(heat_pumps_manifest(releases, publisher, collection_url, asof, version), "manifest")
    checks = [not_null("page_url"), not_null("file_url"), has_extension("filename", ".xlsx"), fresh_within_months("published", F.lit(asof).cast("timestamp_ntz"), 3)]
    validate_rules(rows, checks, "heat pump manifest")
    manifest = rows.drop("published").first()
    if manifest is None:
        raise ContractError("heat pump manifest", {"releases": 0})
    version_key = _scalar(spark, normalise_date(F.lit(manifest["publication_date"]), strict=False))
    return _land_one(listing, manifest.asDict(), root, HEAT_PUMPS, "published", version_key)


def price_cap_silver(spark: SparkSession, root: str, sheet_name: str = LEVELS_SHEET, calendar: DataFrame | None = None) -> dict[str, str]:
    """Silver: levels sheet of the latest landed workbook -> tidy table, published under
    ``period=<start>_to_<end>`` of the price-cap period recorded at landing; the publishing
    write judges the contract (schema and rules)."""
    landed, metadata = latest_bronze(spark, root, PRICE_CAP)
    period = metadata.get("price_cap_period")
    if not period:
        raise KeyError("'price_cap_period' missing from bronze metadata")
    require_known_period(spark, period, calendar)
    grid = workbook.sheet_grid(workbook.decode_workbooks(landed, [sheet_name]), sheet_name)
    silver = K.silver_levels(grid, metadata, sheet_name, validate=False)
    key = _scalar(spark, cap_period_key(F.lit(period), strict=False))
    return medallion.publish(silver, root, "silver", PRICE_CAP, slugify(sheet_name), "period", key, contract=K.silver_contract())


def price_cap_gold(spark: SparkSession, root: str, sheet_name: str = LEVELS_SHEET) -> dict[str, dict[str, str]]:
    """Gold: the four tables from the latest silver levels, each checked and published."""
    silver = files.read_latest(spark, root, "silver", PRICE_CAP, slugify(sheet_name))
    meta_row = silver.select("metadata").first()
    metadata = dict(meta_row["metadata"]) if meta_row else {}
    period = metadata.get("price_cap_period")
    if not period:
        raise KeyError("'price_cap_period' missing from silver metadata")
    key = _scalar(spark, cap_period_key(F.lit(period), strict=False))
    with_vat = materialize(K.add_derived_component(silver.drop("metadata")))
    require_components_sum(with_vat, [K.CONSUMPTION, K.FUEL, K.PAYMENT, K.START])
    rates = materialize(K.component_rates(with_vat))
    require_components_sum(rates, [K.FUEL, K.PAYMENT, K.START, "Type"])
    bill = materialize(K.annual_bill_contributions(with_vat))
    require_components_sum(bill, [K.FUEL, K.PAYMENT, K.START, "Type"])
    outputs = {
        "1c_consumption_adjusted_levels_with_vat": K.levels_with_vat(with_vat, metadata),
        "tariff_component_rates": K.gold_rates(rates, metadata),
        "price_ratios": K.price_ratio(K.total_unit_rates(rates), metadata=metadata),
        "annual_bill_fixed_and_variable_component_contributions": K.gold_rates(bill, metadata),
    }
    contracts = K.gold_contracts()
    return {name: medallion.publish(df, root, "gold", PRICE_CAP, name, "period", key, contract=contracts[name]) for name, df in outputs.items()}


def heat_pumps_silver(spark: SparkSession, root: str) -> dict[str, dict[str, str]]:
    """Silver: Table 1.1 and Table 1.2 of the latest landed workbook, with the notes sheet,
    published under ``published=<yyyy-MM-dd>`` of the recorded publication date."""
    landed, metadata = latest_bronze(spark, root, HEAT_PUMPS)
    published = _scalar(spark, normalise_date(F.lit(metadata.get("publication_date", "")), strict=False))
    if not published:
        raise ContractError("publication date", {"unparseable": metadata.get("publication_date")})
    cells = materialize(workbook.decode_workbooks(landed, ["Notes", "Table 1.1", "Table 1.2"]))
    notes = G.notes_lookup(workbook.sheet_grid(cells, "Notes"))
    tables = {
        "Table 1.1": H.heat_pumps_by_type(workbook.sheet_grid(cells, "Table 1.1"), notes, metadata, validate=False),
        "Table 1.2": H.heat_pumps_by_region(workbook.sheet_grid(cells, "Table 1.2"), notes, metadata, validate=False),
    }
    contracts = {"Table 1.1": H.type_contract(), "Table 1.2": H.region_contract()}
    return {name: medallion.publish(df, root, "silver", HEAT_PUMPS, slugify(name), "published", published, contract=contracts[name]) for name, df in tables.items()}
