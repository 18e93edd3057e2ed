"""Fixed values that must equal the published source conventions (labels, lookups, rates)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheetmill.operators.joins import literal_table

# ---- price-cap levels workbook -------------------------------------------------------
PAYMENT_METHODS = ["Other Payment Method", "Standard Credit", "PPM"]
FUELS = [
    "Electricity: Single-Rate Metering Arrangement",
    "Electricity: Multi-Register Metering Arrangement",
    "Gas",
    "Dual fuel (implied)",
]
DUAL_FUEL = "Dual fuel (implied)"
TOTAL_INC_VAT = "Total inc VAT"
TOTAL = "Total_GB average"
NIL = "Nil consumption"
TYPICAL = "Typical consumption"
PERIOD_COL = "28AD Charge Restriction Period"
# Benchmark annual consumption in MWh per year, per fuel.
BENCHMARK_CONSUMPTION = {
    "Gas": 11.5,
    "Electricity: Single-Rate Metering Arrangement": 2.7,
    "Electricity: Multi-Register Metering Arrangement": 3.9,
}
VAT = 0.05
# Tariff component -> component category.  "Levelisation " ends with a blank on purpose.
COMPONENT_CATEGORY = {
    "DF": "Wholesale",
    "CM": "Wholesale",
    "AA": "Other",
    "PC": "Policy",
    "NC": "Network",
    "OC": "Operating",
    "SMNCC": "Operating",
    "IC": "Operating",
    "PAAC": "Operating",
    "PAP": "Operating",
    "CO": "Operating",
    "DRC": "Operating",
    "EBIT": "Other",
    "HAP": "Other",
    "Levelisation ": "Other",
    "VAT": "VAT",
    "Total_GB average": "Total_GB average",
}
# Price-cap period -> publication date.
PERIOD_PUBLICATION_DATES = {
    "1 January to 31 March 2026": "2025-11-21",
    "1 April to 30 June 2026": "2026-02-25",
    "1 July to 30 September 2026": "2026-05-27",
    "1 October to 31 December 2026": "2026-08-26",
    "1 January to 31 March 2027": "2026-11-25",
    "1 April to 30 June 2027": "2027-02-24",
    "1 July to 30 September 2027": "2027-05-26",
    "1 October to 31 December 2027": "2027-08-25",
    "1 January to 31 March 2028": "2027-11-24",
    "1 April to 30 June 2028": "2028-02-23",
    "1 July to 30 September 2028": "2028-05-31",
    "1 October to 31 December 2028": "2028-08-30",
    "1 January to 31 March 2029": "2028-11-29",
    "1 April to 30 June 2029": "2029-02-28",
    "1 July to 30 September 2029": "2029-05-30",
    "1 October to 31 December 2029": "2029-08-29",
    "1 January to 31 March 2030": "2029-11-28",
    "1 April to 30 June 2030": "2030-02-27",
    "1 July to 30 September 2030": "2030-05-29",
    "1 October to 31 December 2030": "2030-08-28",
}
NORMALISED_PERIOD_PATTERN = r"^[A-Z][a-z]{2} \d{4} - [A-Z][a-z]{2} \d{4}$"

# ---- heat-pump deployment workbook ----------------------------------------------------
QUARTER_HEADER = "Installation quarter"
TYPE_VALUE_VARS = [
    "Air-to-water heat pump installations",
    "Ground/water source heat pump installations",
    "Total heat pump installations",
]
GEOGRAPHIC_LEVEL = {
    "United Kingdom": "United Kingdom",
    "England and Wales": "England and Wales",
    "England": "National",
    "Wales": "National",
    "Scotland": "National",
    "Northern Ireland": "National",
    "North East": "Regional",
    "North West": "Regional",
    "Yorkshire and The Humber": "Regional",
    "East Midlands": "Regional",
    "West Midlands": "Regional",
    "East": "Regional",
    "London": "Regional",
    "South East": "Regional",
    "South West": "Regional",
    "Unknown": "Unknown",
}
REGION_VALUE_VARS = list(GEOGRAPHIC_LEVEL)
AREA_CODES = {
    "United Kingdom": "K02000001",
    "England and Wales": "N/A",
    "England": "E92000001",
    "North East": "E12000001",
    "North West": "E12000002",
    "Yorkshire and The Humber": "E12000003",
    "East Midlands": "E12000004",
    "West Midlands": "E12000005",
    "East": "E12000006",
    "London": "E12000007",
    "South East": "E12000008",
    "South West": "E12000009",
    "Wales": "W92000004",
    "Scotland": "S92000003",
    "Northern Ireland": "N92000002",
    "Unknown": "N/A",
}

# ---- bank holidays example ------------------------------------------------------------
DIVISIONS = ["england-and-wales", "scotland", "northern-ireland"]


def publication_calendar(spark: SparkSession) -> DataFrame:
    """The fixed calendar as a table (period, publication_date); callers may pass their own."""
    return literal_table(spark, list(PERIOD_PUBLICATION_DATES.items()), ["period", "publication_date"], ["string", "timestamp_ntz"])
