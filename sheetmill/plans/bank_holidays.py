"""Bank holidays (nested JSON documents -> validated silver table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetmill.functions.dates import date_stamp, parse_iso_date
from sheetmill.operators.contracts import Contract, Field, apply_contract, isin
from sheetmill.operators.reshape import flatten_nested
from sheetmill.plans import config as C
from sheetmill.sources import medallion

EVENT = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("notes", T.StringType()),
        T.StructField("bunting", T.BooleanType()),
    ]
)
DOCUMENT = T.MapType(T.StringType(), T.StructType([T.StructField("division", T.StringType()), T.StructField("events", T.ArrayType(EVENT))]))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON files whose top level is an object keyed by division: one row per file
    (``path``, ``doc``).  The top level is a map, so the text is parsed with an explicit
    map schema (no inference pass)."""
    raw = spark.read.option("wholetext", True).text(path)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", DOCUMENT).alias("doc"))


def silver_contract() -> Contract:
    """division in the known set; every column typed; strict column set; coercion on."""
    return Contract(
        "silver bank holidays",
        (
            Field("division", T.StringType(), checks=(isin("division", C.DIVISIONS),)),
            Field("title", T.StringType()),
            Field("date", T.TimestampNTZType()),
            Field("notes", T.StringType()),
            Field("bunting", T.BooleanType()),
            Field("year", T.LongType()),
        ),
        strict=True,
        coerce=True,
    )


def parse_holidays(flat: DataFrame) -> DataFrame:
    """Exact 'yyyy-MM-dd' dates and the year.  A bad date becomes NULL here and fails the
    contract's not-null rule, so the failure is reported with the rule name."""
    return flat.withColumn("date", parse_iso_date("date", strict=False)).withColumn("year", F.year("date").cast("bigint"))


def silver_bank_holidays(docs: DataFrame, validate: bool = True) -> DataFrame:
    """K12 flatten (D5) -> parse (J8) -> contract (I1), judged here or (``validate=False``) by
    the publish that writes it."""
    parsed = parse_holidays(flatten_nested(docs, "doc"))
    return apply_contract(parsed, silver_contract()) if validate else parsed


def run_silver(spark: SparkSession, bronze_path: str, root: str, ingested_at: str, dataset: str = "example") -> dict[str, str]:
    """Read landed documents, build and validate the silver table, publish it under the
    path-safe ingest stamp (B5)."""
    docs = read_documents(spark, bronze_path)
    stamp = spark.range(1).select(date_stamp(F.lit(ingested_at)).alias("s")).first()["s"]
    return medallion.publish(silver_bank_holidays(docs, validate=False), root, "silver", dataset, "bank_holidays", "ingested", stamp, contract=silver_contract())
