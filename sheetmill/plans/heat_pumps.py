"""Deployment tables (installations by technology, by region) from workbook grids.

The sheet stays a long cell grid end to end: header cells are attached to data cells
by (sheet, column), the row label cell (quarter) is joined to the value cells of its
row, and the tidy table comes straight out of that join (no wide intermediate), for
any number of workbooks at once.  Notes come from the notes sheet as a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetmill.functions.dates import quarter_bounds
from sheetmill.functions.numeric import to_number
from sheetmill.functions.text import clean_header, standardise_name, strip
from sheetmill.operators import grid as G
from sheetmill.operators.columns import attach_metadata
from sheetmill.operators.contracts import Contract, ContractError, Field, ge, isin, validate_rules
from sheetmill.operators.joins import map_values
from sheetmill.plans import config as C
from sheetmill.session import materialize

TAG = r"\[(note \d+)\]"
ANY_TAG = r"\[note \d+\]"


def _require_starts(facts: DataFrame, checks: dict[str, str]) -> None:
    """Every ``col`` of the sheet facts starts with its prefix (case-insensitive): all
    checks in ONE job, at most 5 offending sheets reach the driver."""
    def bad(col: str, prefix: str):
        return F.col(col).isNull() | ~F.startswith(F.lower(F.col(col)), F.lit(prefix.lower()))

    any_bad = F.lit(False)
    for col, prefix in checks.items():
        any_bad = any_bad | bad(col, prefix)
    rows = facts.where(any_bad).limit(5).collect()
    if rows:
        errors = {}
        for col, prefix in checks.items():
            got = [r[col] for r in rows if r[col] is None or not r[col].lower().startswith(prefix.lower())]
            if got:
                errors[col] = f"expected a value starting with {prefix!r}, got {got}"
        raise ContractError("sheet facts", errors)


def tidy_deployment_table(
    grid: DataFrame,
    notes: DataFrame,
    title_prefix: str,
    value_vars: Sequence[str],
    var_name: str,
    require_notes: bool,
    sheet: str = "sheet_id",
) -> tuple[DataFrame, DataFrame]:
    """Grid of one table sheet per workbook -> (tidy rows, sheet facts (sheet, title, source)).

    Tidy rows: sheet, Installation quarter, start, end, Notes, ``var_name``, value (text).
    Notes that carry the ``sheet`` key belong to that workbook; others are shared by all.
    """
    ks = [sheet]
    cells = materialize(grid.where(F.col(G.VAL).isNotNull()).select(sheet, G.ROW, G.COL, G.VAL))
    # C11 title = cell (0, 0) (the first header of the sheet); source = first 'Source:' cell of column 0 below it.
    facts = cells.groupBy(sheet).agg(
        F.max(F.when((F.col(G.ROW) == 0) & (F.col(G.COL) == 0), F.col(G.VAL))).alias("title"),
        F.min_by(F.col(G.VAL), F.when((F.col(G.COL) == 0) & (F.col(G.ROW) >= 1) & F.startswith(F.col(G.VAL), F.lit("Source:")), F.col(G.ROW))).alias("source"),
    )
    _require_starts(facts, {"title": title_prefix, "source": "Source:"})
    # C1 header row: first row below the title whose first cell contains the quarter label.
    header_rows = G.find_marker_row(cells, G.cell_contains(C.QUARTER_HEADER, 0), ks, out="header_row", after=F.col(G.ROW) >= 1)
    headed = G.promote_header(cells, header_rows, ks)
    # C9 clean names, C13 column-level tags: first tag of a name resolved and removed.
    heads = headed.select(sheet, G.COL, "header").distinct().withColumn("header", clean_header("header"))
    heads = heads.withColumn("__ref", F.regexp_extract("header", TAG, 1)).withColumn(
        "name", F.when(F.col("__ref") != "", strip(F.replace(F.col("header"), F.concat(F.lit("["), F.col("__ref"), F.lit("]")), F.lit("")))).otherwise(F.col("header"))
    )
    note_keys = [*([sheet] if sheet in notes.columns else []), "__ref"]
    notes_d = notes.withColumnRenamed("note_ref", "__ref").groupBy(*note_keys).agg(F.max("note_text").alias("__note"))
    heads = heads.join(notes_d, on=note_keys, how="left")
    col_notes = heads.where(F.col("__ref") != "").groupBy(sheet).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(G.COL), F.coalesce("__note", F.lit("")).alias("t")))), lambda x: F.concat(F.lit(" "), x["t"])), "").alias("__col_notes")
    )
    return _finish(headed, heads, col_notes, notes_d, facts, value_vars, var_name, require_notes, sheet)


def _finish(headed, heads, col_notes, notes_d, facts, value_vars, var_name, require_notes, sheet):
    ks = [sheet]
    # Names-only contract on the cleaned header set, judged per sheet on the executors;
    # only offending sheets (at most 5) reach the driver.
    expected = sorted({C.QUARTER_HEADER, *value_vars})
    per_sheet = heads.groupBy(sheet).agg(
        F.count_distinct(F.when(F.col("name").isin(expected), F.col("name"))).alias("__present"),
        F.sort_array(F.collect_set(F.when(~F.col("name").isin(expected), F.col("name")))).alias("__unexpected"),
        F.sort_array(F.collect_set("name")).alias("__names"),
    )
    bad = per_sheet.where((F.col("__present") < len(expected)) | (F.size("__unexpected") > 0)).limit(5).collect()
    if bad:
        r = bad[0]
        raise ContractError(
            "wide table",
            {"missing columns": sorted(set(expected) - set(r["__names"])), "unexpected columns": list(r["__unexpected"]), "sheets": [b[sheet] for b in bad]},
        )
    named = headed.join(heads.select(sheet, G.COL, "name"), on=[sheet, G.COL])
    quarter = named.where(F.col("name") == C.QUARTER_HEADER).select(sheet, G.ROW, F.col(G.VAL).alias("__q"))
    quarter = quarter.withColumn("__ref", F.regexp_extract("__q", TAG, 1))
    quarter = quarter.join(notes_d, on=[c for c in notes_d.columns if c != "__note"], how="left")
    quarter = quarter.join(col_notes, on=ks, how="left")
    clean_q = strip(F.regexp_replace("__q", ANY_TAG, ""))
    start, end = quarter_bounds(clean_q)
    ids = quarter.select(
        sheet,
        G.ROW,
        clean_q.alias(C.QUARTER_HEADER),
        start.alias(f"{C.QUARTER_HEADER} start"),
        end.alias(f"{C.QUARTER_HEADER} end"),
        F.concat(F.coalesce("__col_notes", F.lit("")), F.lit(" "), F.coalesce("__note", F.lit(""))).alias("Notes"),
    )
    ids = materialize(ids)
    # Quarter parsing and (Table 1.1) non-blank notes judged in ONE aggregation; only a
    # count and two example quarters reach the driver.
    bad = F.col(f"{C.QUARTER_HEADER} start").isNull()
    chk = ids.agg(
        F.count_if(bad).alias("n_bad"),
        F.min(F.when(bad, F.col(C.QUARTER_HEADER))).alias("lo"),
        F.max(F.when(bad, F.col(C.QUARTER_HEADER))).alias("hi"),
        F.bool_or(F.length(strip("Notes")) > 0).alias("notes_ok"),
    ).first()
    if chk["n_bad"]:
        examples = sorted({chk["lo"], chk["hi"]} - {None})
        raise ContractError("quarters", {"unparseable installation quarter": f"{chk['n_bad']} row(s), e.g. {examples}"})
    if require_notes and not chk["notes_ok"]:
        raise G.GridError("column 'Notes' is entirely empty: the notes lookup may have failed to match")
    value_cols = heads.where(F.col("name").isin(list(value_vars))).select(sheet, G.COL, F.col("name").alias(var_name))
    values = named.select(sheet, G.ROW, G.COL, G.VAL)
    # D2 melt: every (data row, value column) pair of the sheet, blanks kept as NULL.
    tidy = ids.join(value_cols, on=ks).join(values, on=[sheet, G.ROW, G.COL], how="left")
    return tidy.drop(G.ROW, G.COL), facts


def _silver(tidy: DataFrame, facts: DataFrame, metadata: dict[str, str], sheet: str) -> DataFrame:
    out = tidy.join(facts, on=sheet).withColumn("value", to_number("value").cast("bigint"))
    citation = F.concat(
        F.lit(f"Source: {metadata.get('publisher', '')}, {metadata.get('filename', '')}. "),
        F.col("title"),
        F.lit(f". Published {metadata.get('publication_date', '')}, {metadata.get('page_url', '')}."),
    )
    out = attach_metadata(out, metadata, extra={"table_name": F.col("title"), "data_source": F.col("source"), "citation": citation})
    return out.drop("title", "source")


def _standardise(df: DataFrame, keep: Sequence[str], sheet: str | None = None) -> DataFrame:
    key = [] if sheet is None else [F.col(sheet)]
    return df.select(*key, *[F.col(f"`{c}`").alias(standardise_name(c)) for c in keep])


def _validated(out: DataFrame, contract: Contract, validate: bool) -> DataFrame:
    """``out`` written once and judged, or left lazy for a publish that judges it."""
    if not validate:
        return out
    out = materialize(out)
    validate_rules(out, contract.row_rules(), contract.name)
    return out


def _silver_contract(var: str, values: Sequence[str], extra: Sequence[Field] = ()) -> Contract:
    ts = T.TimestampNTZType()
    return Contract(
        "silver deployment table",
        (
            Field("installation_quarter", T.StringType()),
            Field("installation_quarter_start", ts),
            Field("installation_quarter_end", ts),
            Field("notes", T.StringType(), nullable=True),
            Field(var, T.StringType(), checks=(isin(var, list(values)),)),
            Field("value", T.LongType(), checks=(ge("value", 0),)),
            Field("metadata", T.MapType(T.StringType(), T.StringType())),
            *extra,
        ),
    )


def type_contract() -> Contract:
    return _silver_contract("type", C.TYPE_VALUE_VARS)


def region_contract() -> Contract:
    extra = (
        Field("area_code", T.StringType(), checks=(isin("area_code", sorted(set(C.AREA_CODES.values()) | {"N/A"})),)),
        Field("geographic_level", T.StringType(), checks=(isin("geographic_level", sorted(set(C.GEOGRAPHIC_LEVEL.values()))),)),
    )
    return _silver_contract("country_or_region", C.REGION_VALUE_VARS, extra)


def heat_pumps_by_type(grid: DataFrame, notes: DataFrame, metadata: dict[str, str], sheet: str = "sheet_id", validate: bool = True, keep_sheet: bool = False) -> DataFrame:
    """K10 Table 1.1: installations per quarter and heat-pump type.  ``keep_sheet`` puts the
    workbook key in front (needed to tell several workbooks apart)."""
    tidy, facts = tidy_deployment_table(grid, notes, "Table 1.1", C.TYPE_VALUE_VARS, "Type", require_notes=True, sheet=sheet)
    names = [C.QUARTER_HEADER, f"{C.QUARTER_HEADER} start", f"{C.QUARTER_HEADER} end", "Notes", "Type", "value", "metadata"]
    return _validated(_standardise(_silver(tidy, facts, metadata, sheet), names, sheet if keep_sheet else None), type_contract(), validate)


def heat_pumps_by_region(grid: DataFrame, notes: DataFrame, metadata: dict[str, str], sheet: str = "sheet_id", validate: bool = True, keep_sheet: bool = False) -> DataFrame:
    """K11 Table 1.2: installations per quarter and country or region, with area code
    (default 'N/A') and geographic level."""
    tidy, facts = tidy_deployment_table(grid, notes, "Table 1.2", C.REGION_VALUE_VARS, "country_or_region", require_notes=False, sheet=sheet)
    out = _silver(tidy, facts, metadata, sheet)
    out = out.withColumn("area_code", map_values("country_or_region", C.AREA_CODES, default="N/A")).withColumn("geographic_level", map_values("country_or_region", C.GEOGRAPHIC_LEVEL))
    names = [C.QUARTER_HEADER, f"{C.QUARTER_HEADER} start", f"{C.QUARTER_HEADER} end", "Notes", "country_or_region", "value", "metadata", "area_code", "geographic_level"]
    return _validated(_standardise(out, names, sheet if keep_sheet else None), region_contract(), validate)
