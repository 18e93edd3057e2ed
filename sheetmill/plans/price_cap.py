"""K1-K9: the price-cap levels build (silver tidy table and the four gold tables).

Every step is one Spark plan over the whole input, whatever the number of payment
methods, fuels, periods or workbooks:

* the silver table comes from the cell grid in ONE pass per step (sections for all
  payment methods and blocks for all fuels at once, driven by small literal spec
  tables), not one node per (payment, fuel, consumption) block;
* gold metrics use one pivot (a single aggregation), arithmetic and a row-local
  unpivot for every fuel at once, instead of a per-fuel loop and a concat;
* the VAT step turns each total row into two rows with one ``explode``, so the
  input is scanned once instead of once per union branch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetmill.functions.dates import normalise_months, parse_month_range
from sheetmill.functions.numeric import ratio, to_number
from sheetmill.operators import grid as G
from sheetmill.operators.columns import attach_metadata
from sheetmill.operators.contracts import Contract, Field, isin, matches, validate_rules
from sheetmill.operators.joins import literal_table, map_values
from sheetmill.operators.reshape import melt, pivot_mean, require_values, require_values_in
from sheetmill.operators.timeseries import period_over_period
from sheetmill.plans import config as C
from sheetmill.session import materialize

PAYMENT, FUEL, CONSUMPTION, COMPONENT, VALUE = "Payment method", "Fuel", "Consumption", "Tariff component", "value"
START, END, INTERVAL = f"{C.PERIOD_COL} start", f"{C.PERIOD_COL} end", f"{C.PERIOD_COL} interval"
INDEX_COLS = [PAYMENT, FUEL, COMPONENT, C.PERIOD_COL, START, END]


def q(name: str) -> Column:
    return F.col(f"`{name}`")


# ---------------------------------------------------------------- K1


def add_derived_component(
    df: DataFrame,
    component_col: str = COMPONENT,
    value_col: str = VALUE,
    total_label: str = C.TOTAL,
    derived_label: str = "VAT",
    rate: float = C.VAT,
    drop_labels: Sequence[str] = (C.TOTAL_INC_VAT,),
    check: bool = True,
) -> DataFrame:
    """K1 each total row becomes two rows: the total uprated by (1 + rate) and a
    ``derived_label`` row worth total x rate; rows labelled ``drop_labels`` are removed.
    Raises when there is no total row at all (``check``)."""
    comp, val = q(component_col), q(value_col)
    is_total = F.coalesce(comp == F.lit(total_label), F.lit(False))
    if check and df.where(is_total).isEmpty():
        raise ValueError(f"expected component '{total_label}' not found")
    others = [c for c in df.columns if c not in (component_col, value_col)]
    keep = F.lit(True)
    for label in drop_labels:
        keep = keep & ~comp.eqNullSafe(F.lit(label))
    pairs = F.when(
        is_total,
        F.array(
            F.struct(comp.alias("c"), (val * F.lit(1 + rate)).alias("v")),
            F.struct(F.lit(derived_label).alias("c"), (val * F.lit(rate)).alias("v")),
        ),
    ).otherwise(F.array(F.struct(comp.alias("c"), val.cast("double").alias("v"))))
    exploded = df.where(keep).select(*[q(c) for c in others], F.explode(pairs).alias("__p"))
    return exploded.select(*[q(c) for c in others], F.col("__p.c").alias(component_col), F.col("__p.v").alias(value_col)).select(*[q(c) for c in df.columns])


# ---------------------------------------------------------------- K2 / K7


def levels_with_vat(
    with_vat: DataFrame,
    metadata: dict[str, str] | Column | None = None,
    keys: Sequence[str] = (COMPONENT, FUEL, PAYMENT, CONSUMPTION),
    order: str = START,
    component_col: str = COMPONENT,
    categories: dict[str, str] = C.COMPONENT_CATEGORY,
    split_by: Column | None = None,
) -> DataFrame:
    """K2 add ``Component category``, the metadata map and the change from the previous period."""
    out = with_vat.withColumn("Component category", map_values(component_col, categories))
    if metadata is not None:
        out = attach_metadata(out, metadata)
    return period_over_period(out, list(keys), [order, *keys], VALUE, split_by=split_by)


# ---------------------------------------------------------------- K3 / K6


def _pivot_consumption(with_vat: DataFrame, fuels: Sequence[str], index_cols: Sequence[str], fuel_col: str, consumption_col: str, value_col: str, require: bool) -> DataFrame:
    if require:  # fuels and both consumption levels checked in one job
        require_values_in(with_vat, {fuel_col: (list(fuels), "fuel"), consumption_col: ([C.NIL, C.TYPICAL], "consumption level")})
    src = with_vat.where(q(fuel_col).isin(list(fuels)))
    return pivot_mean(src, list(index_cols), consumption_col, value_col, [C.NIL, C.TYPICAL])


def component_rates(
    with_vat: DataFrame,
    benchmarks: dict[str, float] = C.BENCHMARK_CONSUMPTION,
    index_cols: Sequence[str] = INDEX_COLS,
    fuel_col: str = FUEL,
    consumption_col: str = CONSUMPTION,
    value_col: str = VALUE,
    require: bool = True,
) -> DataFrame:
    """K3 per fuel with a benchmark: standing charge (p/day) = nil x 100 / 365 and unit
    price (p/kWh) = (typical - nil or 0) / benchmark x 0.1; NULLs -> 0; long form with
    ``Type`` and ``Unit``.  One pivot for all fuels; the benchmark is a literal map."""
    wide = _pivot_consumption(with_vat, list(benchmarks), index_cols, fuel_col, consumption_col, value_col, require)
    nil, typ = q(C.NIL), q(C.TYPICAL)
    bench = map_values(fuel_col, benchmarks)
    derived = wide.select(
        *[q(c) for c in index_cols],
        F.coalesce(nil * F.lit(100.0) / F.lit(365.0), F.lit(0.0)).alias("Standing charge"),
        F.coalesce((typ - F.coalesce(nil, F.lit(0.0))) / bench * F.lit(0.1), F.lit(0.0)).alias("Unit price"),
    )
    long = melt(derived, list(index_cols), ["Standing charge", "Unit price"], "Type", value_col)
    return long.withColumn("Unit", map_values("Type", {"Standing charge": "p/day", "Unit price": "p/kWh"}))


def annual_bill_contributions(
    with_vat: DataFrame,
    fuels: Sequence[str] = tuple(C.BENCHMARK_CONSUMPTION),
    index_cols: Sequence[str] = INDEX_COLS,
    fuel_col: str = FUEL,
    consumption_col: str = CONSUMPTION,
    value_col: str = VALUE,
    require: bool = True,
) -> DataFrame:
    """K6 standing charge = nil or 0; consumption-based cost = typical - (nil or 0); GBP/year."""
    wide = _pivot_consumption(with_vat, fuels, index_cols, fuel_col, consumption_col, value_col, require)
    nil, typ = q(C.NIL), q(C.TYPICAL)
    derived = wide.select(
        *[q(c) for c in index_cols],
        F.coalesce(nil, F.lit(0.0)).alias("Standing charge"),
        F.coalesce(typ - F.coalesce(nil, F.lit(0.0)), F.lit(0.0)).alias("Consumption-based cost"),
    )
    long = melt(derived, list(index_cols), ["Standing charge", "Consumption-based cost"], "Type", value_col)
    return long.withColumn("Unit", F.lit("GBP/year"))


def gold_rates(rates: DataFrame, metadata: dict[str, str] | Column | None = None, split_by: Column | None = None) -> DataFrame:
    """K3/K6 gold: category, metadata and change from the previous period per (component, fuel, payment, Type)."""
    return levels_with_vat(rates, metadata, keys=(COMPONENT, FUEL, PAYMENT, "Type"), split_by=split_by)


# ---------------------------------------------------------------- K4 / K5


def total_unit_rates(
    rates: DataFrame,
    fuel_columns: dict[str, str] | None = None,
    index_cols: Sequence[str] = (PAYMENT, C.PERIOD_COL, START, END),
    fuel_col: str = FUEL,
    require: bool = True,
) -> DataFrame:
    """K4 total unit price per fuel side by side (one pivot)."""
    fuel_columns = fuel_columns or {
        "Electricity: Single-Rate Metering Arrangement": "Electricity (single rate) unit price",
        "Gas": "Gas unit price",
    }
    if require:
        require_values(rates, fuel_col, list(fuel_columns), what="fuel")
    totals = rates.where((q(COMPONENT) == C.TOTAL) & q(fuel_col).isin(list(fuel_columns)) & (q("Type") == "Unit price"))
    wide = pivot_mean(totals, list(index_cols), fuel_col, VALUE, list(fuel_columns))
    return wide.withColumnsRenamed(fuel_columns)


def price_ratio(
    unit_rates: DataFrame,
    numerator: str = "Electricity (single rate) unit price",
    denominator: str = "Gas unit price",
    keys: Sequence[str] = (PAYMENT,),
    id_cols: Sequence[str] = (PAYMENT, C.PERIOD_COL, START, END),
    order: str = START,
    variable: str = "Electricity to gas price ratio",
    metadata: dict[str, str] | Column | None = None,
    split_by: Column | None = None,
) -> DataFrame:
    """K5 numerator / denominator (x/0 -> NULL), a ``Variable`` label, metadata and the
    change from the previous period per ``keys`` (``split_by`` spreads a hot key)."""
    out = unit_rates.select(*[q(c) for c in id_cols], ratio(q(numerator), q(denominator), inf_as_null=True).alias(VALUE)).withColumn("Variable", F.lit(variable))
    if metadata is not None:
        out = attach_metadata(out, metadata)
    return period_over_period(out, list(keys), [order, *keys], VALUE, split_by=split_by)


# ---------------------------------------------------------------- K8 / K9 (silver from the cell grid)


def _specs(spark: SparkSession, name: str, values: Sequence[str]) -> DataFrame:
    return literal_table(spark, [(v,) for v in values], [name])


def tidy_tariff_tables(
    grid: DataFrame,
    payment_methods: Sequence[str] = C.PAYMENT_METHODS,
    fuels: Sequence[str] = C.FUELS,
    sheet: str = "sheet_id",
    label_col: int = 1,
    strict: bool = True,
) -> DataFrame:
    """K8 cell grid of the tariff sheet(s) -> tidy (sheet, payment, fuel, consumption, component, period, value).

    Steps (each one plan over all sheets, payment methods and fuels):
    C1 section start = first row whose cell in column ``label_col`` equals the payment
    method (row 0 is the header row of the sheet and is not searched); C2 the first
    column holding the dual-fuel label on the raw sheet; C3 section end = 2nd total-inc-VAT
    row after the start in that column; C4 inclusive slice; C6 drop blank rows/columns;
    C7 fill right; C2 fuel columns; C1 nil/typical header rows in the first fuel column;
    C8 header cells; D1 long form; E3 drop rows without a component; J4 month names.
    """
    spark = grid.sparkSession
    g = materialize(grid.where(F.col(G.VAL).isNotNull()).select(sheet, G.ROW, G.COL, G.VAL))
    pays = _specs(spark, PAYMENT, payment_methods)
    starts = (
        g.where((F.col(G.COL) == label_col) & (F.col(G.ROW) > 0))
        .join(pays, F.col(G.VAL) == q(PAYMENT))
        .groupBy(sheet, PAYMENT)
        .agg(F.min(G.ROW).alias("start_row"))
    )
    dual = G.find_marker_columns(g.where(F.col(G.ROW) > 0), G.cell_equals(C.DUAL_FUEL), [sheet]).select(sheet, F.col("first_col").alias("dual_col"))
    totals = g.where(F.col(G.VAL) == C.TOTAL_INC_VAT).join(dual, on=sheet).where(F.col(G.COL) == F.col("dual_col")).select(sheet, G.ROW)
    # Section end: the 2nd total-inc-VAT row after each section start.
    cand = totals.join(starts, on=sheet).where(F.col(G.ROW) > F.col("start_row"))
    w = Window.partitionBy(sheet, PAYMENT).orderBy(G.ROW)
    # A row_number filter (partial top-n below the shuffle) and a partial count, no whole-key window.
    second = cand.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 2).select(sheet, PAYMENT, F.col(G.ROW).alias("end_row"))
    nth = cand.groupBy(sheet, PAYMENT, "start_row").agg(F.count(F.lit(1)).alias("found")).join(second, on=[sheet, PAYMENT], how="left")
    # Every section start is kept: one without any total row after it reports found = 0.
    # A few rows per sheet, written once: the check and the slice read it instead of
    # re-running the marker joins and windows.
    ends = materialize(starts.join(nth, on=[sheet, PAYMENT, "start_row"], how="left"), "tariff-sections")
    if strict:
        _require_sections(ends, len(payment_methods), sheet, g)
    bounds = ends.where(F.col("end_row").isNotNull()).select(sheet, PAYMENT, "start_row", "end_row")
    section = G.slice_rows(g, bounds, [sheet]).select(sheet, PAYMENT, G.ROW, G.COL, G.VAL)
    keys = [sheet, PAYMENT]
    dense = materialize(G.ffill_right(G.drop_empty(section, keys), keys))

    fuel_specs = _specs(spark, FUEL, fuels)
    fuel_cols = dense.join(fuel_specs, F.col(G.VAL) == q(FUEL)).groupBy(*keys, FUEL).agg(F.min(G.COL).alias("fuel_col"), F.collect_set(G.COL).alias("fuel_cols"))
    first_col = dense.join(fuel_cols, on=keys).where(F.col(G.COL) == F.col("fuel_col"))
    heads = first_col.groupBy(*keys, FUEL).agg(
        F.min(F.when(F.col(G.VAL) == C.NIL, F.col(G.ROW))).alias("nil_row"),
        F.min(F.when(F.col(G.VAL) == C.TYPICAL, F.col(G.ROW))).alias("typ_row"),
    )
    last_row = dense.groupBy(*keys).agg(F.max(G.ROW).alias("last_row"))
    blocks = materialize(heads.join(fuel_cols, on=[*keys, FUEL]).join(last_row, on=keys), "tariff-blocks")
    if strict:
        _require_blocks(blocks, fuel_specs, keys)
    nil_b = blocks.select(*keys, FUEL, "fuel_col", "fuel_cols", F.lit(C.NIL).alias(CONSUMPTION), F.col("nil_row").alias("h"), (F.col("typ_row") - 1).alias("e"))
    typ_b = blocks.select(*keys, FUEL, "fuel_col", "fuel_cols", F.lit(C.TYPICAL).alias(CONSUMPTION), F.col("typ_row").alias("h"), F.col("last_row").alias("e"))
    spec = nil_b.unionByName(typ_b).where(F.col("h").isNotNull() & F.col("e").isNotNull())
    cells = dense.join(spec, on=keys).where(F.array_contains("fuel_cols", F.col(G.COL)) & (F.col(G.ROW) >= F.col("h")) & (F.col(G.ROW) <= F.col("e")))
    bk = [*keys, FUEL, CONSUMPTION]
    header = cells.where(F.col(G.ROW) == F.col("h")).select(*bk, G.COL, F.col(G.VAL).alias("__header"))
    body = cells.where(F.col(G.ROW) > F.col("h"))
    labels = body.where(F.col(G.COL) == F.col("fuel_col")).select(*bk, G.ROW, F.col(G.VAL).alias(COMPONENT))
    values = body.where(F.col(G.COL) != F.col("fuel_col")).select(*bk, G.ROW, G.COL, F.col(G.VAL).alias(VALUE))
    # Every (row, period column) of the block, blank values kept as NULL (dense rows x period columns).
    rows = body.select(*bk, G.ROW).distinct()
    period_cols = header.where(F.col(G.COL).isNotNull()).join(spec.select(*bk, "fuel_col"), on=bk).where(F.col(G.COL) != F.col("fuel_col")).drop("fuel_col")
    grid_rows = rows.join(period_cols, on=bk)
    tidy = (
        grid_rows.join(values, on=[*bk, G.ROW, G.COL], how="left")
        .join(labels, on=[*bk, G.ROW], how="left")
        .where(q(COMPONENT).isNotNull())
        .select(q(sheet), q(PAYMENT), q(FUEL), q(CONSUMPTION), q(COMPONENT), normalise_months(F.col("__header")).alias(C.PERIOD_COL), q(VALUE))
    )
    return tidy


def _require_sections(ends: DataFrame, n_payments: int, sheet: str, g: DataFrame) -> None:
    """Every sheet has all payment sections, each with a 2nd total row: ONE job, and a
    report bounded to 5 sheets (the per-sheet lists are bounded by the payment methods)."""
    per_sheet = ends.groupBy(sheet).agg(
        F.collect_set(PAYMENT).alias("found"),
        F.collect_list(F.when(F.col("end_row").isNull(), F.struct(PAYMENT, "start_row", F.coalesce("found", F.lit(0)).alias("n")))).alias("short"),
    )
    bad = (
        g.select(sheet).distinct().join(per_sheet, on=sheet, how="left")
        .where((F.coalesce(F.size("found"), F.lit(0)) < n_payments) | (F.coalesce(F.size("short"), F.lit(0)) > 0))
        .limit(5)
        .collect()
    )
    missing = [(r[sheet], r["found"]) for r in bad if len(r["found"] or []) < n_payments]
    if missing:
        raise G.GridError(f"could not find every payment method header; found {missing}")
    short = [x for r in bad for x in (r["short"] or [])]
    if short:
        raise G.GridError(
            f"expected at least 2 '{C.TOTAL_INC_VAT}' rows after "
            + ", ".join(f"{x[PAYMENT]} at row {x['start_row']} but found only {x['n']}" for x in short)
        )


def _require_blocks(blocks: DataFrame, fuel_specs: DataFrame, keys: Sequence[str]) -> None:
    bad = blocks.where(F.col("nil_row").isNull() | F.col("typ_row").isNull()).limit(5).collect()
    if bad:
        raise G.GridError(f"could not find consumption headers for {[(r[PAYMENT], r[FUEL]) for r in bad]}")


def period_dates(df: DataFrame, period_col: str = C.PERIOD_COL, strict: bool = True) -> DataFrame:
    """K9 start (midnight of the first day), end (midnight of the last day) and the
    closed interval [first day 00:00:00, last day 23:59:59] from a month-range text."""
    iv = parse_month_range(q(period_col), strict=strict)
    return df.withColumns(
        {
            f"{period_col} start": F.date_trunc("day", iv["left"]).cast("timestamp_ntz"),
            f"{period_col} end": F.date_trunc("day", iv["right"]).cast("timestamp_ntz"),
            f"{period_col} interval": iv,
        }
    )


def silver_contract() -> Contract:
    """Contract of the silver levels table (built on demand: rules are Columns)."""
    return Contract(
        "silver consumption adjusted levels",
        (
            Field(PAYMENT, T.StringType(), checks=(isin(PAYMENT, C.PAYMENT_METHODS),)),
            Field(FUEL, T.StringType()),
            Field(CONSUMPTION, T.StringType(), checks=(isin(CONSUMPTION, [C.NIL, C.TYPICAL]),)),
            Field(COMPONENT, T.StringType(), checks=(isin(COMPONENT, [c for c in C.COMPONENT_CATEGORY if c != "VAT"] + [C.TOTAL_INC_VAT]),)),
            Field(C.PERIOD_COL, T.StringType(), checks=(matches(C.PERIOD_COL, C.NORMALISED_PERIOD_PATTERN),)),
            Field(VALUE, T.DoubleType(), nullable=True),
            Field(START, T.TimestampNTZType()),
            Field(END, T.TimestampNTZType()),
            Field(INTERVAL, T.StructType([T.StructField("left", T.TimestampNTZType()), T.StructField("right", T.TimestampNTZType())])),
            Field("metadata", T.MapType(T.StringType(), T.StringType())),
        ),
    )


def silver_levels(grid: DataFrame, metadata: dict[str, str], sheet_name: str, validate: bool = True) -> DataFrame:
    """K8 + K9 + E9 + E11: the silver table from the cell grid of one workbook's sheet,
    validated here or (``validate=False``, left lazy) by the publish that writes it."""
    tidy = tidy_tariff_tables(grid).drop("sheet_id")
    # Lenient parse here; unparseable periods fail the contract's not-null rules below
    # (a raise inside a lazy column could fire on rows a later filter would remove).
    out = period_dates(tidy, strict=False).withColumn(VALUE, to_number(VALUE))
    out = attach_metadata(out, {**metadata, "excel_sheet_name": sheet_name})
    if not validate:
        return out
    out = materialize(out)
    contract = silver_contract()
    validate_rules(out, contract.row_rules(), contract.name)
    return out


def gold_contracts() -> dict[str, Contract]:
    """Strict contracts of the four gold tables (built on demand: rules are Columns)."""
    s, d, ts, meta = T.StringType(), T.DoubleType(), T.TimestampNTZType(), T.MapType(T.StringType(), T.StringType())
    interval = T.StructType([T.StructField("left", ts), T.StructField("right", ts)])
    components = list(C.COMPONENT_CATEGORY)
    categories = sorted(set(C.COMPONENT_CATEGORY.values()))
    benchmark_fuels = list(C.BENCHMARK_CONSUMPTION)

    def common(fuels: list[str] | None) -> tuple[Field, ...]:
        return (
            Field(PAYMENT, s, checks=(isin(PAYMENT, C.PAYMENT_METHODS),)),
            Field(FUEL, s, checks=(isin(FUEL, fuels),) if fuels else ()),
            Field(COMPONENT, s, checks=(isin(COMPONENT, components),)),
            Field("Component category", s, checks=(isin("Component category", categories),)),
            Field(C.PERIOD_COL, s),
            Field(START, ts),
            Field(END, ts),
        )

    changes = (Field("change_from_previous_period", d, nullable=True), Field("pct_change_from_previous_period", d, nullable=True))
    rates = common(benchmark_fuels) + (Field("Type", s), Field("Unit", s), Field(VALUE, d), Field("metadata", meta)) + changes
    return {
        "1c_consumption_adjusted_levels_with_vat": Contract(
            "gold levels with VAT",
            common(None) + (Field(CONSUMPTION, s, checks=(isin(CONSUMPTION, [C.NIL, C.TYPICAL]),)), Field(VALUE, d, nullable=True), Field(INTERVAL, interval), Field("metadata", meta)) + changes,
        ),
        "tariff_component_rates": Contract("gold component rates", rates),
        "annual_bill_fixed_and_variable_component_contributions": Contract("gold annual bill contributions", rates),
        "price_ratios": Contract(
            "gold price ratios",
            (
                Field(PAYMENT, s, checks=(isin(PAYMENT, C.PAYMENT_METHODS),)),
                Field(C.PERIOD_COL, s),
                Field(START, ts),
                Field(END, ts),
                Field("Variable", s, checks=(isin("Variable", ["Electricity to gas price ratio"]),)),
                Field(VALUE, d, nullable=True),
                Field("metadata", meta),
            )
            + changes,
        ),
    }
