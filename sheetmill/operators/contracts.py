"""I: declarative data contracts and custom validation rules.

A contract is a list of typed fields plus row rules.  Validation costs:

* the column set and types are checked against ``df.schema`` on the driver (free);
* all row rules are evaluated in ONE aggregation (``count_if`` per rule, map-side
  partial aggregation, one tiny shuffle), never one job per rule;
* offending values are reported from a bounded sample (``max_examples``), never by
  collecting a column.

``observe_contract`` attaches the same counts to a write via ``DataFrame.observe`` so
publishing and validating read the data once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetmill.operators.exact import exact_sums


class ContractError(ValueError):
    """Raised when a DataFrame breaks its contract; lists every failing rule."""

    def __init__(self, contract: str, failures: dict[str, object]):
        self.contract = contract
        self.failures = failures
        lines = "; ".join(f"{k}: {v}" for k, v in failures.items())
        super().__init__(f"contract '{contract}' failed: {lines}")


@dataclass(frozen=True)
class Rule:
    """A named row-level rule.  ``violation`` is TRUE for a row that breaks the rule;
    ``example`` (optional) is the value shown for offending rows."""

    name: str
    violation: Column
    example: Column | None = None


def isin(col: str, values: Sequence[object]) -> Rule:
    """I2 value must be one of ``values`` (NULL is judged by the nullability rule)."""
    c = F.col(f"`{col}`")
    return Rule(f"{col} isin", c.isNotNull() & ~c.isin(list(values)), c.cast("string"))


def ge(col: str, bound: float) -> Rule:
    """I3 value must be >= bound."""
    c = F.col(f"`{col}`")
    return Rule(f"{col} >= {bound}", c < F.lit(bound), c.cast("string"))


def not_null(col: str) -> Rule:
    """I4 value must not be NULL (NaN counts as missing, as in the source tool)."""
    c = F.col(f"`{col}`")
    missing = c.isNull()
    return Rule(f"{col} not null", missing, F.lit(None).cast("string"))


def matches(col: str, pattern: str) -> Rule:
    """I6 every value must match the regular expression."""
    c = F.col(f"`{col}`")
    return Rule(f"{col} matches {pattern}", c.isNotNull() & ~c.rlike(pattern), c.cast("string"))


def starts_with(col: str, prefix: str) -> Rule:
    """I11 case-insensitive prefix."""
    c = F.col(f"`{col}`")
    return Rule(f"{col} starts with {prefix!r}", ~F.coalesce(F.startswith(F.lower(c), F.lit(prefix.lower())), F.lit(False)), c)


def has_extension(col: str, ext: str) -> Rule:
    """I12 case-insensitive file extension."""
    c = F.col(f"`{col}`")
    return Rule(f"{col} has extension {ext}", ~F.coalesce(F.endswith(F.lower(c), F.lit(ext.lower())), F.lit(False)), c)


@dataclass(frozen=True)
class Field:
    name: str
    dtype: T.DataType | None  # None = presence-only (names-only contract)
    nullable: bool = False
    checks: tuple[Rule, ...] = ()


@dataclass(frozen=True)
class Contract:
    """I1 strict column set + types + nullability + value checks (+ optional coercion)."""

    name: str
    fields: tuple[Field, ...]
    strict: bool = True
    coerce: bool = False
    rules: tuple[Rule, ...] = field(default_factory=tuple)

    def row_rules(self) -> list[Rule]:
        out: list[Rule] = []
        for f in self.fields:
            if f.dtype is not None and not f.nullable:
                out.append(not_null(f.name))
            out.extend(f.checks)
        out.extend(self.rules)
        return out


def _type_ok(actual: T.DataType, expected: T.DataType) -> bool:
    if isinstance(expected, T.StructType) and isinstance(actual, T.StructType):
        return [(f.name, f.dataType.simpleString()) for f in expected.fields] == [(f.name, f.dataType.simpleString()) for f in actual.fields]
    return actual.simpleString() == expected.simpleString()


def check_schema(df: DataFrame, contract: Contract) -> DataFrame:
    """Driver-side column-set and type check; casts when ``coerce``.  Returns the
    (possibly coerced) DataFrame with columns in contract order."""
    present = set(df.columns)
    expected = [f.name for f in contract.fields]
    failures: dict[str, object] = {}
    missing = [c for c in expected if c not in present]
    if missing:
        failures["missing columns"] = missing
    if contract.strict:
        extra = [c for c in df.columns if c not in expected]
        if extra:
            failures["unexpected columns"] = extra
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in contract.fields:
        if f.name not in present:
            continue
        c = F.col(f"`{f.name}`")
        if f.dtype is not None and not _type_ok(types[f.name], f.dtype):
            if contract.coerce:
                c = c.cast(f.dtype)
            else:
                failures[f"type of {f.name}"] = f"{types[f.name].simpleString()} != {f.dtype.simpleString()}"
        cols.append(c.alias(f.name))
    if failures:
        raise ContractError(contract.name, failures)
    if not contract.strict:
        cols += [F.col(f"`{c}`") for c in df.columns if c not in expected]
    return df.select(*cols)


def _sql_string(text: str) -> str:
    """A Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def violation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Lazy (rule, violations) table computed in a single aggregation pass."""
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, violations bigint")
    agg = df.agg(*[F.count_if(F.coalesce(r.violation, F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)])
    stack = ", ".join(f"{_sql_string(r.name)}, r{i}" for i, r in enumerate(rules))
    return agg.selectExpr(f"stack({len(rules)}, {stack}) as (rule, violations)")


def _raise_if_violations(df: DataFrame, contract: str, rules: Sequence[Rule], counts: dict[str, int], max_examples: int) -> None:
    bad = {name: n for name, n in counts.items() if n}
    if not bad:
        return
    failures: dict[str, object] = {}
    for r in rules:
        n = bad.get(r.name)
        if not n:
            continue
        detail: object = f"{n} row(s)"
        if r.example is not None and max_examples:
            ex = [row[0] for row in df.where(F.coalesce(r.violation, F.lit(False))).select(r.example).distinct().limit(max_examples).collect()]
            detail = f"{n} row(s), e.g. {ex}"
        failures[r.name] = detail
    raise ContractError(contract, failures)


def validate_rules(df: DataFrame, rules: Sequence[Rule], contract: str = "rules", max_examples: int = 5) -> None:
    """Evaluate rules in one pass and raise ``ContractError`` listing every failing rule."""
    counts = {r["rule"]: r["violations"] for r in violation_counts(df, rules).collect()}
    _raise_if_violations(df, contract, rules, counts, max_examples)


def apply_contract(df: DataFrame, contract: Contract, max_examples: int = 5) -> DataFrame:
    """I1 validate eagerly (schema on the driver, rules in one aggregation) and return the
    coerced DataFrame.  Persist ``df`` first when it is expensive and used again."""
    out = check_schema(df, contract)
    validate_rules(out, contract.row_rules(), contract.name, max_examples)
    return out


def observe_contract(df: DataFrame, contract: Contract) -> tuple[DataFrame, Observation, list[Rule]]:
    """Schema check now, rule counts collected as a side effect of the next action on
    the returned DataFrame (e.g. the publishing write): one read of the data."""
    out = check_schema(df, contract)
    rules = contract.row_rules()
    obs = Observation(f"contract_{contract.name}")
    if not rules:
        return out, obs, rules
    observed = out.observe(obs, *[F.count_if(F.coalesce(r.violation, F.lit(False))).alias(r.name) for r in rules])
    return observed, obs, rules


def raise_observed(df: DataFrame, contract: Contract, obs: Observation, rules: Sequence[Rule], max_examples: int = 5) -> None:
    """Raise when the observed counts show violations."""
    if not rules:
        return
    _raise_if_violations(df, contract.name, rules, {k: int(v) for k, v in obs.get.items()}, max_examples)


def components_sum_to_total(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str = "value",
    component_col: str = "Tariff component",
    total_label: str = "Total_GB average",
    decimals: int = 6,
    exact: bool = False,
) -> DataFrame:
    """I5 per group: sum of non-total components vs the total, both rounded.

    Missing side counts as 0 and an all-NULL sum is 0 (spreadsheet-tool sum).  A row with a
    NULL component is a component; several totals of a group are summed; halves round to even.
    With ``exact`` the sums are rounded once from their exact values (``operators.exact``), so
    the verdict depends neither on the order of the rows nor on their partitioning; else a
    single aggregation with conditional sums does it: one shuffle, partial sums map-side.
    Returns (group_cols, components, total, ok).
    """
    is_total = F.coalesce(F.col(f"`{component_col}`") == F.lit(total_label), F.lit(False))
    v = F.col(f"`{value_col}`")
    parts = {"components": F.when(~is_total, v), "total": F.when(is_total, v)}
    sums = exact_sums(df, group_cols, parts) if exact else df.groupBy(*[F.col(f"`{g}`") for g in group_cols]).agg(*[F.sum(c).alias(n) for n, c in parts.items()])
    grouped = sums.select(*[F.col(f"`{g}`") for g in group_cols], *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("components", "total")])
    return grouped.withColumn("ok", F.bround("components", decimals) == F.bround("total", decimals))


def require_components_sum(df: DataFrame, group_cols: Sequence[str], **kw) -> None:
    """Raise when any group's components do not sum to its total (exact sums)."""
    bad = components_sum_to_total(df, group_cols, **{"exact": True, **kw}).where(~F.col("ok"))
    examples = bad.limit(5).collect()
    if examples:
        raise ContractError("components_sum_to_total", {"groups": [r.asDict() for r in examples]})


def fresh_within_months(col: str, asof: Column, months: int = 3) -> Rule:
    """I10 (year*12 + month) of the as-of date minus that of the value must be <= ``months``;
    NULL or unparseable dates fail.  Future dates pass (negative difference)."""
    c = F.col(f"`{col}`")
    idx = lambda d: F.year(d) * 12 + F.month(d)
    return Rule(f"{col} within {months} months", c.isNull() | ((idx(asof) - idx(c)) > months), c.cast("string"))


def url_month_is(col: str, month: Column) -> Rule:
    """I9 the first yyyy-MM in the URL must equal ``month`` (e.g. the latest publication
    month as of a date); a URL without one fails."""
    c = F.col(f"`{col}`")
    found = F.regexp_extract(c, r"(\d{4}-\d{2})", 1)
    return Rule(f"{col} month", (found == "") | month.isNull() | (found != month), c)
