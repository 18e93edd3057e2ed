"""Numeric helpers with spreadsheet-tool semantics, kept JVM-side.

Spark runs with ANSI mode on: ``x / 0`` and bad casts raise.  These helpers state the
intended result explicitly instead of relying on floating-point defaults.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str, inf_as_null: bool = False) -> Column:
    """num / den with float semantics: x/0 -> +-inf (NULL when ``inf_as_null``), 0/0 -> NULL."""
    n, d = _col(num), _col(den)
    at_zero = F.lit(None).cast("double")
    if not inf_as_null:
        at_zero = F.when(n > 0, F.lit(float("inf"))).when(n < 0, F.lit(float("-inf")))
    return F.when(d == 0, at_zero).otherwise(n.cast("double") / d)


def no_nan(c: Column | str) -> Column:
    """NaN -> NULL (Spark treats NaN as a value, the tidy tables use NULL only)."""
    x = _col(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def inf_to_null(c: Column | str) -> Column:
    x = _col(c)
    return F.when(x.isin(float("inf"), float("-inf")), F.lit(None)).otherwise(x)


def to_number(c: Column | str) -> Column:
    """E9 coerce text to DOUBLE; anything unparseable (or NaN) becomes NULL."""
    return no_nan(_col(c).cast("string").try_cast("double"))


def round_half_even(c: Column | str, decimals: int) -> Column:
    """J13 banker's rounding, the rounding numeric array libraries use."""
    return F.bround(_col(c), decimals)


def strict_cast(c: Column | str, dtype: str) -> Column:
    """E10 cast that fails the job on bad input (ANSI); double -> bigint truncates toward zero."""
    return _col(c).cast(dtype)
