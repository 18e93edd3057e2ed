"""String helpers: Column expressions for cell values, plain Python for column names.

Column names are schema metadata held by the driver, so renaming them is a cheap
driver-side step; cell values are always transformed with JVM-side expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_in_order(c: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Literal substring replacements applied one after another (order matters)."""
    out = c
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def extract_or_null(c: Column | str, pattern: str, idx: int = 0) -> Column:
    """regexp_extract that yields NULL (not '') when there is no match."""
    s = _col(c)
    return F.when(s.rlike(pattern), F.regexp_extract(s, pattern, idx))


def strip(c: Column | str) -> Column:
    """Strip leading and trailing whitespace (tabs and newlines too, not only blanks); one scan
    from either end."""
    return F.trim(_col(c), F.lit(" \t\n\x0b\f\r"))


def clean_header(c: Column | str) -> Column:
    """C9 strip the outer whitespace, then drop newlines inside the header text."""
    return F.regexp_replace(strip(c), "\n", "")


def standardise_name(name: str) -> str:
    """D7 strip, lower case, whitespace runs -> '_', any other non-word character -> '_'."""
    out = re.sub(r"\s+", "_", name.strip().lower())
    return re.sub(r"[^\w]", "_", out)


def slugify(name: str) -> str:
    """J11 table-name slug: lower case, '.' and ' ' -> '_'."""
    return name.lower().replace(".", "_").replace(" ", "_")


def slugify_col(c: Column | str) -> Column:
    """J11 the same slug as a column expression (for tables of names, e.g. landed files)."""
    return F.translate(F.lower(_col(c)), ". ", "__")


def starts_with_ci(c: Column | str, prefix: str) -> Column:
    """I11 case-insensitive prefix test."""
    return F.startswith(F.lower(_col(c)), F.lit(prefix.lower()))


def ends_with_ci(c: Column | str, suffix: str) -> Column:
    """I12 case-insensitive suffix test (e.g. file extension)."""
    return F.endswith(F.lower(_col(c)), F.lit(suffix.lower()))


#: Last segments to look at again: none, or one that a pattern's ``$`` lets stand after it.
_NO_SEGMENT = ("", "\n", "\r", "\r\n", "\x85", "\u2028", "\u2029")


def basename(c: Column | str) -> Column:
    """A11 last path segment of a URL or path, ignoring trailing slashes ('' when none).

    Cut out behind the last slash; only where no name stands there the path goes through the
    pattern, which is tried at the beginnings of segments alone and does not step back."""
    path = _col(c)
    last = F.substring_index(path, "/", -1)
    return F.when(last.isin(*_NO_SEGMENT), F.regexp_extract(path, r"(?<![^/])([^/]*+)/*+$", 1)).otherwise(last)


def citation(*parts: Column | str) -> Column:
    """J14 format a citation from literal text and columns, NULL parts rendered as ''."""
    cols = [F.coalesce(p, F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat(*cols)


def unescape_html(c: Column) -> Column:
    """Decode the five predefined XML entities (what an HTML parser does for text nodes)."""
    return replace_in_order(c, [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")])


def strip_tags(c: Column) -> Column:
    """Text content of an HTML fragment: tags removed, entities decoded."""
    return unescape_html(F.regexp_replace(c, r"<[^>]*>", ""))
