"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetmill.session import scratch_path

#: Word separators of the text contracts: space and \t \n \v \f \r.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.  A plain column used inside a
    higher-order function can be inlined and evaluated once per element; a lambda variable
    cannot."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct, so that no working column can clash with them."""
    return F.struct(*[F.col(quoted(c)) for c in docs.columns])


def text_of(text_col: str = "text") -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.array_remove(F.split(text, BLANKS), "")


def gather(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of the variable-length rows ``which`` of (flat, sizes), and their sizes."""
    starts = np.r_[0, np.cumsum(sizes)][:-1]
    lengths = sizes[which]
    total = int(lengths.sum())
    if not total:
        return flat[:0], lengths
    ends = np.cumsum(lengths)
    index = np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts[which], lengths)
    return flat[index], lengths


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once under the shared checkpoint folder and read back, and its path (for
    ``session.remove_path`` once nothing reads it any more)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def takes_part(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    x = lambda c: c.cast("double")
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(x(c)) | (F.abs(x(c)) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def integer_components(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component."""
    return F.transform(vector, lambda c: F.floor(scale * c.cast("double")).cast("long"))


def exact_type(most: int) -> type:
    """A number type in which sums up to ``most`` are exact."""
    if most < 1 << 53:
        return np.float64
    if most < 1 << 62:
        return np.int64
    raise ValueError("vector components are too large for exact 64-bit arithmetic")


def as_lists(rows: np.ndarray) -> pa.ListArray:
    """A matrix as an Arrow list column, one list per row."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel()))
