"""Versions of one table whose schemas differ, read as one table.

Types form a lattice per column: the type of a column over all versions is the smallest one that
holds every value of every version exactly.

* whole numbers widen to the larger one, ``float`` to ``double``; ``tinyint`` .. ``int`` widen to
  ``double``, ``bigint`` does not (it would lose digits);
* decimals widen to the one with enough digits on both sides, whole numbers beside decimals too;
* ``date`` widens to ``timestamp_ntz``; the ``void`` type of an all-NULL column to anything;
* structs join field by field, arrays and maps by their elements;
* anything else is a conflict, also a number beside a text: nothing is turned into text silently.

A column that a version lacks is NULL there.  Names are compared as Spark does (without case
unless ``spark.sql.caseSensitive``); the spelling and place of the first version stay.
A conflict names the column and the versions on both sides, and no data is read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetmill.sources import commits
from sheetmill.sources.files import SourceNotFound, layer_path

_WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}  # digits, narrowest first
_MAX_DIGITS = 38


class SchemaConflict(ValueError):
    """Two versions hold types for one column that no type of the lattice holds both of."""


class _NoCommonType(Exception):
    def __init__(self, path: tuple[str, ...]):
        self.path = path


def _decimal(t: T.DataType) -> T.DecimalType | None:
    if isinstance(t, T.DecimalType):
        return t
    return T.DecimalType(_WHOLE[t], 0) if t in _WHOLE else None


def _fold(name: str, case_sensitive: bool) -> str:
    return name if case_sensitive else name.lower()


def join_types(a: T.DataType, b: T.DataType, case_sensitive: bool = False) -> T.DataType:
    """The smallest type that holds both; raises for types without one."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return join_schemas(a, b, case_sensitive)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(join_types(a.elementType, b.elementType, case_sensitive), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        if a.keyType != b.keyType:  # a cast of keys could make two of them equal
            raise _NoCommonType(("key",))
        return T.MapType(a.keyType, join_types(a.valueType, b.valueType, case_sensitive), True)
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.__getitem__)
    pair = {type(a), type(b)}
    if pair <= {T.FloatType, T.DoubleType, T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    if pair == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    x, y = _decimal(a), _decimal(b)
    if x and y:
        scale = max(x.scale, y.scale)
        digits = max(x.precision - x.scale, y.precision - y.scale) + scale
        if digits <= _MAX_DIGITS:
            return T.DecimalType(digits, scale)
    raise _NoCommonType(())


def join_schemas(a: T.StructType, b: T.StructType, case_sensitive: bool = False) -> T.StructType:
    """Field by field; fields of ``b`` alone come last, and every field may be NULL."""
    right = {_fold(f.name, case_sensitive): f for f in b.fields}
    out = []
    for f in a.fields:
        other = right.pop(_fold(f.name, case_sensitive), None)
        try:
            kind = f.dataType if other is None else join_types(f.dataType, other.dataType, case_sensitive)
        except _NoCommonType as e:
            raise _NoCommonType((f.name, *e.path)) from None
        out.append(T.StructField(f.name, kind, True))
    return T.StructType(out + [T.StructField(f.name, f.dataType, True) for f in right.values()])


def _at(t: T.DataType, path: Iterable[str], case_sensitive: bool) -> T.DataType | None:
    """The type below a path of field names, ``None`` where it is missing."""
    for name in path:
        while isinstance(t, (T.ArrayType, T.MapType)):
            t = t.elementType if isinstance(t, T.ArrayType) else t.keyType if name == "key" else t.valueType
        if not isinstance(t, T.StructType):
            return t
        t = next((f.dataType for f in t.fields if _fold(f.name, case_sensitive) == _fold(name, case_sensitive)), None)
        if t is None:
            return None
    return t


def unified_schema(versions: Mapping[str, T.StructType], case_sensitive: bool = False) -> T.StructType:
    """The join of all versions' schemas, in the order given."""
    seen: list[tuple[str, T.StructType]] = []
    total: T.StructType | None = None
    for version, schema in versions.items():
        try:
            total = join_schemas(total or T.StructType([]), schema, case_sensitive)
        except _NoCommonType as e:
            mine = _at(schema, e.path, case_sensitive)
            kinds: dict[str, list[str]] = {}
            for v, s in seen:
                t = _at(s, e.path, case_sensitive)
                if t is not None:
                    kinds.setdefault(t.simpleString(), []).append(v)
            before = "; ".join(f"{k} in {', '.join(vs)}" for k, vs in kinds.items())
            raise SchemaConflict(f"column {'.'.join(e.path)}: {mine.simpleString() if mine else '?'} in {version} has no common type with {before}") from None
        seen.append((version, schema))
    return total or T.StructType([])


def conform(col: Column, have: T.DataType, want: T.DataType, case_sensitive: bool = False) -> Column:
    """A value of type ``have`` as ``want`` (a type above it in the lattice); NULL stays NULL at every depth."""
    if have == want:
        return col
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        there = {_fold(f.name, case_sensitive): f for f in have.fields}
        parts = []
        for f in want.fields:
            mine = there.get(_fold(f.name, case_sensitive))
            value = F.lit(None).cast(f.dataType) if mine is None else conform(col.getField(mine.name), mine.dataType, f.dataType, case_sensitive)
            parts.append(value.alias(f.name))
        return F.when(col.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(col, lambda x: conform(x, have.elementType, want.elementType, case_sensitive))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        return F.transform_values(col, lambda _, x: conform(x, have.valueType, want.valueType, case_sensitive))
    return col.cast(want)


def conform_table(df: DataFrame, want: T.StructType, case_sensitive: bool = False) -> DataFrame:
    """Columns of ``want``, widened and filled; other columns of ``df`` go."""
    there = {_fold(f.name, case_sensitive): f for f in df.schema.fields}
    cols = []
    for f in want.fields:
        mine = there.get(_fold(f.name, case_sensitive))
        quoted = None if mine is None else F.col(f"`{mine.name.replace('`', '``')}`")
        cols.append((F.lit(None).cast(f.dataType) if quoted is None else conform(quoted, mine.dataType, f.dataType, case_sensitive)).alias(f.name))
    return df.select(*cols)


def read_evolved(spark: SparkSession, root: str, layer: str, dataset: str, table: str, versions: list[str] | None = None) -> DataFrame:
    """All published versions (or those named) as one table of the joined schema, the version key as
    a string column beside it.

    Schemas come from the commit records (from the files for records without one), so no data
    is read before a conflict is found; versions of equal schema share one scan, filters and the
    version key prune each of them as usual."""
    base = layer_path(root, layer, dataset, "historical", table)
    found = commits.version_folders(spark, commits.commits_path(root, layer, dataset, table))
    if versions is not None:
        missing = [v for v in versions if v not in found]
        if missing:
            raise SourceNotFound(f"version {missing[0]} not published: {base}")
        found = {v: found[v] for v in versions}
    if not found:
        raise SourceNotFound(f"nothing published: {base}")
    case_sensitive = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    schemas = {
        v: T.StructType.fromJson(json.loads(c.schema)) if c.schema else spark.read.parquet(f"{base}/{c.folder}").schema
        for v, c in found.items()
    }
    want = unified_schema(schemas, case_sensitive)
    alike: dict[str, list[str]] = {}
    for v, schema in schemas.items():
        alike.setdefault(schema.json(), []).append(v)
    parts = []
    for vs in alike.values():
        schema = schemas[vs[0]]
        key = found[vs[0]].key
        data = spark.read.schema(T.StructType([*schema.fields, T.StructField(key, T.StringType())])).option("basePath", base)
        df = data.parquet(*[f"{base}/{found[v].folder}" for v in vs])
        parts.append(conform_table(df, T.StructType([*want.fields, T.StructField(key, T.StringType())]), case_sensitive))
    return reduce(DataFrame.unionByName, parts)
