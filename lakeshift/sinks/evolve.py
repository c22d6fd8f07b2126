"""K2: one schema over versions whose columns were widened, added, dropped or nested anew.

Types form a lattice: every two either have a least type that holds the values of both
exactly, or conflict. Versions stay as they were written; a reader sees each through a
projection to the common schema.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaConflict(ValueError):
    """Two versions of a column have no type that holds the values of both exactly."""


_WHOLE: list[tuple[type, int]] = [(T.ByteType, 3), (T.ShortType, 5), (T.IntegerType, 10), (T.LongType, 19)]
#: Digits that a floating type holds exactly.
_EXACT = {T.FloatType: 7, T.DoubleType: 15}


def _digits(t: T.DataType) -> int | None:
    return next((d for k, d in _WHOLE if isinstance(t, k)), None)


def widest(a: T.DataType, b: T.DataType, at: str = "") -> T.DataType:
    """The least type that holds all values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b, at)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType, f"{at}[]"), a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widest(a.keyType, b.keyType, f"{at}.key"), widest(a.valueType, b.valueType, f"{at}.value"), a.valueContainsNull or b.valueContainsNull)
    x, y = _digits(a), _digits(b)
    if x and y:
        return a if x > y else b
    for p, q in ((a, b), (b, a)):
        if isinstance(p, T.DecimalType) and (isinstance(q, T.DecimalType) or _digits(q)):
            scale = max(p.scale, getattr(q, "scale", 0))
            whole = max(p.precision - p.scale, _digits(q) or q.precision - q.scale)
            if whole + scale <= 38:
                return T.DecimalType(whole + scale, scale)
        if isinstance(p, T.DoubleType) and isinstance(q, T.FloatType):
            return p
        if type(p) in _EXACT and (_digits(q) or 99) <= _EXACT[type(p)]:
            return p
        if isinstance(p, T.TimestampNTZType) and isinstance(q, T.DateType):
            return p
        if isinstance(p, T.StringType) and isinstance(q, (T.CharType, T.VarcharType)):
            return T.StringType()
    raise SchemaConflict(f"column {at or '?'}: {a.simpleString()} and {b.simpleString()} have no common type")


def merged(a: T.StructType, b: T.StructType, at: str = "") -> T.StructType:
    """Fields of ``a`` in their order, then those that only ``b`` has; all may be null."""
    theirs = {f.name: f for f in b.fields}
    out = []
    for f in a.fields:
        g = theirs.pop(f.name, None)
        path = f"{at}.{f.name}" if at else f.name
        out.append(T.StructField(f.name, widest(f.dataType, g.dataType, path) if g else f.dataType, True))
    return T.StructType([*out, *(T.StructField(g.name, g.dataType, True) for g in b.fields if g.name in theirs)])


def merged_schema(schemas: list[T.StructType]) -> T.StructType:
    """The common schema of versions, oldest first."""
    return reduce(merged, schemas, T.StructType([]))


def as_type(c: Column, old: T.DataType, new: T.DataType) -> Column:
    """A value of type ``old`` as ``new``: structs field by name, missing fields null."""
    if old == new:
        return c
    if isinstance(new, T.StructType) and isinstance(old, T.StructType):
        had = {f.name: f.dataType for f in old.fields}
        fields = [(as_type(c[f.name], had[f.name], f.dataType) if f.name in had else F.lit(None).cast(f.dataType)).alias(f.name) for f in new.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(new, T.ArrayType) and isinstance(old, T.ArrayType):
        return F.transform(c, lambda x: as_type(x, old.elementType, new.elementType))
    if isinstance(new, T.MapType) and isinstance(old, T.MapType):
        keys = F.transform(F.map_keys(c), lambda x: as_type(x, old.keyType, new.keyType))
        return F.map_from_arrays(keys, F.transform(F.map_values(c), lambda x: as_type(x, old.valueType, new.valueType)))
    return c.cast(new)


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and types of ``schema``: one projection."""
    had = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *((as_type(F.col(f"`{f.name}`"), had[f.name], f.dataType) if f.name in had else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields)
    )


def read_versions(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> DataFrame:
    """All rows of the versions (oldest first) under their common schema. Nothing is rewritten:
    a filter or a pruned column still reaches each version's own scan."""
    frames = [spark.read.format(fmt).load(p) for p in paths]
    schema = merged_schema([f.schema for f in frames])
    out = as_schema(frames[0], schema)
    for f in frames[1:]:
        out = out.unionByName(as_schema(f, schema))
    return out
