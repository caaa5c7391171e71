"""Differences of nested values, named by their paths: a comparison compiled from two schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FOUND = "array<struct<path:string,size:double>>"
TOLERANCE = 1e-12


def _one(path: Column, size: Column | None = None) -> Column:
    return F.array(F.struct(path.alias("path"), (F.lit(None) if size is None else size).cast("double").alias("size")))


def _none() -> Column:
    return F.array().cast(_FOUND)


def _below(path: Column, name: Column) -> Column:
    return F.when(path == "", name).otherwise(F.concat(path, F.lit("."), name))


def _walk(a: Column, b: Column, ta: T.DataType, tb: T.DataType, path: Column, tolerance: float) -> Column:
    """(path, size) of each place below ``path`` where the values differ; size only for numbers compared with a tolerance."""
    both, neither = a.isNotNull() & b.isNotNull(), a.isNull() & b.isNull()
    other = F.when(neither, _none()).otherwise(_one(path))
    if isinstance(ta, T.StructType) and isinstance(tb, T.StructType):
        parts = []
        for name in sorted({*ta.names, *tb.names}):
            fields = [(t[name].dataType, x[name]) if name in t.names else (T.NullType(), F.lit(None)) for t, x in ((ta, a), (tb, b))]
            parts.append(_walk(fields[0][1], fields[1][1], fields[0][0], fields[1][0], _below(path, F.lit(name)), tolerance))
        return F.when(both, F.concat(*parts) if parts else _none()).otherwise(other)
    if isinstance(ta, T.ArrayType) and isinstance(tb, T.ArrayType):
        at = lambda i: F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
        pairs = F.transform(F.sequence(F.lit(0), F.size(a) - 1), lambda i: _walk(F.get(a, i), F.get(b, i), ta.elementType, tb.elementType, at(i), tolerance))
        same = F.when(F.size(a) == 0, _none()).otherwise(F.flatten(pairs))
        return F.when(both & (F.size(a) == F.size(b)), same).otherwise(other)
    if isinstance(ta, T.MapType) and isinstance(tb, T.MapType):
        keys = F.array_sort(F.array_union(F.map_keys(a), F.map_keys(b)))
        own = F.transform(keys, lambda k: _walk(F.try_element_at(a, k), F.try_element_at(b, k), ta.valueType, tb.valueType, _below(path, k.cast("string")), tolerance))
        return F.when(both, F.flatten(own)).otherwise(other)
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(ta, nested) or isinstance(tb, nested):
        return other
    floats = (T.DoubleType, T.FloatType)
    if isinstance(ta, floats) and isinstance(tb, floats):
        x, y = a.cast("double"), b.cast("double")
        close = F.when(F.isnan(x) | F.isnan(y), F.lit(False)).otherwise((x == y) | (F.abs(x - y) <= tolerance))
        return F.when(both & ~close, _one(path, F.abs(x - y))).when(both, _none()).otherwise(other)
    return F.when(a.eqNullSafe(b), _none()).otherwise(_one(path))


def differences(a: Column, b: Column, type_a: T.DataType, type_b: T.DataType, tolerance: float = TOLERANCE) -> Column:
    """An array of (path, size): where two values of the given types differ.

    Fields and keys that one side lacks are null there; arrays of unlike lengths differ as a whole; two floating-point
    numbers differ if they are more than ``tolerance`` apart or one isn't a number; all else must be equal.
    """
    return _walk(a, b, type_a, type_b, F.lit(""), tolerance)


def nested_differences(actual: DataFrame, recorded: DataFrame, keys: list[str], tolerance: float = TOLERANCE) -> DataFrame:
    """keys and ``differs`` of the rows that differ; a row that one side lacks differs at ``missing``."""
    types = [T.StructType([f for f in d.schema.fields if f.name not in keys]) for d in (actual, recorded)]
    sides = [d.select(*keys, F.struct(*[F.col(n) for n in t.names]).alias(s)) for d, t, s in ((actual, types[0], "__a"), (recorded, types[1], "__b"))]
    both = sides[0].join(sides[1], keys, "full")
    lost = F.col("__a").isNull() | F.col("__b").isNull()
    found = F.when(lost, _one(F.lit("missing"))).otherwise(differences(F.col("__a"), F.col("__b"), *types, tolerance))
    return both.select(*keys, found.alias("differs")).where(F.size("differs") > 0)


def by_path(found: DataFrame) -> DataFrame:
    """path, rows and the largest size; places in arrays are counted together as ``[]``."""
    one = found.select(F.explode("differs").alias("d")).select(F.regexp_replace("d.path", r"\[\d+\]", "[]").alias("path"), "d.size")
    return one.groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("largest"))
