"""Cleaning and serialising nested values with expressions built from their type."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.scalars import valid_text


# ---- empty types -------------------------------------------------------------------------------


def prune_type(dtype: T.DataType) -> T.DataType | None:
    """The type without parts that can never hold a value; ``None`` when nothing is left."""
    if isinstance(dtype, T.NullType):
        return None
    if isinstance(dtype, T.StructType):
        kept = [(f, prune_type(f.dataType)) for f in dtype.fields]
        fields = [T.StructField(f.name, t, True) for f, t in kept if t is not None]
        return T.StructType(fields) if fields else None
    if isinstance(dtype, T.ArrayType):
        element = prune_type(dtype.elementType)
        return T.ArrayType(element, True) if element is not None else None
    if isinstance(dtype, T.MapType):
        value = prune_type(dtype.valueType)
        return T.MapType(dtype.keyType, value, True) if value is not None else None
    return dtype


def reshape(column: Column, dtype: T.DataType, target: T.DataType) -> Column:
    """Keep only the parts of a value that ``target``, a pruned form of ``dtype``, still has."""
    if dtype == target:
        return column
    if isinstance(dtype, T.StructType):
        parts = [
            reshape(column.getField(f.name), dtype[f.name].dataType, f.dataType).alias(f.name)
            for f in target.fields
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(dtype, T.ArrayType):
        return F.transform(column, lambda x: reshape(x, dtype.elementType, target.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(column, lambda k, v: reshape(v, dtype.valueType, target.valueType))
    return column


def drop_empty_types(df: DataFrame) -> DataFrame:
    """Remove NULL-typed and field-less parts, which Parquet cannot store, at any depth."""
    columns = []
    for field in df.schema.fields:
        target = prune_type(field.dataType)
        if target is not None:
            columns.append(reshape(column_of(field.name), field.dataType, target).alias(field.name))
    return df.select(columns)


# ---- empty values ------------------------------------------------------------------------------


def holds_value(column: Column, dtype: T.DataType) -> Column:
    """True when some leaf below this value is not NULL; empty structs and lists hold nothing."""
    if isinstance(dtype, T.StructType):
        inside = [holds_value(column.getField(f.name), f.dataType) for f in dtype.fields]
        return column.isNotNull() & reduce(or_, inside, F.lit(False))
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.exists(column, lambda x: holds_value(x, dtype.elementType)), F.lit(False))
    if isinstance(dtype, T.MapType):
        return F.coalesce(
            F.exists(F.map_values(column), lambda x: holds_value(x, dtype.valueType)), F.lit(False)
        )
    if isinstance(dtype, T.NullType):
        return F.lit(False)
    return column.isNotNull()


def clean(column: Column, dtype: T.DataType) -> Column:
    """Turn values that hold nothing into NULL at every depth; list elements keep their place."""
    if isinstance(dtype, T.StructType):
        parts = [clean(column.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(holds_value(column, dtype), F.struct(*parts))
    if isinstance(dtype, T.ArrayType):
        cleaned = column
        if is_nested(dtype.elementType):
            cleaned = F.transform(column, lambda x: clean(x, dtype.elementType))
        return F.when(holds_value(column, dtype), cleaned)
    if isinstance(dtype, T.MapType):
        kept = F.map_filter(column, lambda k, v: holds_value(v, dtype.valueType))
        if is_nested(dtype.valueType):
            kept = F.transform_values(kept, lambda k, v: clean(v, dtype.valueType))
        return F.when(holds_value(column, dtype), kept)
    return column


def sanitize(df: DataFrame) -> DataFrame:
    """Make every column storable: no empty types, and no empty structs or lists among the values."""
    typed = drop_empty_types(df)
    return typed.select([clean(column_of(f.name), f.dataType).alias(f.name) for f in typed.schema.fields])


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Leave out columns that hold a value in no row. Costs one aggregation over ``df``."""
    tests = [F.bool_or(holds_value(column_of(f.name), f.dataType)).alias(f.name) for f in df.schema.fields]
    if not tests:
        return df
    used = df.agg(*tests).first()
    return df.select([column_of(f.name) for f, keep in zip(df.schema.fields, used) if keep])


# ---- text form ---------------------------------------------------------------------------------


def _readable(column: Column, dtype: T.DataType) -> Column:
    """The same value with binary leaves decoded, so that JSON shows their text."""
    if isinstance(dtype, T.BinaryType):
        return valid_text(column)
    if isinstance(dtype, T.StructType) and _has_binary(dtype):
        parts = [_readable(column.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(dtype, T.ArrayType) and _has_binary(dtype):
        return F.transform(column, lambda x: _readable(x, dtype.elementType))
    if isinstance(dtype, T.MapType) and _has_binary(dtype):
        return F.transform_values(column, lambda k, v: _readable(v, dtype.valueType))
    return column


def _has_binary(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_binary(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has_binary(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _has_binary(dtype.valueType)
    return isinstance(dtype, T.BinaryType)


def json_text(column: Column, dtype: T.DataType) -> Column:
    """A nested value as JSON text that keeps its NULL fields; NULL stays NULL."""
    return F.to_json(_readable(column, dtype), {"ignoreNullFields": "false"})


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def column_of(name: str) -> Column:
    """A top-level column whose name may hold dots or back-ticks."""
    return F.col(_quoted(name))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
