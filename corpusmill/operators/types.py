"""One type for a column that files disagree about, and tolerant casts to it."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.nested import column_of, is_nested, json_text
from corpusmill.functions.scalars import valid_text


@dataclass(frozen=True)
class StoredType:
    """A column type as a file stores it.

    ``family`` is one of null, int, uint, float, timestamp, string, binary, other; ``detail`` tells
    types of a family apart (bit width, time zone); ``spark`` is the type Spark reads it as, in JSON.
    """

    family: str
    detail: str
    spark: str

    @property
    def dtype(self) -> T.DataType:
        return T._parse_datatype_json_string(self.spark)


@dataclass(frozen=True)
class TypeSummary:
    """What a column's stored types amount to, however many files there are; summaries merge field by field.

    ``families`` counts distinct types per family, null aside; ``widest`` is the largest bit width of whole numbers,
    ``zones`` holds the smallest and largest time zone, ``first`` and ``last`` the extremes of the types Spark reads.
    """

    families: frozenset[str]
    widest: int
    zones: tuple[str, str]
    first: str
    last: str

    @classmethod
    def of(cls, types: Iterable[StoredType]) -> TypeSummary:
        seen = [t for t in types if t.family != "null"]
        spark = [KIND_SEPARATOR.join((t.family, t.detail, t.spark)) for t in seen] or [""]
        zones = [t.detail for t in seen if t.family == "timestamp"] or [""]
        widths = [int(t.detail) for t in seen if t.family in WHOLE]
        return cls(frozenset(t.family for t in seen), max(widths, default=0), (min(zones), max(zones)), min(spark), max(spark))


KIND_SEPARATOR = "\x1f"
WHOLE = frozenset({"int", "uint"})
NUMERIC = WHOLE | {"float"}
_SIGNED = {8: T.ByteType(), 16: T.ShortType(), 32: T.IntegerType(), 64: T.LongType()}
# Unsigned numbers as Spark reads them.
_UNSIGNED = {8: T.ShortType(), 16: T.IntegerType(), 32: T.LongType(), 64: T.DecimalType(20, 0)}


def merged_type(seen: TypeSummary, fallback: str = "string", numeric_conflict: str = "double") -> T.DataType:
    """The type that holds everything a summary stands for.

    ``fallback`` ("string" or "float64") settles disagreements no rule covers. A number beside
    something that is not one gives DOUBLE, or STRING with ``numeric_conflict="string"``.
    """
    resort = {"string": T.StringType(), "float64": T.DoubleType()}.get(fallback)
    if resort is None:
        raise ValueError(f"fallback must be 'string' or 'float64', not {fallback!r}")
    if seen.families and seen.first == seen.last:
        return T._parse_datatype_json_string(seen.first.split(KIND_SEPARATOR)[2])
    mixed_numbers = T.DoubleType() if seen.families <= NUMERIC or numeric_conflict == "double" else T.StringType()
    one_zone = seen.zones[0] == seen.zones[1]
    of_one_family = {
        "int": _SIGNED.get(seen.widest),
        "uint": _UNSIGNED.get(seen.widest),
        "float": T.DoubleType(),
        "timestamp": (T.TimestampType() if seen.zones[0] else T.TimestampNTZType()) if one_zone else resort,
        "string": T.StringType(),
        "binary": T.BinaryType(),
        "other": resort,
    }
    if len(seen.families) == 1:
        return of_one_family[next(iter(seen.families))]
    if seen.families & NUMERIC:
        return mixed_numbers
    return T.StringType() if not seen.families or "string" in seen.families else resort


def common_type(types: Iterable[StoredType], fallback: str = "string", numeric_conflict: str = "double") -> T.DataType:
    """:func:`merged_type` of types at hand."""
    return merged_type(TypeSummary.of(types), fallback, numeric_conflict)


# ---- casts -------------------------------------------------------------------------------------

INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_TEXT = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


@lru_cache(maxsize=4096)
def _castable(source: str, target: str) -> bool:
    spark = SparkSession.getActiveSession()
    from_type, to_type = T._parse_datatype_json_string(source), T._parse_datatype_json_string(target)
    if isinstance(from_type, _TIMES) and isinstance(to_type, T.NumericType):
        return False  # a time has no number of its own
    try:
        spark.range(0).select(F.lit(None).cast(from_type).try_cast(to_type)).schema
        return True
    except AnalysisException:
        return False


def tolerant_cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast value by value; what does not fit becomes NULL, nested values become JSON text."""
    if source == target:
        return value
    if isinstance(source, T.NullType):
        return F.lit(None).cast(target)
    if isinstance(target, T.StringType):
        if is_nested(source):
            return json_text(value, source)
        if isinstance(source, T.BinaryType):
            return valid_text(value)
        return value.cast("string")
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        own = {f.name: f.dataType for f in source.fields}
        parts = [
            (
                tolerant_cast(value.getField(f.name), own[f.name], f.dataType)
                if f.name in own
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in target.fields
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(value, lambda x: tolerant_cast(x, source.elementType, target.elementType))
    if not _castable(source.json(), target.json()):
        return F.lit(None).cast(target)
    if isinstance(source, T.StringType) and isinstance(target, T.NumericType):
        # a failed cast costs an exception per row; and Java reads 1.5d as a number, which data does not mean
        value = F.when(value.rlike(INTEGER_TEXT if isinstance(target, T.IntegralType) else NUMBER_TEXT), value)
    return value.try_cast(target)


def align_to_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Exactly ``target``'s columns in its order: missing ones NULL, extra ones dropped, rest cast."""
    own = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        [
            (
                tolerant_cast(column_of(f.name), own[f.name], f.dataType)
                if f.name in own
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in target.fields
        ]
    )
