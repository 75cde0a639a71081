"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_missing(column: Column, dtype: T.DataType) -> Column:
    """NULL and, for floating columns, NaN both count as missing."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def present(column: Column, dtype: T.DataType) -> Column:
    """The value, with every kind of missing turned into NULL."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(column), column)
    return column


def ne_keep_missing(column: Column, value) -> Column:
    """Inequality that keeps rows without a value, as data-frame filters do and SQL's ``<>`` does not."""
    return ~column.eqNullSafe(F.lit(value))


def human_bytes(size: Column) -> Column:
    """Bytes in 1024 steps with two decimals, from B to TB."""
    units = ["B", "KB", "MB", "GB", "TB"]
    text = F.lit(None).cast("string")
    for power, unit in reversed(list(enumerate(units))):
        scaled = size.cast("double") / F.lit(1024.0**power)
        here = F.format_string("%.2f " + unit, F.bround(scaled, 2))
        text = here if unit == units[-1] else F.when(scaled < 1024.0, here).otherwise(text)
    return F.when(size.isNotNull(), text)


def iso_seconds(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")


def iso_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssZ")


def percent(fraction: Column) -> Column:
    """A fraction as per cent text with two decimals."""
    return F.concat(F.format_string("%.2f", F.bround(fraction * 100, 2)), F.lit("%"))


def is_blank(text: Column) -> Column:
    """True when only Unicode white space (and the four ASCII separators) is left."""
    # the first test settles nearly every line without running a pattern over it
    return ~(text.startswith("{") | text.rlike(r"(?U)[^\s\x1C-\x1F]"))


def same_text(left: Column, right: Column) -> Column:
    return F.lower(left) == F.lower(right)


def valid_text(raw: Column) -> Column:
    """UTF-8 text with each invalid sequence replaced by U+FFFD."""
    return F.make_valid_utf8(raw.cast("string"))
