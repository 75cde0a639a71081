"""Lines to records: tolerant JSON parsing, the topic filter, and light normalisation."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import paths as P
from corpusmill.functions.entities import html_unescape
from corpusmill.functions.nested import clean, column_of, prune_type
from corpusmill.functions.scalars import is_blank, same_text
from corpusmill.operators.shapes import MAX_KEYS, refuse_open_keys
from corpusmill.operators.types import tolerant_cast

# Field names the records are known to use.
TOPIC_FIELD = "subreddit"
DROPPED_FIELD = "edited"
TIME_FIELDS = ("created", "created_utc")
TEXT_FIELDS = ("title", "selftext", "body")

BAD, OTHER, MATCH, BROKEN, TOO_LARGE = "bad", "other", "match", "broken", "too_large"

# Plain JSON, with texts and numbers of any practical length.
MAX_DIGITS = 4300
JSON_OPTIONS = {"allowSingleQuotes": "false", "maxStringLen": str(2**31 - 1), "maxNumLen": str(MAX_DIGITS)}
# What a VARIANT can hold.
MAX_RECORD_BYTES = 128 << 20

# Objects keyed by data, read without a field per key.
MAP_TYPE = T.MapType(T.StringType(), T.StringType(), True)

_END = "~end-of-line~"


def _bracketed(line: Column) -> Column:
    """The line read as the head of a two-element list.

    Parsers stop after the first value, so a second element must still be there afterwards: text
    after the object then shows as an error.
    """
    wrapped = F.concat(F.lit("["), line, F.lit(f',"{_END}"]'))
    return F.from_json(wrapped, T.ArrayType(T.VariantType()), JSON_OPTIONS)


def _starts_object(line: Column) -> Column:
    return line.startswith("{") | F.ltrim(line, F.lit(" \t")).startswith("{")


def _only_object(pair: Column, starts_object: Column) -> Column:
    whole = (F.size(pair) == 2) & (F.try_variant_get(F.get(pair, F.lit(1)), "$", "string") == _END)
    return F.when(starts_object & whole, F.get(pair, F.lit(0)))


def _beyond_limits(line: Column) -> Column:
    """True for a line that no parse can settle; looked at for unparsed lines only."""
    return (F.octet_length(line) > MAX_RECORD_BYTES) | line.rlike(f"[0-9]{{{MAX_DIGITS + 1}}}")


def field_path(name: str) -> str:
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def string_field(record: Column, name: str) -> Column:
    """A top-level field, only when the record holds it as a string."""
    text = F.try_variant_get(record, field_path(name), "string")
    kind = F.schema_of_variant(F.try_variant_get(record, field_path(name), "variant"))
    return F.when(kind == "STRING", text)


def is_topic(record: Column, topic: str, field: str = TOPIC_FIELD) -> Column:
    """True when the field is a string equal to ``topic`` in any case."""
    text = F.try_variant_get(record, field_path(field), "string")
    kind = F.schema_of_variant(F.try_variant_get(record, field_path(field), "variant"))
    # the cheap comparison goes first: the kind is looked up for equal texts only
    return F.coalesce(same_text(text, F.lit(topic)) & (kind == "STRING"), F.lit(False))


def classify_lines(lines: DataFrame, topic: str, field: str = TOPIC_FIELD) -> DataFrame:
    """``(path, status, record, error)`` for every line that is not blank.

    ``status`` is ``match``, ``other``, ``bad`` (not one JSON object), ``too_large`` (beyond what can be parsed, so it
    cannot be told; ``error`` says how long it is) or ``broken`` (a file that could not be read to its end). ``record``
    is set on matches only.
    """
    broken, text = F.col("error").isNotNull(), F.col("value")

    def judged(record: Column) -> Column:
        unread = F.when(_beyond_limits(text), TOO_LARGE).otherwise(BAD)
        status = F.when(record.isNull(), unread).when(is_topic(record, topic, field), MATCH).otherwise(OTHER)
        return F.struct(status.alias("verdict"), record.alias("parsed"))

    # Each step names the result of the one before, and a generator ends them, so that a line is
    # parsed and judged once: as plain expressions they would be repeated in every filter above.
    pairs = F.array(_bracketed(text))
    objects = F.transform(pairs, lambda pair: _only_object(pair, _starts_object(text)))
    verdicts = lines.filter(broken | ~is_blank(text)).select(
        "path", "error", F.octet_length(text).alias("bytes"), F.inline(F.transform(objects, judged))
    )
    return verdicts.select(
        "path",
        F.when(broken, BROKEN).otherwise(F.col("verdict")).alias("status"),
        F.when(F.col("verdict") == MATCH, F.col("parsed")).alias("record"),
        F.when(F.col("verdict") == TOO_LARGE, F.concat(F.lit("a line of "), F.col("bytes"), F.lit(" bytes")))
        .otherwise(F.col("error"))
        .alias("error"),
    )


def ingest_counts(classified: DataFrame) -> DataFrame:
    """Per file: ``lines_total, bad_json, too_large, matched``. Counted in hash tables on the map side."""
    status = F.col("status")
    return classified.groupBy("path").agg(
        F.count_if(status != BROKEN).alias("lines_total"),
        F.count_if(status == BAD).alias("bad_json"),
        F.count_if(status == TOO_LARGE).alias("too_large"),
        F.count_if(status == MATCH).alias("matched"),
    )


def read_errors(classified: DataFrame) -> DataFrame:
    """``(path, error)`` of the files that could not be read to their end.

    Apart from the counters, because text cannot be kept in the counters' hash tables: one text
    column among them would make Spark sort all lines by file.
    """
    return classified.filter(F.col("status") == BROKEN).groupBy("path").agg(F.max("error").alias("error"))


def count_totals(counts: DataFrame) -> DataFrame:
    """Per-file counters with one more row, ``path`` NULL, for the whole run."""
    return counts.rollup("path").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("lines_total", "bad_json", "too_large", "matched"))
    )


# ---- typing ------------------------------------------------------------------------------------


def _spark_type(dtype: T.DataType) -> T.DataType:
    """Parquet-friendly form of an inferred type: decimals with a fraction become doubles, mixed
    values become text, integers beyond 64 bits stay exact."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _spark_type(f.dataType), True) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_spark_type(dtype.elementType), True)
    if isinstance(dtype, T.DecimalType):
        return dtype if dtype.scale == 0 and dtype.precision > 18 else T.DoubleType()
    if isinstance(dtype, T.VariantType):
        return T.StringType()
    return dtype


def record_schema(
    records: DataFrame,
    column: str = "record",
    map_fields: Iterable[str] = (),
    json_fields: Iterable[str] = (),
    max_keys: int = MAX_KEYS,
) -> T.StructType:
    """One schema that holds all records: the union of their fields, conflicts widened.

    A distributed aggregation; fields without a value in any record are left out. Where some time
    value is no number, the schema also gets a text column for it.
    """
    return inferred_fields(records, column, map_fields, json_fields, max_keys)[0]


def _without(record: Column, names: Iterable[str]) -> Column:
    """The record's fields but for some, so that inference does not see them."""
    names = list(names)
    if not names:
        return record
    fields = F.try_variant_get(record, "$", "map<string,variant>")
    return F.to_variant_object(F.map_filter(fields, lambda name, _: ~name.isin(names)))


def inferred_fields(
    records: DataFrame,
    column: str = "record",
    map_fields: Iterable[str] = (),
    json_fields: Iterable[str] = (),
    max_keys: int = MAX_KEYS,
) -> tuple[T.StructType, list[str]]:
    """:func:`record_schema`, and the names of the fields it leaves out.

    Objects whose keys are data, such as a table of ids, would give the schema a field per key: named in
    ``map_fields`` they become MAPs of JSON text, in ``json_fields`` JSON text. One with more than ``max_keys`` keys that
    is named in neither is an error (:class:`~corpusmill.operators.shapes.OpenKeys`), raised before any schema is built.
    """
    record, keyed = F.col(column), {**dict.fromkeys(map_fields, MAP_TYPE), **dict.fromkeys(json_fields, T.StringType())}
    odd_times = [F.bool_or(_raw_time(record, name).isNotNull()) for name in TIME_FIELDS]
    refuse_open_keys(records, _without(record, keyed), max_keys)
    inferred = F.schema_of_variant_agg(_without(record, keyed))
    found, *odd = records.agg(inferred, *odd_times).first()
    if not found or not found.startswith("OBJECT<"):
        return T.StructType([T.StructField(name, dtype, True) for name, dtype in sorted(keyed.items())] if found else []), []
    # the function spells structs OBJECT; names are back-quoted wherever they need it
    ddl = re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found)
    seen = T.DataType.fromDDL(ddl)
    kept = prune_type(seen) or T.StructType([])
    raw = {raw_name(name): needed for name, needed in zip(TIME_FIELDS, odd)}
    fields = [T.StructField(f.name, _spark_type(f.dataType), True) for f in kept.fields if not raw.get(f.name)]
    fields += [T.StructField(name, T.StringType(), True) for name, needed in raw.items() if needed]
    fields += [T.StructField(name, dtype, True) for name, dtype in keyed.items()]
    return T.StructType(sorted(fields, key=lambda f: f.name) if keyed else fields), [
        name for name in seen.names if name not in set(kept.names)
    ]


def raw_name(field: str) -> str:
    return f"_{field}_raw"


def _time_text(record: Column, name: str) -> Column:
    return F.try_variant_get(record, field_path(name), "string")


def _time(record: Column, name: str) -> Column:
    """Numbers lose their fraction, integer text is read, anything else is NULL."""
    # a failed cast costs an exception per row, so hopeless texts do not get that far
    hopeful = _time_text(record, name).rlike(r"^\s*([+-]?[0-9]|true$|false$)")
    return F.when(hopeful, F.try_variant_get(record, field_path(name), "bigint"))


def _raw_time(record: Column, name: str) -> Column:
    return F.when(_time(record, name).isNull(), _time_text(record, name))


def typed_records(records: DataFrame, schema: T.StructType, column: str = "record") -> DataFrame:
    """Expand the VARIANT column into ``schema``'s columns, in normal form, with provenance."""
    record = F.col(column)
    raw_fields = {raw_name(name): name for name in TIME_FIELDS}
    plain = T.StructType(
        [
            f
            for f in schema.fields
            if f.name not in TIME_FIELDS
            and f.name not in raw_fields
            and f.name not in (DROPPED_FIELD, "_source_path")
            and not isinstance(f.dataType, T.MapType)
        ]
    )
    # one pass over the record's fields for all columns
    wide = [F.col("path").alias("_source_path"), record.alias("__record")]
    if plain.fields:
        wide.append(F.try_variant_get(record, "$", type_text(plain)).alias("__fields"))
    out = []
    for f in schema.fields:
        if f.name in TIME_FIELDS:
            out.append(_time(F.col("__record"), f.name).alias(f.name))
        elif f.name in raw_fields:
            out.append(_raw_time(F.col("__record"), raw_fields[f.name]).alias(f.name))
        elif isinstance(f.dataType, T.MapType):
            out.append(F.try_variant_get("__record", field_path(f.name), type_text(f.dataType)).alias(f.name))
        elif f in plain.fields:
            out.append(_normal(F.col("__fields").getField(f.name), f).alias(f.name))
    return with_provenance(records.select(wide).select(*out, "_source_path"))


def type_text(dtype: T.DataType) -> str:
    """A type in the form SQL functions take it, every name quoted."""
    if isinstance(dtype, T.StructType):
        parts = ("`" + f.name.replace("`", "``") + "`: " + type_text(f.dataType) for f in dtype.fields)
        return "STRUCT<" + ", ".join(parts) + ">"
    if isinstance(dtype, T.ArrayType):
        return f"ARRAY<{type_text(dtype.elementType)}>"
    if isinstance(dtype, T.MapType):
        return f"MAP<STRING, {type_text(dtype.valueType)}>"
    return dtype.simpleString()


def _normal(value: Column, field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType):
        if field.name == TOPIC_FIELD:
            return F.lower(value)
        if field.name in TEXT_FIELDS:
            return html_unescape(value)
    return clean(value, field.dataType)


def with_provenance(df: DataFrame) -> DataFrame:
    """Add the ``_kind`` and ``_month`` that the name in ``_source_path`` carries."""
    name = P.base_name(F.col("_source_path"))
    found = {"_kind": P.dump_kind(name), "_month": P.dump_month(name)}
    for label, value in found.items():
        if label in df.columns:
            found[label] = F.coalesce(value, column_of(label))
    return df.withColumns(found)


def normalize(df: DataFrame) -> DataFrame:
    """The same light normal form for a DataFrame that already has typed columns."""
    out = []
    for f in df.schema.fields:
        value = column_of(f.name)
        if f.name == DROPPED_FIELD:
            continue
        if f.name in TIME_FIELDS:
            number = tolerant_cast(value, f.dataType, T.LongType())
            out.append(number.alias(f.name))
            if not isinstance(f.dataType, T.IntegralType):
                out.append(F.when(number.isNull(), value.cast("string")).alias(f"_{f.name}_raw"))
        elif isinstance(f.dataType, T.StringType) and f.name == TOPIC_FIELD:
            out.append(F.lower(value).alias(f.name))
        elif isinstance(f.dataType, T.StringType) and f.name in TEXT_FIELDS:
            out.append(html_unescape(value).alias(f.name))
        else:
            out.append(value.alias(f.name))
    return df.select(out)
