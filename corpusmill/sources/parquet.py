"""Parquet datasets: lazy reads, schemas, and footers read as a distributed job."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
import pyarrow.types as pat
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from corpusmill.sources.decode import ReadFailed, filesystem_of

FOOTER_SCHEMA = (
    "path string, num_rows long, num_row_groups int, total_byte_size long, "
    "columns array<struct<ordinal int, name string, family string, detail string, spark string>>, error string"
)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(columns) if columns else df


def parquet_schema(spark: SparkSession, path: str) -> T.StructType:
    """The schema of a Parquet file or folder; no data is read."""
    return spark.read.parquet(path).schema


def parquet_footers(files: DataFrame) -> DataFrame:
    """One row per listed file: row and row-group counts, stored bytes, column types, or the error."""
    tasks = max(1, 4 * files.sparkSession.sparkContext.defaultParallelism)
    # a footer is a few kilobytes: many files per task, whatever their size
    return files.select("path").coalesce(tasks).mapInArrow(read_footers, FOOTER_SCHEMA)


def read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    column = pa.struct(
        [
            ("ordinal", pa.int32()),
            ("name", pa.string()),
            ("family", pa.string()),
            ("detail", pa.string()),
            ("spark", pa.string()),
        ]
    )
    schema = pa.schema(
        [
            ("path", pa.string()),
            ("num_rows", pa.int64()),
            ("num_row_groups", pa.int32()),
            ("total_byte_size", pa.int64()),
            ("columns", pa.list_(column)),
            ("error", pa.string()),
        ]
    )
    for batch in batches:
        yield pa.RecordBatch.from_pylist([_footer(p) for p in batch.column("path").to_pylist()], schema=schema)


def _footer(path: str) -> dict:
    try:
        fs, name = filesystem_of(path)
        with fs.open_input_file(name) as source:
            meta = pq.read_metadata(source)
    except (pa.ArrowInvalid, PermissionError, FileNotFoundError) as error:
        return {"path": path, "error": f"{type(error).__name__}: {error}"}
    except Exception as error:
        raise ReadFailed(f"cannot read {path}: {error}") from error
    groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
    legacy_times = {
        meta.schema.column(i).path.split(".")[0]
        for i in range(meta.num_columns)
        if meta.schema.column(i).physical_type == "INT96"
    }
    return {
        "path": path,
        "num_rows": meta.num_rows,
        "num_row_groups": meta.num_row_groups,
        "total_byte_size": sum(g.total_byte_size for g in groups),
        "columns": [
            {"ordinal": i, "name": f.name, **stored_type(f.type, f.name in legacy_times)}
            for i, f in enumerate(meta.schema.to_arrow_schema())
        ],
    }


def stored_type(dtype: pa.DataType, legacy_times: bool = False) -> dict:
    """Family, detail and Spark type of an Arrow type (see ``operators.types.StoredType``)."""
    if pat.is_dictionary(dtype):
        dtype = dtype.value_type
    family, detail = "other", str(dtype)
    if pat.is_null(dtype):
        family, detail = "null", ""
    elif pat.is_signed_integer(dtype) or pat.is_unsigned_integer(dtype):
        family, detail = "int" if pat.is_signed_integer(dtype) else "uint", str(dtype.bit_width)
    elif pat.is_floating(dtype):
        family, detail = "float", str(dtype.bit_width)
    elif pat.is_timestamp(dtype):
        family, detail = "timestamp", dtype.tz or ""
    elif pat.is_string(dtype) or pat.is_large_string(dtype):
        family, detail = "string", ""
    elif pat.is_binary(dtype) or pat.is_large_binary(dtype):
        family, detail = "binary", ""
    spark = _spark_type(dtype, legacy_times)
    return {"family": family, "detail": detail, "spark": None if spark is None else json.dumps(spark)}


# Spark's names for Arrow's flat types.
_FLAT = {
    "null": "void",
    "bool": "boolean",
    "int8": "byte",
    "int16": "short",
    "int32": "integer",
    "int64": "long",
    "uint8": "short",
    "uint16": "integer",
    "uint32": "long",
    "uint64": "decimal(20,0)",
    "float": "float",
    "double": "double",
    "string": "string",
    "large_string": "string",
    "binary": "binary",
    "large_binary": "binary",
    "date32[day]": "date",
}


def _spark_type(dtype: pa.DataType, legacy_times: bool):
    """Spark's JSON form of the type it reads this column as; None where Spark has no type."""
    if str(dtype) in _FLAT:
        return _FLAT[str(dtype)]
    if pat.is_dictionary(dtype):
        return _spark_type(dtype.value_type, legacy_times)
    if pat.is_timestamp(dtype):
        if dtype.unit == "ns" and not legacy_times:
            return None
        return "timestamp" if dtype.tz or legacy_times else "timestamp_ntz"
    if pat.is_duration(dtype):
        return "long"
    if pat.is_decimal(dtype):
        return f"decimal({dtype.precision},{dtype.scale})" if dtype.precision <= 38 else None
    if pat.is_fixed_size_binary(dtype):
        return "binary"
    if pat.is_struct(dtype):
        fields = [{"name": f.name, "type": _spark_type(f.type, legacy_times), "nullable": True, "metadata": {}} for f in dtype]
        return None if any(f["type"] is None for f in fields) else {"type": "struct", "fields": fields}
    if pat.is_map(dtype):
        key, value = _spark_type(dtype.key_type, legacy_times), _spark_type(dtype.item_type, legacy_times)
        if key is None or value is None:
            return None
        return {"type": "map", "keyType": key, "valueType": value, "valueContainsNull": True}
    if pat.is_list(dtype) or pat.is_large_list(dtype) or pat.is_fixed_size_list(dtype):
        element = _spark_type(dtype.value_type, legacy_times)
        return None if element is None else {"type": "array", "elementType": element, "containsNull": True}
    return None
