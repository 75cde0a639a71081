"""Writing results: Parquet, CSV and the JSON-lines run report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.nested import column_of, drop_empty_types, is_nested, json_text
from corpusmill.functions.scalars import valid_text
from corpusmill.operators.profile import head

# Codec names callers may use, and what Spark calls them.
PARQUET_CODECS = {"zstd": "zstd", "snappy": "snappy", "gzip": "gzip", "lz4": "lz4_raw", "none": "uncompressed"}


def parquet_codec(name: str) -> str:
    if name.lower() == "brotli":
        raise ValueError("brotli needs a codec library that Spark does not ship; use zstd, snappy, gzip, lz4 or none")
    try:
        return PARQUET_CODECS[name.lower()]
    except KeyError:
        raise ValueError(f"unknown Parquet codec {name!r}; choose from {sorted(PARQUET_CODECS)}") from None


def write_parquet(
    df: DataFrame,
    path: str,
    compression: str = "zstd",
    partition_by: tuple[str, ...] = (),
    rows_per_file: int = 0,
    rows_per_group: int = 0,
    mode: str = "overwrite",
) -> int:
    """Write and return the number of rows written, counted on the way."""
    codec = parquet_codec(compression)
    seen = Observation()
    counted = drop_empty_types(df).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(mode).option("compression", codec)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if rows_per_group:
        writer = writer.option("parquet.block.row.count.limit", rows_per_group)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def spread_for_write(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of one output folder together in files of even size.

    AQE splits a folder that holds far more than the rest and joins the small ones.
    """
    return df.hint("rebalance", *columns)


def write_csv(
    df: DataFrame, path: str, n: int | None = None, mode: str = "overwrite", order_by: list[str] | None = None
) -> None:
    """CSV with a header, quotes doubled, missing values empty; nested columns as JSON text.

    ``n`` writes the first ``n`` rows, by ``order_by`` or in file order for a view of Parquet files.
    """
    if n is not None:
        df = head(df, n, order_by)
    columns = []
    for f in df.schema.fields:
        value = column_of(f.name)
        if is_nested(f.dataType):
            value = json_text(value, f.dataType)
        elif isinstance(f.dataType, T.BinaryType):
            value = valid_text(value)
        elif isinstance(f.dataType, T.BooleanType):
            value = F.initcap(value.cast("string"))
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            value = F.when(~F.isnan(value), value)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = value.cast("string")
        columns.append(value.alias(f.name))
    text = df.select(columns)
    (
        text.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_report(report: DataFrame, path: str) -> None:
    """JSON lines, replaced at each run: a row per input file and a few for the run."""
    report.write.mode("overwrite").json(path)
