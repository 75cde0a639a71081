"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import scratch_dir

# The white space that separates words, as a Java regular expression class and as SQL text.
BLANKS = r"\x20\x09-\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stage(df: DataFrame, purpose: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write to the shared scratch folder and read back: later steps start from files any executor can read."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(text: str) -> Column:
    """The text as bytes, NULL as empty: what the byte-wise tasks read."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b"").cast("binary"))


def sha256_hex(column: Column) -> Column:
    return F.sha2(column, 256)
