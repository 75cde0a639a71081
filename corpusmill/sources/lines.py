"""Text lines of plain and compressed dumps as one DataFrame ``(path, value, error)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import paths as P
from corpusmill.functions.scalars import valid_text
from corpusmill.sources import decode

LINES_SCHEMA = "path string, value string, error string"


def sniff_codecs(files: DataFrame) -> DataFrame:
    """``path, length, codec`` for each listed file; two links to one local file count once."""
    spark = files.sparkSession
    narrow = files.select("path", "length").coalesce(max(1, 4 * spark.sparkContext.defaultParallelism))
    sniffed = narrow.mapInArrow(decode.sniff, decode.SNIFF_SCHEMA)
    return sniffed.groupBy("real_path").agg(
        F.min(F.struct("path", "length", "codec")).alias("f")
    ).select("f.*")


def stream_tasks(spark: SparkSession, streams: list[tuple[str, str]]) -> DataFrame:
    """``path, codec`` with every stream in a partition of its own, as no shuffle would place them."""
    return spark.createDataFrame(spark.sparkContext.parallelize(streams, len(streams)), "path string, codec string")


def read_lines(files: DataFrame) -> DataFrame:
    """Lines of all listed files, with ``error`` set on the one row that reports a broken file.

    Plain text goes through Spark's text source, which splits it. A compressed stream is decoded once, by a task of its
    own, longest first; its blocks of lines are then spread evenly, so that parsing uses all cores however few streams
    there are. Only file names pass through the driver, as they do for any Spark file scan.
    """
    spark = files.sparkSession
    found = sniff_codecs(files).collect()
    plain = [f.path for f in found if f.codec == "plain"]
    streams = [(f.path, f.codec) for f in sorted(found, key=lambda f: -f.length) if f.codec != "plain"]
    parts = []
    if streams:
        blocks = stream_tasks(spark, streams).mapInArrow(decode.decode_blocks, decode.BLOCKS_SCHEMA)
        lines = F.when(F.col("error").isNull(), F.split("lines", "\n")).otherwise(F.array(F.lit(None).cast("string")))
        parts.append(blocks.hint("rebalance").select("path", F.explode(lines).alias("value"), "error"))
    if plain:
        parts.append(_scan_text(spark, plain))
    if not parts:
        return spark.createDataFrame([], LINES_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def _scan_text(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.read.text([P.escape_glob(name) for name in names]).select(
        P.scanned_path().alias("path"),
        valid_text(F.col("value")).alias("value"),
        F.lit(None).cast("string").alias("error"),
    )


def lines_of(df: DataFrame, path: Column, value: Column) -> DataFrame:
    """Lines already at hand in a DataFrame, in the form :func:`read_lines` gives."""
    return df.select(path.alias("path"), value.alias("value"), F.lit(None).cast("string").alias("error"))
