"""Facts about the files of a stored dataset."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import paths as P
from corpusmill.functions.scalars import human_bytes, iso_seconds
from corpusmill.sources.files import list_dataset
from corpusmill.sources.parquet import parquet_footers, read_parquet


# Buckets a range of sizes is cut into at a time.
RANK_BUCKETS = 1024


def value_at_rank(df: DataFrame, column: str, rank: int) -> int | None:
    """The value at a place (from 0) of a whole-number column in rising order, NULLs aside; None beyond its end.

    The range that holds the place is cut into buckets, and the bucket that holds it becomes the range, until it has one
    value: a job per step, of which every task hands on a counter per bucket, however many values there are.
    """
    values = df.select(F.col(column).cast("decimal(38,0)").alias("v")).where("v IS NOT NULL")
    low, high = values.agg(F.min("v"), F.max("v")).first()
    if low is None or rank < 0:
        return None
    low, high = int(low), int(high)
    while low < high:
        width = -(-(high - low + 1) // RANK_BUCKETS)
        bucket = F.floor((F.col("v") - F.lit(low).cast("decimal(38,0)")) / F.lit(width).cast("decimal(38,0)")).cast("int")
        inside = values.where(F.col("v").between(F.lit(low).cast("decimal(38,0)"), F.lit(high).cast("decimal(38,0)")))
        counts = inside.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        for row in sorted(counts.collect(), key=lambda r: r["b"]):
            if rank < row["n"]:
                low, high = int(row["low"]), int(row["high"])
                break
            rank -= row["n"]
        else:
            return None
    return low


# The names of the figures.
def file_stats(files: DataFrame) -> DataFrame:
    """One row: count, total, smallest, middle (upper), mean and largest size, and change times.

    The exact middle is looked up by rank, in a few jobs over the listing.
    """
    middle = value_at_rank(files, "length", files.count() // 2)
    zero = F.lit(0).cast("bigint")
    size = F.col("length")
    stats = files.agg(
        F.count(size).alias("file_count"),
        F.coalesce(F.sum(size), zero).alias("total_bytes"),
        F.coalesce(F.min(size), zero).alias("size_min_bytes"),
        F.lit(middle or 0).cast("bigint").alias("size_median_bytes"),
        F.coalesce(F.expr("sum(length) div count(length)"), zero).alias("size_avg_bytes"),
        F.coalesce(F.max(size), zero).alias("size_max_bytes"),
        iso_seconds(F.min("modified")).alias("mtime_earliest"),
        iso_seconds(F.max("modified")).alias("mtime_latest"),
    )
    named = ["total", "size_min", "size_median", "size_avg", "size_max"]
    empty = F.col("file_count") == 0
    return stats.withColumns(
        {
            f"{n}_human": human_bytes(F.col(f"{n}_bytes"))
            if n == "total"
            else F.when(empty, "0 B").otherwise(human_bytes(F.col(f"{n}_bytes")))
            for n in named
        }
    )


def extension_counts(files: DataFrame) -> DataFrame:
    label = F.when(F.col("ext") == "", "[no ext]").otherwise(F.col("ext"))
    counts = files.groupBy("ext").agg(F.count(F.lit(1)).alias("files"))
    return counts.orderBy(F.desc("files"), "ext").select(label.alias("ext"), "files")


def largest_files(files: DataFrame, root: str, n: int = 10) -> DataFrame:
    return (
        files.orderBy(F.desc("length"), "path")
        .limit(n)
        .select(
            P.relative_path(F.col("path"), root).alias("file"), "length", human_bytes(F.col("length")).alias("size")
        )
    )


def row_group_totals(footers: DataFrame) -> DataFrame:
    """Totals over all readable files, and how many could not be read."""
    readable = F.col("error").isNull()
    return footers.agg(
        F.coalesce(F.sum("num_row_groups"), F.lit(0)).alias("total_row_groups"),
        F.count_if(readable).alias("files_counted"),
        F.count_if(~readable).alias("files_unreadable"),
        F.coalesce(F.sum("num_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("total_byte_size"), F.lit(0)).alias("total_byte_size"),
    )


def most_row_groups(footers: DataFrame, root: str, n: int = 10) -> DataFrame:
    return (
        footers.filter(F.col("error").isNull())
        .orderBy(F.desc("num_row_groups"), "path")
        .limit(n)
        .select(P.relative_path(F.col("path"), root).alias("file"), "num_row_groups", "num_rows", "total_byte_size")
    )


def corpus_meta(spark: SparkSession, path: str) -> DataFrame:
    """One row: the dataset's path, shape, file statistics and files per extension.

    Files are listed once; row counts come from footers, no data is read.
    """
    here = P.local_path_part(path)
    columns = len(read_parquet(spark, path).columns)
    files = list_dataset(spark, path).persist()
    try:
        by_extension = {r["ext"]: r["files"] for r in extension_counts(files).collect()}  # a row per file ending
        rows = row_group_totals(parquet_footers(files)).first()["total_rows"]
        first = files.agg(F.min(P.path_part(F.col("path")))).first()[0]
        stats = file_stats(files).first()
    finally:
        files.unpersist()
    facts = {
        "path": here,
        "is_directory": (first or "") != here,
        "rows": rows,
        "cols": columns,
        **stats.asDict(),
        "ext_counts": json.dumps(by_extension, sort_keys=True, separators=(",", ":")),
    }
    kinds = {bool: "boolean", int: "bigint", str: "string", type(None): "string"}
    return spark.createDataFrame([tuple(facts.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in facts.items()))


def dataset_footers(spark: SparkSession, path: str) -> DataFrame:
    return parquet_footers(list_dataset(spark, path))
