"""From a folder of Parquet files with differing schemas to one table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import paths as P
from corpusmill.operators.union import union_files
from corpusmill.plans.build import refuse_below
from corpusmill.session import prepare
from corpusmill.sinks.write import parquet_codec, write_parquet
from corpusmill.sources.files import list_files, refuse_hidden


@dataclass(frozen=True)
class MergeResult:
    out: str
    files: int
    rows: int
    columns: int


def merge_folder(
    spark: SparkSession,
    folder: str,
    out: str,
    pattern: str = "**/*.parquet",
    compression: str = "snappy",
    rows_per_group: int = 1_000_000,
    order: str = "first_seen",
    fallback: str = "string",
    numeric_conflict: str = "double",
) -> MergeResult:
    """Write the union of the Parquet files below ``folder`` to ``out``.

    Files that Spark cannot see for their names are refused, not left out. ``pattern`` is matched against paths relative to ``folder``. Only files whose names end in
    ``.parquet``, in any case, count, whatever else it admits.
    """
    prepare(spark)
    parquet_codec(compression)
    refuse_below(out, folder)
    refuse_hidden(spark, folder, [".parquet"])
    below = P.relative_path(F.col("path"), folder)
    files = (
        list_files(spark, folder)
        .filter(F.lower("name").endswith(".parquet") & below.rlike(P.glob_pattern(pattern)))
        .persist()
    )
    try:
        count = files.count()
        if not count:
            raise FileNotFoundError(f"no Parquet files below {folder} that match {pattern!r}")
        merged = union_files(files, order, fallback, numeric_conflict)
    finally:
        files.unpersist()
    rows = write_parquet(merged, out, compression, rows_per_group=rows_per_group)
    return MergeResult(out, count, rows, len(merged.columns))
