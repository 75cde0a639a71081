"""Profiling a DataFrame: every operator is one aggregation, or one bounded top-k, over it."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import paths as P
from corpusmill.functions.nested import column_of, is_nested, json_text
from corpusmill.functions.scalars import is_missing, percent, present
from corpusmill.sources.files import list_dataset
from corpusmill.sources.parquet import parquet_footers


# Files whose footers are read in the first round when the first or last rows of a dataset are looked for.
EDGE_FILES = 8

# Hash buckets that frequent values are looked for in.
COUNT_BUCKETS = 1 << 14


def _field(df: DataFrame, name: str) -> T.StructField:
    for f in df.schema.fields:
        if f.name == name:
            return f
    raise ValueError(f"the view has no column {name!r}, only {df.columns}")


def _missing(f: T.StructField) -> Column:
    return is_missing(column_of(f.name), f.dataType)


def _value_text(f: T.StructField) -> Column:
    value = column_of(f.name)
    return json_text(value, f.dataType) if is_nested(f.dataType) else value.cast("string")


def _check_n(n: int) -> int:
    if n < 0:
        raise ValueError(f"n must not be negative: {n}")
    return n


# ---- the view ----------------------------------------------------------------------------------


def filter_view(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which a SQL expression holds; a broken expression is an error at once."""
    return df.filter(F.expr(expression))


# ---- counts ------------------------------------------------------------------------------------


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("cols", F.lit(len(df.columns)).cast("bigint"))


def _per_column(df: DataFrame, measures: list[tuple[str, callable]]) -> DataFrame:
    """One aggregation over ``df``, then one row per column holding its measures."""
    aggs, entries = [], []
    for i, f in enumerate(df.schema.fields):
        parts = [F.lit(i).alias("ordinal"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type")]
        for name, measure in measures:
            slot = f"m{i}_{name}"
            aggs.append(measure(f).alias(slot))
            parts.append(F.col(slot).alias(name))
        entries.append(F.struct(*parts))
    if not entries:
        raise ValueError("the view has no columns")
    one_row = df.agg(*aggs)
    return one_row.select(F.inline(F.array(*entries)))


def column_profile(df: DataFrame) -> DataFrame:
    """``ordinal, column, type, non_null, nulls`` for each column; NaN counts as null."""
    return _per_column(
        df,
        [
            ("non_null", lambda f: F.count_if(~_missing(f))),
            ("nulls", lambda f: F.count_if(_missing(f))),
        ],
    )


def column_types(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column string, type string")


def info(df: DataFrame) -> DataFrame:
    """The column profile with the view's row and column counts beside it."""
    profile = column_profile(df)
    return profile.withColumns(
        {"rows": F.col("non_null") + F.col("nulls"), "cols": F.lit(len(df.columns)).cast("bigint")}
    )


def null_fractions(df: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` columns with the largest share of missing values."""
    shares = _per_column(df, [("null_fraction", lambda f: F.avg(_missing(f).cast("int")))])
    return (
        shares.select("column", "null_fraction", percent(F.col("null_fraction")).alias("null_percent"))
        .orderBy(F.desc("null_fraction"), "column")
        .limit(_check_n(k))
    )


def min_max(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value, missing ones aside; both NULL when there is none."""
    f = _field(df, column)
    value = present(column_of(column), f.dataType)
    return df.agg(F.min(value).alias("min"), F.max(value).alias("max")).select(
        F.lit(column).alias("column"), "min", "max"
    )


def value_counts(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The ``k`` most frequent values, missing ones counted as one value; ties by value."""
    f = _field(df, column)
    counts = df.groupBy(present(column_of(column), f.dataType).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    # maps cannot be compared: their text stands in as the tie-breaker
    tie = F.to_json("value") if _has_map(f.dataType) else F.col("value")
    return counts.orderBy(F.desc("n"), tie.asc_nulls_last()).limit(_check_n(k))


def frequent_values(df: DataFrame, column: str, k: int = 20, buckets: int = COUNT_BUCKETS) -> DataFrame:
    """The rows of :func:`value_counts`, for columns of very many values: only values that may be among them are counted.

    Values are counted by hash bucket first, a sketch of fixed size. The values of the fullest buckets are then counted
    exactly, and the k-th of those counts is a bound: a value that reaches it lies in a bucket that reaches it. All values
    of such buckets are counted exactly, so the result is complete whatever the data; how many values are shuffled depends
    on how many buckets reach the bound.
    """
    f = _field(df, column)
    if _has_map(f.dataType):
        raise TypeError(f"maps have no hash to count by: column {column!r}")
    value = present(column_of(column), f.dataType)
    rows = df.select(value.alias("value"), F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int").alias("bucket"))
    sizes = sorted(((r["count"], r["bucket"]) for r in rows.groupBy("bucket").count().collect()), reverse=True)  # a row per bucket

    def counted(chosen: list[int]) -> DataFrame:
        names = df.sparkSession.createDataFrame([(b,) for b in chosen], "bucket int")
        some = rows if len(chosen) == len(sizes) else rows.join(F.broadcast(names), "bucket", "left_semi")
        return some.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col("value").asc_nulls_last()).limit(_check_n(k))

    fullest = [bucket for _, bucket in sizes[: 2 * k]]
    if len(fullest) == len(sizes):
        return counted(fullest)
    least = counted(fullest).agg(F.count(F.lit(1)).alias("found"), F.min("n").alias("n")).first()
    bound = least["n"] if least["found"] == k and k else 0
    return counted([bucket for size, bucket in sizes if size >= bound])


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.MapType) or (isinstance(dtype, T.ArrayType) and _has_map(dtype.elementType))


# ---- first, last and sampled rows --------------------------------------------------------------


def _file_order() -> list[Column]:
    return [F.col("_metadata.file_path"), F.col("_metadata.row_index")]


def _order_columns(df: DataFrame, names: list[str] | None, argument: str) -> list[Column]:
    """The named columns, or the places of a Parquet scan's rows; an error names the argument that is needed."""
    if names:
        return [column_of(name) for name in names]
    try:
        df.select(*_file_order()).schema
    except AnalysisException:
        raise ValueError(f"rows that do not come straight from Parquet files have no order of their own: give {argument}") from None
    return _file_order()


def head(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows by ``order_by``, or in file order for a view of Parquet files. One lazy top-n for every n.

    For the first rows of a whole dataset :func:`dataset_head` reads only the files that hold them.
    """
    return df.orderBy(*_order_columns(df, order_by, "order_by")).limit(_check_n(n))


def tail(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """The last ``n`` rows, first to last."""
    order = _order_columns(df, order_by, "order_by")
    keys = {f"__key{i}": c for i, c in enumerate(order)}
    last = df.withColumns(keys).orderBy(*(F.desc(k) for k in keys)).limit(_check_n(n))
    return last.orderBy(*keys).drop(*keys)


def _edge_files(spark: SparkSession, path: str, n: int, last: bool) -> list:
    """``path, num_rows`` of the first (or last) files of a dataset that together hold ``n`` rows, the outermost first.

    Footers are read from that end on, eight times as many in every round, so no more than about eight times the files
    that are needed are opened and no count of all files is ever made.
    """
    files, end = list_dataset(spark, path), F.desc("path") if last else F.asc("path")
    many = EDGE_FILES
    while True:
        some = files.select("path").orderBy(end).limit(many)
        footers = parquet_footers(some).select("path", "num_rows", "error").collect()
        wanted, rows = [], 0
        for footer in sorted((f for f in footers if f["error"] is None), key=lambda f: f["path"], reverse=last):
            if rows >= n:
                return wanted
            wanted.append(footer)
            rows += footer["num_rows"]
        if rows >= n or len(footers) < many:
            return wanted
        many *= 8


def _dataset_slice(spark: SparkSession, path: str, n: int, last: bool) -> DataFrame:
    """The rows of the first (or last) ``n`` places of a Parquet dataset in file order: no other row is read."""
    wanted = _edge_files(spark, path, n, last) if n else []
    if not wanted:
        return spark.read.parquet(path).limit(0)
    reader = spark.read.schema(spark.read.parquet(path).schema)
    if P.local_path_part(wanted[0]["path"]) != P.local_path_part(path):
        reader = reader.option("basePath", path)
    rows = reader.parquet(*[P.escape_glob(f["path"]) for f in wanted])
    edge = wanted[-1]
    share = min(n - sum(f["num_rows"] for f in wanted[:-1]), edge["num_rows"])
    at_edge = P.scanned_path() == edge["path"]
    inside = F.col("_metadata.row_index") >= edge["num_rows"] - share if last else F.col("_metadata.row_index") < share
    return rows.where(~at_edge | inside)


def dataset_head(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows of a Parquet dataset in file order."""
    return head(_dataset_slice(spark, path, _check_n(n), last=False), n)


def dataset_tail(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The last ``n`` rows of a Parquet dataset in file order, first to last."""
    return head(_dataset_slice(spark, path, _check_n(n), last=True), n)


def _draw(df: DataFrame, key: list[str] | None, seed: int, *salt: Column) -> Column:
    """Reproducible random text per row, whatever the partitioning: a digest any engine can take."""
    parts = [c.cast("string") for c in (*_order_columns(df, key, "key"), *salt, F.lit(seed))]
    return F.md5(F.concat_ws("|", *parts))


def sample_rows(df: DataFrame, n: int = 5, seed: int = 0, key: list[str] | None = None) -> DataFrame:
    """``n`` rows (at least one, at most all) without replacement: a lazy top-n by a seeded hash.

    ``key`` names columns that tell rows apart; a row's place in its Parquet file is the default.
    """
    return df.orderBy(_draw(df, key, seed)).limit(max(1, n))


def sample_column(df: DataFrame, column: str, n: int = 5, seed: int = 0, key: list[str] | None = None) -> DataFrame:
    """Up to ``n`` values of a column that are not missing, without replacement."""
    f = _field(df, column)
    drawn = df.filter(~_missing(f)).select(column_of(column).alias("value"), _draw(df, key, seed).alias("__draw"))
    return drawn.orderBy("__draw").limit(_check_n(n)).select("value")


def _smallest(names: list[str], n: int):
    """Rows of draws ``d0, d1, ...`` and values ``v0, v1, ...`` in, per task the n smallest draws of every column out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = [None] * len(names)
        for batch in batches:
            for i in range(len(names)):
                some = pa.table({"value": batch.column(f"v{i}"), "draw": batch.column(f"d{i}")})
                some = some.filter(pc.is_valid(some["draw"]))
                some = some if held[i] is None else pa.concat_tables([held[i], some])
                if some.num_rows > n:
                    some = some.take(pc.select_k_unstable(some, n, [("draw", "ascending")]))
                held[i] = some.combine_chunks()
        for name, some in zip(names, held):
            for part in some.to_batches() if some is not None else []:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * part.num_rows, pa.string()), part.column("value"), part.column("draw")],
                    names=["column", "value", "draw"],
                )

    return run


def sample_all_columns(df: DataFrame, n: int = 1, seed: int = 0, key: list[str] | None = None) -> DataFrame:
    """Up to ``n`` values of every column as text, ``(column, value)``; NULL where a column has none.

    One scan serves all columns. Every task keeps the n smallest draws of each column as it reads, and only these leave
    it; they are merged per column.
    """
    _check_n(n)
    fields, names = df.schema.fields, df.columns
    drawn = df.select(
        *(_value_text(f).alias(f"v{i}") for i, f in enumerate(fields)),
        *(F.when(~_missing(f), _draw(df, key, seed, F.lit(f.name))).alias(f"d{i}") for i, f in enumerate(fields)),
    )
    small = drawn.mapInArrow(_smallest(names, n), "column string, value string, draw string") if n else None
    listed = df.sparkSession.createDataFrame([(name,) for name in names], "column string")
    if small is None:
        return listed.withColumn("value", F.lit(None).cast("string"))
    place = F.row_number().over(Window.partitionBy("column").orderBy("draw"))
    kept = small.withColumn("__place", place).where(F.col("__place") <= n)
    return listed.join(kept, "column", "left").select("column", "value")
