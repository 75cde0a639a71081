"""Union of many Parquet files by column name, across differing schemas."""

from __future__ import annotations

from functools import reduce
from itertools import groupby, islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import paths as P
from corpusmill.functions.nested import prune_type
from corpusmill.operators.types import KIND_SEPARATOR, WHOLE, StoredType, TypeSummary, align_to_schema, common_type, merged_type
from corpusmill.sources.parquet import parquet_footers

ORDERS = ("first_seen", "name")
#: Files of one scan at most; more of the same types are several scans.
SCAN_FILES = 10_000
FAMILIES = ("int", "uint", "float", "timestamp", "string", "binary", "other")


def _columns(footers: DataFrame) -> DataFrame:
    return footers.select("path", F.explode("columns").alias("c")).select("path", "c.*")


def _column_types(footers: DataFrame) -> list:
    """Per column name: where it is first seen, and what its stored types amount to. One row per name.

    Every measure is a fixed-size aggregate, so the rows shuffled do not grow with the number of files or types.
    """
    family, stored = F.col("family"), F.col("family") != "null"
    width = F.when(family.isin(*WHOLE), F.col("detail").cast("int"))
    zone = F.when(family == "timestamp", F.col("detail"))
    kind = F.when(stored, F.concat_ws(KIND_SEPARATOR, "family", "detail", "spark"))
    no_type = F.col("spark").isNull()
    return (
        _columns(footers)
        .groupBy("name")
        .agg(
            F.min(F.struct("path", "ordinal")).alias("first"),
            *(F.bool_or(family == name).alias(name) for name in FAMILIES),
            F.max(width).alias("widest"),
            F.min(zone).alias("zone_from"), F.max(zone).alias("zone_to"),
            F.min(kind).alias("kind_from"), F.max(kind).alias("kind_to"),
            # the one form all files that store the column read it in, if there is one
            F.min("spark").alias("spark_from"), F.max("spark").alias("spark_to"),
            F.min(F.when(no_type, F.struct("path", "detail"))).alias("unreadable"),
        )
        .collect()
    )


def _target(rows: list, order: str, fallback: str, numeric_conflict: str) -> T.StructType:
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}, not {order!r}")
    fields = []
    for row in sorted(rows, key=(lambda r: r["first"]) if order == "first_seen" else (lambda r: r["name"])):
        if row["unreadable"] is not None:
            path, kind = row["unreadable"]
            raise TypeError(f"column {row['name']!r} in {path} has a type Spark cannot read: {kind}")
        seen = TypeSummary(
            frozenset(name for name in FAMILIES if row[name]),
            row["widest"] or 0,
            (row["zone_from"] or "", row["zone_to"] or ""),
            row["kind_from"] or "",
            row["kind_to"] or "",
        )
        # what no file gives a storable type stays as a column without values
        dtype = prune_type(merged_type(seen, fallback, numeric_conflict)) or T.StringType()
        fields.append(T.StructField(row["name"], dtype, True))
    return T.StructType(fields)


def union_schema(
    files: DataFrame, order: str = "first_seen", fallback: str = "string", numeric_conflict: str = "double"
) -> T.StructType:
    """All columns of the listed Parquet files, each with the type that holds its every form."""
    return _target(_column_types(_readable(files)), order, fallback, numeric_conflict)


def _readable(files: DataFrame) -> DataFrame:
    footers = parquet_footers(files)
    return footers.withColumn(
        "path",
        F.when(F.col("error").isNull(), F.col("path")).otherwise(
            F.raise_error(F.concat(F.lit("not a readable Parquet file: "), F.col("path"), F.lit(": "), F.col("error")))
        ),
    )


def union_files(
    files: DataFrame, order: str = "first_seen", fallback: str = "string", numeric_conflict: str = "double"
) -> DataFrame:
    """Rows of all listed Parquet files under their union schema, missing columns NULL.

    Files are read together as far as their types allow: there is one scan per combination of
    types of the columns that files disagree about, and just one scan when they all agree.
    """
    spark = files.sparkSession
    footers = _readable(files).persist()
    try:
        target, groups, disputed, settled = _scan_groups(footers, order, fallback, numeric_conflict)
    finally:
        footers.unpersist()
    parts = []
    for signature, paths in groups:
        stored = settled | dict(zip(disputed, signature))
        # columns that this group lacks, or stores without values, are left to the alignment
        types = [(f.name, stored[f.name] and prune_type(T._parse_datatype_json_string(stored[f.name]))) for f in target.fields]
        schema = T.StructType([T.StructField(name, dtype, True) for name, dtype in types if dtype])
        scan = spark.read.schema(schema).parquet(*map(P.escape_glob, paths))
        parts.append(align_to_schema(scan, target))
    if not parts:
        return spark.createDataFrame([], target)
    return reduce(DataFrame.unionByName, parts)


def _scan_groups(footers: DataFrame, order: str, fallback: str, numeric_conflict: str) -> tuple:
    """The union schema, batches of files of one combination of disputed types, the disputed names, and the stored type
    of every other name."""
    rows = _column_types(footers)
    target = _target(rows, order, fallback, numeric_conflict)
    disputed = sorted(r["name"] for r in rows if r["spark_from"] != r["spark_to"])
    settled = {r["name"]: r["spark_from"] for r in rows if r["spark_from"] == r["spark_to"]}
    stored = F.expr("map_from_entries(transform(columns, c -> struct(c.name, c.spark)))")
    signature = F.array(*(stored[name] for name in disputed)) if disputed else F.array().cast("array<string>")
    named = footers.filter(F.size("columns") > 0).select(signature.alias("signature"), "path")
    # sorted in tasks, read one partition after the other: paths of a group never meet in a row
    rows = named.orderBy("signature", "path").toLocalIterator()
    batches = [
        (list(key), [r["path"] for r in some])
        for key, group in groupby(rows, key=lambda r: tuple(r["signature"]))
        for some in iter(lambda: list(islice(group, SCAN_FILES)), [])
    ]
    return target, sorted(batches, key=lambda b: b[1][0]), disputed, settled


def union_by_name(
    frames: list[DataFrame], order: str = "first_seen", fallback: str = "string", numeric_conflict: str = "double"
) -> DataFrame:
    """The same union for DataFrames at hand."""
    seen: dict[str, list[StoredType]] = {}
    for df in frames:
        for f in df.schema.fields:
            seen.setdefault(f.name, []).append(stored_type_of(f.dataType))
    names = list(seen) if order == "first_seen" else sorted(seen)
    target = T.StructType([T.StructField(n, common_type(seen[n], fallback, numeric_conflict), True) for n in names])
    return reduce(DataFrame.unionByName, [align_to_schema(df, target) for df in frames])


def stored_type_of(dtype: T.DataType) -> StoredType:
    """A Spark type in the terms the type rules use."""
    widths = {T.ByteType: "8", T.ShortType: "16", T.IntegerType: "32", T.LongType: "64"}
    families = {
        T.NullType: ("null", ""),
        T.FloatType: ("float", "32"),
        T.DoubleType: ("float", "64"),
        T.TimestampType: ("timestamp", "UTC"),
        T.TimestampNTZType: ("timestamp", ""),
        T.StringType: ("string", ""),
        T.BinaryType: ("binary", ""),
    }
    kind = type(dtype)
    family, detail = ("int", widths[kind]) if kind in widths else families.get(kind, ("other", dtype.json()))
    return StoredType(family, detail, dtype.json())
