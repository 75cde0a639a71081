"""Operators whose tasks and driver hold a bounded amount, whatever the data: held against the plain way."""

import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import corpus, profile, union
from corpusmill.sources.files import list_files


@pytest.mark.parametrize("seed,most", [(1, 5), (2, 2_000), (3, 10**15)])
def test_value_at_every_rank(spark, seed, most):
    rnd = random.Random(seed)
    values = [rnd.randint(-most, most) for _ in range(200)] + [most] * 40 + [None] * 3
    df = spark.createDataFrame([(v,) for v in values], "v long")
    ordered = sorted(v for v in values if v is not None)
    for rank in (0, 1, 119, 200, 239):
        assert corpus.value_at_rank(df, "v", rank) == ordered[rank]
    assert corpus.value_at_rank(df, "v", 240) is None
    assert corpus.value_at_rank(df.where("v IS NULL"), "v", 0) is None


def test_rank_over_the_whole_range(spark):
    df = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,)], "v long")
    assert [corpus.value_at_rank(df, "v", n) for n in range(3)] == [-(2**63), 0, 2**63 - 1]


@pytest.mark.parametrize("k", [0, 1, 7, 60, 5_000])
@pytest.mark.parametrize("buckets", [1, 8, 1 << 14])
def test_frequent_values_are_the_value_counts(spark, k, buckets):
    rows = spark.range(6_000).select(
        F.when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.col("id") % 40).otherwise(F.col("id") % 2_500).cast("double").alias("v")
    )
    rows = rows.unionByName(spark.createDataFrame([(float("nan"),)] * 9, "v double"))
    want = profile.value_counts(rows, "v", k).collect()
    assert profile.frequent_values(rows, "v", k, buckets).collect() == want


def test_frequent_values_of_nested_columns_and_nothing(spark):
    rows = spark.createDataFrame([([1, 2],), ([1, 2],), ([],), (None,)], "a array<int>")
    assert profile.frequent_values(rows, "a", 2, 4).collect() == profile.value_counts(rows, "a", 2).collect()
    assert profile.frequent_values(rows.limit(0), "a", 2, 4).collect() == []
    with pytest.raises(TypeError, match="maps"):
        profile.frequent_values(rows.select(F.create_map(F.lit("k"), F.lit(1)).alias("m")), "m")


def test_few_values_are_shuffled(spark):
    """With a few heavy values, only their buckets are counted value by value."""
    rows = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 5).otherwise(F.col("id")).alias("v"))
    found = profile.frequent_values(rows, "v", 5)
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "LeftSemi" in plan and sorted(r["n"] for r in found.collect()) == [4_000] * 3 + [4_001] * 2


@pytest.mark.parametrize("n", [0, 1, 3, 7, 29, 1_000])
def test_edges_of_datasets_of_many_files(spark, tmp_path, n, monkeypatch):
    monkeypatch.setattr(profile, "EDGE_FILES", 2)
    path = str(tmp_path / "many")
    spark.range(30).repartitionByRange(15, "id").sortWithinPartitions("id").write.parquet(path)
    empty = spark.range(0).write.mode("append").parquet(path)
    assert empty is None
    rows = spark.read.parquet(path).withColumn("file", F.input_file_name()).collect()
    in_order = [r["id"] for r in sorted(rows, key=lambda r: (r["file"], r["id"]))]
    assert [r["id"] for r in profile.dataset_head(spark, path, n).collect()] == in_order[:n]
    assert [r["id"] for r in profile.dataset_tail(spark, path, n).collect()] == in_order[max(0, 30 - n) :]
    assert profile.dataset_tail(spark, path, n)._jdf.queryExecution().executedPlan().toString().count("Window") == 0


def test_edge_files_open_no_more_than_they_need(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(profile, "EDGE_FILES", 2)
    path = str(tmp_path / "many")
    spark.range(300).repartition(20).write.parquet(path)
    opened = []
    footers = profile.parquet_footers
    monkeypatch.setattr(profile, "parquet_footers", lambda files: opened.append(files.count()) or footers(files))
    assert len(profile._edge_files(spark, path, 10, last=True)) == 1 and opened == [2]
    del opened[:]
    assert len(profile._edge_files(spark, path, 100, last=False)) in (7, 8) and opened == [2, 16]


def test_unions_of_many_files_are_several_scans(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(union, "SCAN_FILES", 4)
    folder = str(tmp_path / "u")
    for n, kind in enumerate(("bigint", "string", "bigint")):
        spark.range(n * 100, n * 100 + 60).select(F.col("id").cast(kind).alias("v")).repartition(6).write.parquet(f"{folder}/{n}")
    merged = union.union_files(list_files(spark, folder, "*.parquet"), fallback="string")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3 + 2  # twelve files of one type, six of the other
    assert sorted(int(r["v"]) for r in merged.collect()) == [n * 100 + m for n in range(3) for m in range(60)]


def test_samples_keep_the_smallest_draws(spark):
    rows = spark.range(5_000).select("id", F.when(F.col("id") % 3 == 0, F.col("id") * 2).alias("x"), F.lit(None).cast("string").alias("none"))
    draws = rows.select("id", "x", *(profile._draw(rows, ["id"], 5, F.lit(c)).alias(f"draw_{c}") for c in ("id", "x"))).collect()
    want = {(c, str(r[c])) for c in ("id", "x") for r in sorted((r for r in draws if r[c] is not None), key=lambda r: r[f"draw_{c}"])[:40]}
    got = [(r["column"], r["value"]) for r in profile.sample_all_columns(rows.repartition(7), 40, seed=5, key=["id"]).collect()]
    assert set(got) == want | {("none", None)} and len(got) == 81
    assert [(r["column"], r["value"]) for r in profile.sample_all_columns(rows, 0, key=["id"]).collect()] == [("id", None), ("x", None), ("none", None)]
