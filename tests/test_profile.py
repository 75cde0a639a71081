import pytest
from pyspark.sql import functions as F

from corpusmill.functions import scalars as S
from corpusmill.operators import profile as R

NAN = float("nan")


@pytest.fixture(scope="module")
def view(spark):
    rows = list(
        zip(
            range(1, 9),
            ["a", "b", "a", None, "b", "c", None, "a"],
            [1.0, NAN, 3.0, None, -2.0, 5.0, 5.0, NAN],
            [None] * 8,
            [[1], [1], None, [], [2], [1], None, []],
        )
    )
    return spark.createDataFrame(rows, "id bigint, g string, x double, n string, arr array<int>")


def test_counts(view):
    assert R.row_count(view).first().rows == 8
    assert tuple(R.shape(view).first()) == (8, 5)
    rows = {r.column: r for r in R.column_profile(view).collect()}
    assert {c: (r.type, r.non_null, r.nulls) for c, r in rows.items()} == {
        "id": ("bigint", 8, 0),
        "g": ("string", 6, 2),
        "x": ("double", 5, 3),
        "n": ("string", 0, 8),
        "arr": ("array<int>", 6, 2),
    }
    assert {(r.rows, r.cols) for r in R.info(view).collect()} == {(8, 5)}
    assert [tuple(r) for r in R.column_types(view).orderBy("ordinal").collect()][:2] == [(0, "id", "bigint"), (1, "g", "string")]


def test_counts_of_an_empty_view(view):
    none = R.filter_view(view, "id > 100")
    assert tuple(R.shape(none).first()) == (0, 5)
    assert {(r.non_null, r.nulls) for r in R.column_profile(none).collect()} == {(0, 0)}
    assert {r.value for r in R.sample_all_columns(none, 1, key=["id"]).collect()} == {None}


def test_min_max(view):
    assert tuple(R.min_max(view, "x").first()) == ("x", -2.0, 5.0)
    assert tuple(R.min_max(view, "n").first()) == ("n", None, None)
    assert tuple(R.min_max(view, "g").first()) == ("g", "a", "c")
    with pytest.raises(ValueError, match="no column 'zz'"):
        R.min_max(view, "zz")


def test_value_counts(view):
    assert [tuple(r) for r in R.value_counts(view, "g").collect()] == [("a", 3), ("b", 2), (None, 2), ("c", 1)]
    assert [tuple(r) for r in R.value_counts(view, "x", 2).collect()] == [(None, 3), (5.0, 2)]
    assert [(r.value, r.n) for r in R.value_counts(view, "arr", 1).collect()] == [([1], 3)]
    maps = view.select(F.create_map(F.lit("k"), "g").alias("m"))
    assert R.value_counts(maps, "m", 1).first().n == 3


def test_null_fractions(view):
    rows = [(r.column, r.null_fraction, r.null_percent) for r in R.null_fractions(view, 4).collect()]
    assert rows == [("n", 1.0, "100.00%"), ("x", 0.375, "37.50%"), ("arr", 0.25, "25.00%"), ("g", 0.25, "25.00%")]


def test_filters(view):
    assert [r.id for r in R.filter_view(view, 'id > 2 and g == "a"').orderBy("id").collect()] == [3, 8]
    with pytest.raises(Exception):
        R.filter_view(view, "no_such_column > 1")
    kept = view.filter(S.ne_keep_missing(F.col("x"), 5.0)).orderBy("id")
    assert [r.id for r in kept.collect()] == [1, 2, 3, 4, 5, 8]


def test_head_and_tail_follow_file_order(spark, tmp_path):
    path = str(tmp_path / "t")
    for name, start in (("a", 0), ("b", 5000), ("c", 10000)):
        spark.range(start, start + 5000).coalesce(1).write.parquet(f"{path}/{name}")
    df = spark.read.option("recursiveFileLookup", True).parquet(path)
    assert [r.id for r in R.head(df, 3).collect()] == [0, 1, 2]
    assert [r.id for r in R.tail(df, 3).collect()] == [14997, 14998, 14999]
    assert [r.id for r in R.tail(df.filter("id % 2 = 0"), 2, order_by=["id"]).collect()] == [14996, 14998]
    assert [r.id for r in R.head(df, 1001).collect()] == list(range(1001))
    assert [r.id for r in R.tail(df, 1001).collect()] == list(range(13999, 15000))
    assert [r.id for r in R.head(df.filter("id > 4998"), 2).collect()] == [4999, 5000]
    drawn = [r.id for r in R.sample_rows(df, 30, seed=2).collect()]
    assert len(set(drawn)) == 30 and len({i // 5000 for i in drawn}) == 3
    assert drawn == [r.id for r in R.sample_rows(df, 2000, seed=2).collect()][:30]
    assert R.head(df, 0).count() == 0
    with pytest.raises(ValueError):
        R.head(df, -1)


def test_samples(spark, view):
    assert sorted(r.id for r in R.sample_rows(view, 100, key=["id"]).collect()) == list(range(1, 9))
    assert R.sample_rows(view, 0, key=["id"]).count() == 1
    values = [r.value for r in R.sample_column(view, "x", 50, key=["id"]).collect()]
    assert sorted(values) == [-2.0, 1.0, 3.0, 5.0, 5.0]
    big = spark.range(20_000).withColumn("v", F.col("id") % 3)
    draws = [
        sorted(r.id for r in R.sample_rows(df, 20, seed=s, key=["id"]).collect())
        for df, s in ((big.repartition(1), 5), (big.repartition(8), 5), (big, 6))
    ]
    assert draws[0] == draws[1] != draws[2]
    assert len(set(draws[0])) == 20


def test_rows_without_an_order(view):
    for ask in (R.head, R.tail, R.sample_rows):
        with pytest.raises(ValueError, match="give (order_by|key)"):
            ask(view.join(view.select("id"), "id"))


def test_ends_of_a_dataset(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.range(100).repartitionByRange(7, "id").write.parquet(path)
    whole = [r.id for r in R.head(spark.read.parquet(path), 100).collect()]
    for n in (0, 1, 14, 50, 100, 200):
        assert [r.id for r in R.dataset_head(spark, path, n).collect()] == whole[:n]
        assert [r.id for r in R.dataset_tail(spark, path, n).collect()] == (whole[-n:] if n else [])
    assert len(R.dataset_head(spark, path, 3).inputFiles()) == 1


@pytest.mark.parametrize("n", [1, 2, 50])
def test_sample_of_all_columns(view, n):
    rows = R.sample_all_columns(view, n, seed=1, key=["id"]).collect()
    got = {}
    for r in rows:
        got.setdefault(r.column, []).append(r.value)
    assert {c: len(v) for c, v in got.items()} == {"id": min(n, 8), "g": min(n, 6), "x": min(n, 5), "n": 1, "arr": min(n, 6)}
    assert got["n"] == [None]
    assert set(got["arr"]) <= {"[1]", "[2]", "[]"}


def test_first_pick_is_the_same_for_every_n(view):
    one = {r.column: r.value for r in R.sample_all_columns(view, 1, seed=4, key=["id"]).collect()}
    two = {}
    for r in R.sample_all_columns(view, 2, seed=4, key=["id"]).collect():
        two.setdefault(r.column, set()).add(r.value)
    assert all(value in two[column] for column, value in one.items())


def test_profiles_scan_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.rand().alias("x"), F.lit("t").alias("t")).write.parquet(path)
    df = spark.read.parquet(path)
    for plan in (R.column_profile(df), R.null_fractions(df), R.sample_all_columns(df, 1, key=["id"]), R.sample_all_columns(df, 5, key=["id"])):
        assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    text = R.min_max(df, "x")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<x:double>" in text


@pytest.mark.parametrize(
    "size, text",
    [
        (0, "0.00 B"), (1023, "1023.00 B"), (1024, "1.00 KB"), (1152, "1.12 KB"), (1280, "1.25 KB"),
        (1024**2 - 1, "1024.00 KB"), (5 * 1024**3, "5.00 GB"), (1024**5, "1024.00 TB"),
    ],
)
def test_human_bytes(spark, size, text):
    assert spark.range(1).select(S.human_bytes(F.lit(size))).first()[0] == text


def test_html_unescape(spark):
    import html

    from corpusmill.functions.entities import html_unescape

    texts = ["a &amp;amp; b", "&#x41;&#66;&notin;", "no entity", None, "&", "&unknown; &lt", "", "&notit; &#0; &#128; &#x110000; &#xD800; &#13;", "&&amp;#38;&#;&;", "&ngE; &#xfdd0;x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(html_unescape(F.col("t"))).collect()]
    assert got == [t if t is None else html.unescape(t) for t in texts]
