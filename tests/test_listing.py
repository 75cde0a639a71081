import datetime as dt

import pytest

from corpusmill.suite.queries import QUERIES


@pytest.fixture
def orders(spark, tmp_path):
    """A folder with orders of two months, one order twice."""

    def make(keys, parts=3):
        rows = [(k, k % 7, "OFP"[k % 3], "1-URGENT", dt.datetime(1995, 1 + k % 2, 3)) for k in keys]
        names = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz"
        spark.createDataFrame(rows, names).repartition(parts).write.parquet(f"{tmp_path}/orders.parquet")
        return str(tmp_path)

    return make


def test_extension_counts_has_every_ending(spark, orders):
    found = QUERIES["extension_counts"](spark, orders([1, 2, 3, 4, 5, 5, 10]))
    assert sorted(map(tuple, found.collect())) == [(".parq", 1), (".parquet", 3), (".txt", 2), (".zst", 2), ("[no ext]", 1)]


def test_places_follow_on_over_many_ranges(spark, orders):
    keys = [*range(1, 400), *[77] * 50]
    found = QUERIES["ordered_files"](spark, orders(keys, 7)).collect()
    ending = {0: ".parquet", 1: ".PARQ", 2: ""}
    paths = [f"/data/{'ofp'[k % 3]}/RC_{k}{ending.get(k % 5, '.zst')}" for k in keys if k not in (5,)]
    want = sorted(paths, key=lambda p: (p.rsplit("/", 1)[1], p))
    assert [r["path"] for r in sorted(found, key=lambda r: r["place"])] == want
    assert sorted(r["place"] for r in found) == list(range(1, len(want) + 1))


def test_no_task_numbers_the_whole_listing(spark, orders):
    plan = QUERIES["ordered_files"](spark, orders(range(1, 50)))._jdf.queryExecution().executedPlan().toString()
    whole = plan[: plan.index("BroadcastExchange")]
    assert "Window" not in whole and "SinglePartition" not in whole


def test_no_files(spark, orders):
    from corpusmill.sources.files import numbered

    none = spark.createDataFrame([], "path string, length bigint")
    assert numbered(none).collect() == [] and numbered(none).columns == ["path", "length", "place"]
