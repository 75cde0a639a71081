import csv
import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from corpusmill.sinks.write import PARQUET_CODECS, parquet_codec, write_csv, write_parquet


@pytest.mark.parametrize("codec", sorted(PARQUET_CODECS))
def test_parquet_codecs(spark, tmp_path, codec):
    df = spark.range(100).withColumn("t", F.lit("x"))
    assert write_parquet(df, str(tmp_path / "t"), codec) == 100
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100


def test_unknown_codecs():
    for name in ("brotli", "zip"):
        with pytest.raises(ValueError):
            parquet_codec(name)


def test_parquet_drops_what_cannot_be_stored(spark, tmp_path):
    df = spark.sql("select 1 a, null b, array() c, named_struct('x', null, 'y', 2) d")
    write_parquet(df, str(tmp_path / "t"), partition_by=())
    assert spark.read.parquet(str(tmp_path / "t")).dtypes == [("a", "int"), ("d", "struct<y:int>")]


def test_csv(spark, tmp_path):
    rows = [
        (1, 'say "hi", you', " pad ", 1.5, True, dt.datetime(2020, 1, 2, 3, 4, 5), [1, 2]),
        (2, "two\nlines", "", float("nan"), False, None, None),
        (3, None, "cr\rhere", None, None, dt.datetime(2020, 1, 2, 3, 4, 5, 600000), []),
    ]
    df = spark.createDataFrame(rows, "i int, t string, p string, x double, f boolean, at timestamp, l array<int>")
    write_csv(df.coalesce(1), str(tmp_path / "c"))
    with open(glob.glob(str(tmp_path / "c" / "*.csv"))[0], newline="") as f:
        got = list(csv.reader(f))
    assert got == [
        ["i", "t", "p", "x", "f", "at", "l"],
        ["1", 'say "hi", you', " pad ", "1.5", "True", "2020-01-02 03:04:05", "[1,2]"],
        ["2", "two\nlines", "", "", "False", "", ""],
        ["3", "", "cr\rhere", "", "", "2020-01-02 03:04:05.6", "[]"],
    ]
    write_csv(df, str(tmp_path / "first"), n=2, order_by=["i"])
    assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "first")).select("i").collect() == [("1",), ("2",)]
