import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import corpus as C
from corpusmill.sources.files import list_dataset
from corpusmill.sources.parquet import parquet_footers, parquet_schema, read_parquet


@pytest.fixture
def folder(tmp_path):
    for name, size, stamp in (("a.parquet", 40, 30), ("d/b.PARQUET", 10, 10), ("c.parq", 30, 20), ("d/plain", 20, 40)):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"x" * size)
        os.utime(path, (stamp, stamp))
    return tmp_path


def test_file_stats(spark, folder):
    row = C.file_stats(list_dataset(spark, str(folder))).first()
    assert (row.file_count, row.total_bytes, row.size_min_bytes, row.size_median_bytes) == (4, 100, 10, 30)
    assert (row.size_avg_bytes, row.size_max_bytes, row.size_avg_human) == (25, 40, "25.00 B")
    assert (row.mtime_earliest, row.mtime_latest) == ("1970-01-01T00:00:10", "1970-01-01T00:00:40")


def test_file_stats_of_nothing(spark, folder):
    row = C.file_stats(list_dataset(spark, str(folder), "*.none")).first()
    assert (row.file_count, row.total_bytes, row.size_median_bytes, row.size_avg_bytes) == (0, 0, 0, 0)
    assert (row.total_human, row.size_max_human, row.mtime_latest) == ("0.00 B", "0 B", None)


def test_extension_counts_and_largest(spark, folder):
    files = list_dataset(spark, str(folder))
    assert [tuple(r) for r in C.extension_counts(files).collect()] == [(".parquet", 2), ("[no ext]", 1), (".parq", 1)]
    top = C.largest_files(files, str(folder), 3).collect()
    assert [(r.file, r.length, r.size) for r in top] == [
        ("a.parquet", 40, "40.00 B"), ("c.parq", 30, "30.00 B"), ("d/plain", 20, "20.00 B"),
    ]
    single = list_dataset(spark, str(folder / "c.parq"))
    assert C.largest_files(single, str(folder / "c.parq")).first().file == "c.parq"


def test_row_groups(spark, tmp_path):
    table = pa.table({"a": list(range(100))})
    pq.write_table(table, tmp_path / "one.parquet")
    (tmp_path / "sub").mkdir()
    pq.write_table(table, tmp_path / "sub" / "many.parquet", row_group_size=30)
    (tmp_path / "junk.parquet").write_bytes(b"junk")
    footers = parquet_footers(list_dataset(spark, str(tmp_path)))
    total = C.row_group_totals(footers).first()
    assert (total.total_row_groups, total.files_counted, total.files_unreadable, total.total_rows) == (5, 2, 1, 200)
    top = C.most_row_groups(footers, str(tmp_path), 5).collect()
    assert [(r.file, r.num_row_groups, r.num_rows) for r in top] == [("sub/many.parquet", 4, 100), ("one.parquet", 1, 100)]
    assert footers.filter(F.col("error").isNotNull()).count() == 1


def test_corpus_meta(spark, tmp_path):
    spark.range(50).repartition(3).write.parquet(str(tmp_path / "t"))
    row = C.corpus_meta(spark, str(tmp_path / "t")).first()
    assert (row.path, row.is_directory, row.rows, row.cols, row.file_count) == (str(tmp_path / "t"), True, 50, 1, 3)
    assert row.ext_counts == '{".parquet":3}'
    part = next((tmp_path / "t").glob("*.parquet"))
    assert C.corpus_meta(spark, str(part)).first().is_directory is False
    assert parquet_schema(spark, str(part)).names == ["id"]
    assert read_parquet(spark, str(part), ["id"]).columns == ["id"]
    assert dt.datetime.fromisoformat(row.mtime_latest)
