import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusmill.operators.union import union_files, union_schema
from corpusmill.plans.merge import merge_folder
from corpusmill.sources.files import list_files
from corpusmill.sources.parquet import parquet_footers


def store(path, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)


@pytest.fixture
def merge_in(tmp_path):
    folder = tmp_path / "merge_in"
    store(folder / "f1.parquet", a=pa.array([1, 2], pa.int32()), b=pa.array(["x", None]))
    store(folder / "f2.parquet", c=pa.array([1.5]), a=pa.array([2**53 + 1], pa.int64()))
    store(
        folder / "f3.parquet",
        b=pa.array([{"x": 1, "y": "é"}, None], pa.struct([("x", pa.int32()), ("y", pa.string())])),
        a=pa.array(["7.5", "bad"]),
    )
    pq.write_table(pa.table({}), folder / "f4.parquet")
    store(folder / "sub" / "f5.parquet", a=pa.nulls(3))
    store(folder / "sub" / "f6.PARQUET", z=pa.array([1]))
    return folder


def test_union_of_differing_files(spark, merge_in):
    df = union_files(list_files(spark, str(merge_in), "*.parquet"))
    assert df.dtypes == [("a", "double"), ("b", "string"), ("c", "double")]
    rows = sorted((tuple(r) for r in df.collect()), key=str)
    assert rows == sorted(
        [
            (1.0, "x", None), (2.0, None, None), (float(2**53), None, 1.5), (7.5, '{"x":1,"y":"é"}', None),
            (None, None, None), (None, None, None), (None, None, None), (None, None, None),
        ],
        key=str,
    )


def test_column_orders(spark, tmp_path):
    store(tmp_path / "f1.parquet", c=pa.array([1.5]), a=pa.array([1]))
    store(tmp_path / "f2.parquet", a=pa.array([1]), b=pa.array(["x"]))
    files = list_files(spark, str(tmp_path), "*.parquet")
    assert union_schema(files).names == ["c", "a", "b"]
    assert union_schema(files, order="name").names == ["a", "b", "c"]
    with pytest.raises(ValueError):
        union_schema(files, order="size")


def test_types_of_stored_files(spark, tmp_path):
    stamp = [dt.datetime(2020, 1, 2, 3, 4, 5)]
    store(
        tmp_path / "a.parquet",
        u=pa.array([1], pa.uint32()), v=pa.array([1], pa.uint8()), w=pa.array([2**64 - 1], pa.uint64()),
        t=pa.array(stamp, pa.timestamp("ms")), z=pa.array(stamp, pa.timestamp("us", "UTC")),
        m=pa.array([[("k", 1)]], pa.map_(pa.string(), pa.int64())), ls=pa.array(["s"], pa.large_string()),
        dic=pa.array(["p"]).dictionary_encode(), d=pa.array([dt.date(2020, 1, 1)]), du=pa.array([5], pa.duration("us")),
        dec=pa.array([None], pa.decimal128(12, 3)), ll=pa.array([[1]], pa.large_list(pa.int8())),
    )
    store(
        tmp_path / "b.parquet",
        u=pa.array([-1], pa.int32()), v=pa.array([1], pa.uint16()), t=pa.array(stamp, pa.timestamp("us")),
        z=pa.array(stamp, pa.timestamp("us")), dic=pa.array(["q"]), ls=pa.array(["t"]), m=pa.array(["x"]),
    )
    df = union_files(list_files(spark, str(tmp_path), "*.parquet"))
    assert dict(df.dtypes) == {
        "u": "double", "v": "int", "w": "decimal(20,0)", "t": "timestamp_ntz", "z": "string", "m": "string",
        "ls": "string", "dic": "string", "d": "date", "du": "bigint", "dec": "decimal(12,3)", "ll": "array<tinyint>",
    }
    rows = {r.ls: r for r in df.collect()}
    assert rows["s"].u == 1.0 and rows["t"].u == -1.0
    assert int(rows["s"].w) == 2**64 - 1
    assert rows["s"].t == rows["t"].t == stamp[0]
    assert (rows["s"].m, rows["t"].m) == ('{"k":1}', "x")
    assert (rows["s"].dic, rows["t"].dic) == ("p", "q")


def test_times_written_by_spark(spark, tmp_path):
    spark.sql("select timestamp'2020-01-02 03:04:05' t, 1 n").write.parquet(str(tmp_path / "a"))
    store(tmp_path / "b" / "b.parquet", n=pa.array([2], pa.int64()))
    df = union_files(list_files(spark, str(tmp_path), "*.parquet"))
    assert dict(df.dtypes) == {"t": "timestamp", "n": "bigint"}
    assert df.filter("n = 1").first().t == dt.datetime(2020, 1, 2, 3, 4, 5)


def test_one_scan_when_files_agree(spark, tmp_path):
    for i in range(6):
        store(tmp_path / f"{i}.parquet", a=pa.array([i]), **({f"c{i}": pa.array(["x"])}))
    df = union_files(list_files(spark, str(tmp_path), "*.parquet"))
    assert df._jdf.queryExecution().toString().count("FileScan parquet") == 1
    assert sorted(r.a for r in df.collect()) == list(range(6))
    assert len(df.columns) == 7


def test_columns_without_a_type(spark, tmp_path):
    hollow = pa.struct([("x", pa.null()), ("y", pa.int32())])
    store(tmp_path / "a.parquet", n=pa.nulls(2), s=pa.array([{"y": 1}, None], hollow), l=pa.array([[], None], pa.list_(pa.null())))
    store(tmp_path / "b.parquet", k=pa.array([1]), l=pa.array([[5]]))
    df = union_files(list_files(spark, str(tmp_path), "*.parquet"))
    assert dict(df.dtypes) == {"n": "string", "s": "struct<y:int>", "l": "string", "k": "bigint"}
    assert sorted(((str(r.s), r.l, r.k, r.n) for r in df.collect()), key=str) == sorted(
        [("Row(y=1)", None, None, None), ("None", None, None, None), ("None", "[5]", 1, None)], key=str
    )


def test_unsupported_type_and_unreadable_file_are_errors(spark, tmp_path):
    store(tmp_path / "t" / "a.parquet", t=pa.array([dt.time(1, 2)]))
    with pytest.raises(TypeError, match="time64"):
        union_files(list_files(spark, str(tmp_path / "t"), "*.parquet"))
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "b.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="not a readable Parquet file"):
        union_files(list_files(spark, str(tmp_path / "x"), "*.parquet"))


def test_merge_folder(spark, merge_in, tmp_path):
    out = str(tmp_path / "out")
    result = merge_folder(spark, str(merge_in), out, compression="gzip", rows_per_group=2)
    assert (result.files, result.rows, result.columns) == (5, 8, 3)
    merged = spark.read.parquet(out)
    assert merged.count() == 8
    footers = parquet_footers(list_files(spark, out, "*.parquet")).collect()
    assert max(-(-f.num_rows // 2) for f in footers) == max(f.num_row_groups for f in footers)
    with pytest.raises(ValueError, match="lies inside"):
        merge_folder(spark, str(merge_in), str(merge_in / "out"))
    with pytest.raises(FileNotFoundError):
        merge_folder(spark, str(merge_in), out, pattern="*.nope")
    assert merge_folder(spark, str(merge_in), out, pattern="sub/*").files == 2
    assert merge_folder(spark, str(merge_in), out, pattern="f[!13].parquet").files == 2
    with pytest.raises(ValueError, match="brotli"):
        merge_folder(spark, str(merge_in), out, compression="brotli")


def test_many_small_files_are_one_scan(spark, tmp_path):
    for n in range(500):
        pq.write_table(pa.table({"a": pa.array([n], pa.int64()), "b": pa.array([str(n)])}), tmp_path / f"f{n}.parquet")
    merged = union_files(list_files(spark, str(tmp_path)))
    assert merged._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert merged.agg(F.sum("a"), F.count("b")).first() == (500 * 499 // 2, 500)


def test_hidden_parquet_is_refused(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("a.parquet", "_b.parquet"):
        pq.write_table(pa.table({"a": [1]}), tmp_path / "in" / name)
    with pytest.raises(ValueError, match="_b.parquet"):
        merge_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"))
