import datetime as dt
import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators.types import StoredType, align_to_schema, common_type
from corpusmill.operators.union import stored_type_of

NAMED = {
    "null": StoredType("null", "", '"void"'),
    "int8": StoredType("int", "8", '"byte"'),
    "int32": StoredType("int", "32", '"integer"'),
    "int64": StoredType("int", "64", '"long"'),
    "uint16": StoredType("uint", "16", '"integer"'),
    "uint32": StoredType("uint", "32", '"long"'),
    "float": StoredType("float", "32", '"float"'),
    "double": StoredType("float", "64", '"double"'),
    "ts": StoredType("timestamp", "", '"timestamp_ntz"'),
    "ts_utc": StoredType("timestamp", "UTC", '"timestamp"'),
    "ts_rome": StoredType("timestamp", "Europe/Rome", '"timestamp"'),
    "string": StoredType("string", "", '"string"'),
    "binary": StoredType("binary", "", '"binary"'),
    "bool": StoredType("other", "bool", '"boolean"'),
    "date": StoredType("other", "date32[day]", '"date"'),
    "dec": StoredType("other", "decimal128(10, 2)", '"decimal(10,2)"'),
    "ints": stored_type_of(T.ArrayType(T.IntegerType())),
    "strings": stored_type_of(T.ArrayType(T.StringType())),
    "struct": stored_type_of(T.StructType([T.StructField("x", T.IntegerType())])),
}

CASES = [
    ("null", "string", "string"),
    ("int32", "int", "int"),
    ("null int32", "int", "int"),
    ("int8 int32 int64", "bigint", "bigint"),
    ("uint16 uint32", "bigint", "bigint"),
    ("int32 uint32", "double", "double"),
    ("int64 double", "double", "double"),
    ("float double", "double", "double"),
    ("float", "float", "float"),
    ("int64 string", "double", "double"),
    ("bool int64", "double", "double"),
    ("struct int8", "double", "double"),
    ("ts_utc", "timestamp", "timestamp"),
    ("ts_utc ts", "string", "double"),
    ("ts_utc ts_rome", "string", "double"),
    ("ts string", "string", "string"),
    ("struct string", "string", "string"),
    ("binary string", "string", "string"),
    ("binary", "binary", "binary"),
    ("ints strings", "string", "double"),
    ("ints struct", "string", "double"),
    ("bool date", "string", "double"),
    ("dec date", "string", "double"),
    ("dec int32", "double", "double"),
    ("date", "date", "date"),
]


@pytest.mark.parametrize("names, as_string, as_float", CASES)
def test_common_type(names, as_string, as_float):
    types = [NAMED[n] for n in names.split()]
    assert common_type(types).simpleString() == as_string
    assert common_type(types, "float64").simpleString() == as_float


def test_same_zone_timestamps_of_different_units_stay_timestamps():
    millis, micros = StoredType("timestamp", "UTC", '"timestamp"'), StoredType("timestamp", "UTC", '"timestamp" ')
    assert common_type([millis, micros]) == T.TimestampType()


def test_numbers_beside_text_can_be_kept_as_text():
    assert common_type([NAMED["int64"], NAMED["string"]], numeric_conflict="string") == T.StringType()
    assert common_type([NAMED["int64"], NAMED["double"]], numeric_conflict="string") == T.DoubleType()
    with pytest.raises(ValueError):
        common_type([NAMED["int64"]], fallback="text")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(sorted(NAMED)), min_size=1, max_size=4))
def test_common_type_does_not_depend_on_order(names):
    results = {common_type([NAMED[n] for n in order]).json() for order in itertools.permutations(names)}
    assert len(results) == 1


def test_align(spark):
    df = spark.createDataFrame(
        [
            (1, 300, "1.9", 1.9, "12", b"h\xff", [1], (1, "5"), dt.date(2020, 1, 2), True, "1.5d"),
            (2, 7, "8", float("nan"), " 3 ", None, None, None, None, None, "inf"),
        ],
        "id int, big int, txt string, dbl double, num string, bin binary, arr array<int>, s struct<a:int,b:string>,"
        " d date, flag boolean, f string",
    )
    target = T.StructType.fromDDL(
        "s struct<b:int,c:double,a:string>, big tinyint, txt int, dbl int, missing array<int>, num bigint, bin string,"
        " arr array<double>, d double, flag double, f double"
    )
    out = align_to_schema(df, target)
    assert out.schema == target
    first, second = out.collect()
    assert first.s.asDict() == {"b": 5, "c": None, "a": "1"}
    assert (first.big, second.big) == (None, 7)
    assert (first.txt, second.txt) == (None, 8)
    assert (first.dbl, second.dbl) == (1, None)
    assert first.missing is None and (first.num, second.num) == (12, 3)
    assert (first.bin, first.arr, first.d, first.flag) == ("h�", [1.0], None, 1.0)
    assert (first.f, second.f) == (None, float("inf"))


def test_nested_becomes_text_and_unfit_types_become_null(spark):
    df = spark.createDataFrame([((1,), [1], dt.datetime(2020, 1, 1))], "s struct<a:int>, l array<int>, t timestamp")
    out = align_to_schema(df, T.StructType.fromDDL("s string, l int, t double")).first()
    assert (out.s, out.l, out.t) == ('{"a":1}', None, None)


def test_align_keeps_every_row(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("v"))
    assert align_to_schema(df, T.StructType.fromDDL("v tinyint")).count() == 1000
