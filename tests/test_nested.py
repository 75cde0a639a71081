import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import nested as N


@pytest.mark.parametrize(
    "schema, value, expected",
    [
        ("v struct<a:struct<b:int>>", {"a": {"b": None}}, None),
        ("v struct<a:struct<x:int>,b:int>", {"a": {"x": None}, "b": 1}, {"a": None, "b": 1}),
        ("v array<int>", [], None),
        ("v array<int>", [None], None),
        ("v array<int>", [None, 1], [None, 1]),
        ("v array<struct<x:int>>", [{"x": None}], None),
        ("v array<struct<x:int>>", [{"x": None}, {"x": 1}], [None, {"x": 1}]),
        ("v array<array<int>>", [[], [1, None], None], [None, [1, None], None]),
        ("v map<string,int>", {"a": None, "b": 1}, {"b": 1}),
        ("v map<string,int>", {"a": None}, None),
        ("v map<string,struct<x:int>>", {"a": {"x": 1}, "b": {"x": None}}, {"a": {"x": 1}}),
        ("v string", "", ""),
        ("v int", 0, 0),
        ("v boolean", False, False),
    ],
)
def test_sanitize(spark, plain_rows, schema, value, expected):
    df = spark.createDataFrame([(value,)], schema)
    clean = N.sanitize(df)
    got = plain_rows(clean)[0]["v"]
    if isinstance(got, dict) and "map" in schema:
        got = {k: v.asDict() if hasattr(v, "asDict") else v for k, v in got.items()}
    assert got == expected
    assert N.sanitize(clean).collect() == clean.collect()


def reference_clean(value):
    """The same rule on plain values: what holds nothing is None."""
    if isinstance(value, dict):
        parts = {k: reference_clean(v) for k, v in value.items()}
        return parts if any(v is not None for v in parts.values()) else None
    if isinstance(value, list):
        items = [reference_clean(v) for v in value]
        return items if any(v is not None for v in items) else None
    return value


leaf = st.none() | st.integers(0, 3)
item = st.none() | st.fixed_dictionaries({"x": leaf, "y": st.none() | st.lists(leaf, max_size=2)})
shape = st.none() | st.fixed_dictionaries({"a": leaf, "l": st.none() | st.lists(item, max_size=3), "s": item})


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(shape, min_size=1, max_size=30))
def test_sanitize_agrees_with_the_rule(spark, plain_rows, values):
    inner = "struct<x:int,y:array<int>>"
    df = spark.createDataFrame(
        [(i, v) for i, v in enumerate(values)], f"i int, v struct<a:int,l:array<{inner}>,s:{inner}>"
    )
    rows = plain_rows(N.sanitize(df).orderBy("i"))
    assert [r["v"] for r in rows] == [reference_clean(v) for v in values]


def test_empty_types_are_removed(spark):
    df = spark.sql(
        "select 1 a, null b, named_struct('x', null, 'y', 2) c, array() d, named_struct('z', named_struct('w', null)) e,"
        " array(named_struct('k', null, 'l', 'm')) f"
    )
    assert N.drop_empty_types(df).dtypes == [("a", "int"), ("c", "struct<y:int>"), ("f", "array<struct<l:string>>")]


def test_all_null_columns_are_dropped(spark):
    df = spark.createDataFrame(
        [(1, None, [], {"x": None}), (2, None, None, None)], "a int, b string, c array<int>, d struct<x:int>"
    )
    assert N.drop_all_null_columns(df).columns == ["a"]


def test_json_text(spark):
    schema = T.StructType.fromDDL("v struct<a:int,b:binary,`c d`:array<struct<e:binary>>,m:map<string,int>,t:string>")
    df = spark.createDataFrame(
        [(1, (1, b"by\xfftes", [(b"x",)], {"k": 2}, "é"))], T.StructType([T.StructField("i", T.IntegerType())] + schema.fields)
    )
    text = df.select(N.json_text(F.col("v"), schema["v"].dataType)).first()[0]
    assert "é" in text
    assert json.loads(text) == {"a": 1, "b": "by�tes", "c d": [{"e": "x"}], "m": {"k": 2}, "t": "é"}
    nulls = spark.createDataFrame([((None, 1),), (None,)], "v struct<a:int,b:int>")
    texts = [r[0] for r in nulls.select(N.json_text(F.col("v"), nulls.schema["v"].dataType)).collect()]
    assert sorted(texts, key=str) == [None, '{"a":null,"b":1}'] or texts == ['{"a":null,"b":1}', None]
