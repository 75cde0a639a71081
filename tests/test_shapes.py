import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import records, shapes
from corpusmill.operators.shapes import OpenKeys


def test_keys_of_a_shape():
    shape = "OBJECT<`a b`: BIGINT, `c``d`: OBJECT<e: DECIMAL(10,2)>, f: ARRAY<OBJECT<g: ARRAY<ARRAY<OBJECT<h: VOID>>>>>, i: OBJECT<>>"
    assert list(shapes.keys_of_shape(shape)) == [
        ("$", "a b"), ("$", "c`d"), ("$.c`d", "e"), ("$", "f"), ("$.f[]", "g"), ("$.f[].g[][]", "h"), ("$", "i"),
    ]
    assert list(shapes.keys_of_shape("ARRAY<OBJECT<x: STRING>>")) == [("$[]", "x")]


@pytest.fixture
def by_id(spark):
    """Tables of ids at the top of a field, in a list, and inside each other."""
    line = """'{"score": ' || id || ', "media": {"kind": "x", "by_id": {"k' || id || '": {"w": 1, "h' || id % 3 || '": 2}}},
              "list": [{"n' || id % 50 || '": 1}], "mixed": [{"m' || id || '": 1}, 5]}'"""
    return spark.range(3_000).select(F.parse_json(F.expr(line)).alias("record"))


def test_key_counts(by_id):
    found = {r["path"]: (r["keys"], r["first_key"], r["last_key"], r["is_open"]) for r in shapes.object_keys(by_id, F.col("record"), 40).collect()}
    assert found["$"] == (4, "list", "score", False)
    assert found["$.media"] == (2, "by_id", "kind", False)
    keys, first, last, is_open = found["$.media.by_id"]
    assert 2_850 <= keys <= 3_150 and (first, last, is_open) == ("k0", "k999", True)
    assert found["$.list[]"] == (50, "n0", "n9", True)
    assert found["$.media.by_id.k7"][:1] == (2,)
    assert "$.mixed[]" not in found  # read as text, so no field per key


def test_open_keys_are_named_before_a_schema_is_built(by_id):
    with pytest.raises(OpenKeys, match="media.*map_fields or json_fields") as error:
        records.record_schema(by_id, max_keys=1_000)
    assert error.value.path == "$.media.by_id"
    schema = records.record_schema(by_id, json_fields=["media"], max_keys=1_000)
    assert [f.name for f in schema.fields] == ["list", "media", "mixed", "score"]
    with pytest.raises(OpenKeys) as error:
        records.record_schema(by_id, json_fields=["media"], max_keys=40)
    assert error.value.path == "$.list[]"


def test_a_hundred_thousand_ids(spark):
    rows = spark.range(100_000).select(F.parse_json(F.expr("""'{"by_user": {"' || id || '": ' || id || '}}'""")).alias("record"))
    with pytest.raises(OpenKeys, match="'by_user'"):
        records.record_schema(rows)
    schema = records.record_schema(rows, map_fields=["by_user"])
    assert schema["by_user"].dataType == records.MAP_TYPE


def test_paths_under_an_open_one_do_not_hide_it(spark):
    rows = spark.range(500).select(F.parse_json(F.expr("""'{"a": {"' || id || '": {"' || id || 'x": {"y' || id || '": 1}}}}'""")).alias("record"))
    assert [r["path"] for r in shapes.open_paths(rows, F.col("record"), 100)] == ["$.a"]


def test_no_records(spark):
    none = spark.createDataFrame([], "t string").select(F.parse_json("t").alias("record"))
    assert shapes.object_keys(none, F.col("record")).collect() == [] and records.record_schema(none).fields == []
    flat = spark.createDataFrame([("5",), (None,), ("[1]",)], "t string").select(F.parse_json("t").alias("record"))
    assert shapes.open_paths(flat, F.col("record"), 0) == []


def test_a_task_remembers_a_bounded_number_of_keys(monkeypatch):
    held, real = [], shapes._entries
    monkeypatch.setattr(shapes, "TASK_KEYS", 100)
    monkeypatch.setattr(shapes, "_entries", lambda pairs: held.append(len(pairs)) or real(pairs))

    def batches(n):
        for at in range(0, n, 60):
            yield pa.RecordBatch.from_pydict({"shape": [f"OBJECT<a: OBJECT<k{k}: BIGINT>>" for k in range(at, at + 60)]})

    class Watched(set):
        most = 0

        def add(self, entry):
            super().add(entry)
            Watched.most = max(Watched.most, len(self))

    monkeypatch.setattr(shapes, "set", Watched, raising=False)
    found = [entry for b in shapes._shape_keys(batches(6_000)) for entry in zip(*b.to_pydict().values())]
    assert set(found) == {("$", "a")} | {("$.a", f"k{k}") for k in range(6_000)}
    assert Watched.most <= 100 and max(held) <= 100
    wide = pa.RecordBatch.from_pydict({"shape": ["OBJECT<" + ", ".join(f"k{k}: BIGINT" for k in range(950)) + ", ``: INT>"]})
    assert sum(b.num_rows for b in shapes._shape_keys(iter([wide]))) == 951 and max(held) <= 100
