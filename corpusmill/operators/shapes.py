"""Which keys the objects of records have, and whether those keys are data.

A schema with a field per key is right for objects like structs and ruinous for objects like tables of ids: with a million
ids it would hold a million fields. Before a schema is built, the keys are counted per object path by mergeable sketches
of fixed size, and a path with too many is named in an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys an object may have before they count as data.
MAX_KEYS = 10_000
ROOT = "$"
#: Accuracy of the sketches, as a power of two: 12 is about 1.6 per cent, and exact for few keys.
SKETCH_BITS = 12
#: Distinct (path, key) pairs a task remembers at a time.
TASK_KEYS = 200_000
#: Characters of such pairs a task remembers at a time.
TASK_CHARS = 32 << 20

_KEYS = "path string, key string"
_PART = re.compile(r"`((?:[^`]|``)*)`\s*:|([^\s<>,:`()]+)\s*:|(OBJECT<|ARRAY<)|(>)")


class OpenKeys(ValueError):
    """Objects whose keys are data would give the schema a field per key."""

    def __init__(self, path: str, keys: int, first: str, last: str):
        self.path, self.keys = path, keys
        top = path.removeprefix(ROOT + ".").split(".")[0].split("[")[0]
        advice = f"name {top!r} in map_fields or json_fields" if path != ROOT else "keep the record as JSON text"
        super().__init__(f"the objects at {path} have about {keys:,} different keys, from {first!r} to {last!r}: {advice}")


def keys_of_shape(shape: str) -> Iterator[tuple[str, str]]:
    """Object paths and their keys in a schema text as ``schema_of_variant`` gives it; ``[]`` stands for list elements."""
    pending, frames = ROOT, []
    for part in _PART.finditer(shape):
        kind, text = part.lastindex, part[part.lastindex]
        if kind == 3:
            # a list's elements lie one step below it
            pending += "[]" if text == "ARRAY<" else ""
            frames.append(pending)
        elif kind == 4:
            frames.pop()
        else:
            key = text.replace("``", "`") if kind == 1 else text
            yield frames[-1], key
            pending = f"{frames[-1]}.{key}"


def _shape_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of shapes, but for those a task remembers: a full memory starts afresh, which costs repeats only."""
    seen: set[tuple[str, str]] = set()
    fresh, size = [], 0
    for batch in batches:
        for shape in batch.column("shape"):
            for entry in keys_of_shape(shape.as_py()):
                if entry in seen:
                    continue
                seen.add(entry)
                fresh.append(entry)
                size += len(entry[0]) + len(entry[1])
                if len(seen) >= TASK_KEYS or size >= TASK_CHARS:
                    yield _entries(fresh)
                    fresh, size = [], 0
                    seen.clear()
        if fresh:
            yield _entries(fresh)
            fresh = []


def _entries(pairs: list[tuple[str, str]]) -> pa.RecordBatch:
    paths, keys = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(keys, pa.string())], names=["path", "key"])


def object_keys(records: DataFrame, record: Column, max_keys: int = MAX_KEYS) -> DataFrame:
    """``path, keys, first_key, last_key, is_open`` of every object path of a VARIANT column.

    Records of one shape count once. ``keys`` is a sketch's estimate, and ``is_open`` tells whether it is above
    ``max_keys``.
    """
    shapes = records.select(F.schema_of_variant(record).alias("shape")).where("shape LIKE '%OBJECT<%'").distinct()
    entries = shapes.mapInArrow(_shape_keys, _KEYS)
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("key", F.lit(SKETCH_BITS)))
    counted = entries.groupBy("path").agg(sketch.alias("keys"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))
    return counted.withColumn("is_open", F.col("keys") > max_keys)


def open_paths(records: DataFrame, record: Column, max_keys: int = MAX_KEYS) -> list:
    """The open paths with no open path above them, widest first: never more than records have such fields."""
    found = object_keys(records, record, max_keys).where("is_open").collect()
    tops = [r for r in found if not any(r["path"].startswith((f"{o['path']}.", f"{o['path']}[")) for o in found)]
    return sorted(tops, key=lambda r: (-r["keys"], r["path"]))


def refuse_open_keys(records: DataFrame, record: Column, max_keys: int = MAX_KEYS) -> None:
    """Raise :class:`OpenKeys` for the widest object path whose keys are data."""
    for row in open_paths(records, record, max_keys)[:1]:
        raise OpenKeys(row["path"], row["keys"], row["first_key"], row["last_key"])
