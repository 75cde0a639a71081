"""Line dedup against levelled sorted runs of line hashes.

A run is a table bucketed and sorted by a 128-bit line hash, with the smallest document id that holds the line. Batches
arrive in order of document id. Each batch reduces to its distinct lines and merge-anti-joins the runs, which lie ready
bucketed, so only the batch is shuffled; what is new becomes a run of level 0. When a level holds ``fanout`` runs they
are compacted into one of the next level. A line belongs to one run only, so the runs together name the owner of every
line, and a document loses the lines that another document owns.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import shuffle_partitions, stage, utf8
from corpusmill.session import scratch_dir

MIN_CHARS = 10
BATCHES = 3
FANOUT = 2

_KEYS_SCHEMA = "doc_id long, h1 long, h2 long"


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The key of each line: blanks stripped, A-Z lower-cased; None where it is shorter than ``min_chars``."""
    keys = []
    for line in text.split(b"\n"):
        key = line.strip(b" \t\n\r\x0b\x0c")
        if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
            keys.append(None)
        else:
            keys.append(key.lower())  # on bytes, only A-Z
    return keys


def _hashes(keys: list[bytes]) -> np.ndarray:
    import xxhash

    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(k) for k in keys]), "<i8").reshape(-1, 2)


def _keyed(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                keys = {k for k in line_keys(text, min_chars) if k is not None}
                ids += [doc_id] * len(keys)
                found += keys
            hashes = _hashes(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(hashes[:, 0]), pa.array(hashes[:, 1])], names=["doc_id", "h1", "h2"]
            )

    return run


class LineRuns:
    """The levels of runs. ``path`` lies in a folder all executors share; tables are named in the session's catalog."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout, self.buckets = spark, fanout, shuffle_partitions(spark)
        self.levels: list[list[tuple[str, str]]] = [[]]

    def runs(self) -> list[tuple[str, str]]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> None:
        """Take in a batch ``(doc_id, h1, h2)`` whose document ids follow all earlier ones."""
        new = batch.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner"))
        for table, _ in self.runs():
            new = new.join(self.spark.table(table).hint("merge"), ["h1", "h2"], "left_anti")
        self._write(new, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            tables = [self.spark.table(t) for t, _ in self.levels[level]]
            self._write(reduce(DataFrame.unionByName, tables), level + 1)
            for table, _ in self.levels[level]:
                self.spark.sql(f"DROP TABLE {table}")
            self.levels[level] = []
            level += 1

    def _write(self, rows: DataFrame, level: int) -> None:
        table, path = f"line_run_{uuid.uuid4().hex}", scratch_dir(self.spark, f"line-run-{level}")
        ordered = rows.select("h1", "h2", "owner").repartition(self.buckets, "h1", "h2")
        ordered.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", path).saveAsTable(table)
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append((table, path))

    def owners(self) -> DataFrame:
        """Every line once, with the smallest document id that holds it."""
        paths = [path for _, path in self.runs()]
        return self.spark.read.schema("h1 long, h2 long, owner long").parquet(*paths)

    def close(self) -> None:
        """Forget the table names; the files stay readable by path."""
        for table, _ in self.runs():
            self.spark.sql(f"DROP TABLE {table}")


def foreign_lines(docs: DataFrame, min_chars: int, batches: int, fanout: int) -> DataFrame:
    """``doc_id, foreign``: the hashes of lines each document loses because a smaller id holds them."""
    spark = docs.sparkSession
    edges = docs.select(F.percentile_approx("doc_id", [n / batches for n in range(1, batches)], 10_000)).first()[0]
    batch_no = reduce(lambda total, edge: total + (F.col("doc_id") > edge).cast("int"), edges or [], F.lit(0))
    keyed = docs.select("doc_id", utf8("text").alias("text")).mapInArrow(_keyed(min_chars), _KEYS_SCHEMA)
    # ids of NULL come last and count as one document
    keyed = stage(keyed.withColumn("batch", F.coalesce(batch_no, F.lit(batches))), "line-keys", ["batch"])
    runs = LineRuns(spark, fanout)
    try:
        for number in range(batches + 1):
            rows = keyed.where(F.col("batch") == number)
            if number < batches or not rows.isEmpty():
                runs.add(rows.drop("batch"))
    finally:
        runs.close()
    # a line may be in a third of all documents: both sides are plain shuffles, so AQE can split it
    return (
        keyed.join(runs.owners(), ["h1", "h2"])
        .where(~F.col("owner").eqNullSafe(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("h1", "h2")).alias("foreign"))
    )


def _kept(min_chars: int):
    @F.arrow_udf("n_lines long, n_dropped long, text string")
    def kept(texts: pa.Array, foreign: pa.Array) -> pa.Array:
        import xxhash

        rows = []
        for text, hashes in zip(texts.to_pylist(), foreign.to_pylist()):
            lines = keep = text.split(b"\n")
            if hashes:
                drop = {np.array([h["h1"], h["h2"]], "<i8").tobytes() for h in hashes}
                keep = [
                    line
                    for line, key in zip(lines, line_keys(text, min_chars))
                    if key is None or xxhash.xxh3_128_digest(key) not in drop
                ]
            rows.append((len(lines), len(lines) - len(keep), b"\n".join(keep).decode("utf-8", "replace")))
        n_lines, n_dropped, left = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(left, pa.string())],
            names=["n_lines", "n_dropped", "text"],
        )

    return kept


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """``doc, kept``: every row as a struct, and ``kept`` with ``n_lines``, ``n_dropped`` and the ``text`` that is left.

    A text loses the lines that a document of smaller id holds. A line's key is the line without blanks at its ends,
    A-Z lower-cased; keys shorter than ``min_chars`` stay everywhere. A document keeps every line it owns, also repeated
    ones. A NULL or empty text is one empty line. Rows that repeat a document id count as one document; rows without id
    count as one document that comes after all others. Very long texts are split whole, one at a time. The columns of ``docs`` travel in the struct, whatever their names.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    foreign = foreign_lines(named, min_chars, batches, fanout)
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).cast("long").alias("doc_id")).alias("t")
    # the texts stream past hash tables of hashes: they are neither sorted nor spilled
    joined = rows.join(
        foreign.alias("f").hint("shuffle_hash"), F.col("t.doc_id").eqNullSafe(F.col("f.doc_id")), "left"
    )
    text = F.coalesce(F.col("t.doc").getField(text_col).cast("binary"), F.lit(b"").cast("binary"))
    return joined.select("t.doc", _kept(min_chars)(text, F.col("f.foreign")).alias("kept"))
