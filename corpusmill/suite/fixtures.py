"""Files in forms that Spark cannot write itself, made by tasks from rows of a table."""

from __future__ import annotations

import bz2
import gzip
import lzma
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from corpusmill.sources.decode import filesystem_of


def _long_window(data: bytes) -> bytes:
    params = zstandard.ZstdCompressionParameters.from_level(1, window_log=31)
    stream = zstandard.ZstdCompressor(compression_params=params).compressobj()
    return stream.compress(data) + stream.flush()


def _joined(data: bytes) -> bytes:
    return zstandard.compress(data[: len(data) // 3]) + zstandard.compress(data[len(data) // 3 :])


#: Folder name, file ending and encoder of each form a dump may have.
ENCODINGS = {
    "plain": (".jsonl", bytes),
    "gz": (".gz", gzip.compress),
    "bz2": (".bz2", bz2.compress),
    "xz": (".xz", lambda data: lzma.compress(data, preset=1)),
    "zst": (".zst", zstandard.compress),
    "zst_long": (".zst", _long_window),
    "zst_joined": (".zst", _joined),
    "mislabelled": (".json", gzip.compress),
}


def _write(path: str, data: bytes) -> None:
    fs, name = filesystem_of(path)
    fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(name, compression=None) as out:
        out.write(data)


def write_dumps(lines: DataFrame, folder: str, names: list[str], cut: float = 1.0) -> None:
    """One file per partition and encoding with the rows' single column of bytes as lines; ``cut`` keeps a part of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = b"".join(line + b"\n" for batch in batches for line in batch.column(0).to_pylist())
        number = TaskContext.get().partitionId()
        for name in names:
            ending, encode = ENCODINGS[name]
            packed = encode(data)
            _write(f"{folder}/{name}/part-{number:05d}{ending}", packed[: int(len(packed) * cut)])
        yield pa.RecordBatch.from_arrays([pa.array([len(data)], pa.int64())], names=["bytes"])

    lines.mapInArrow(run, "bytes long").collect()  # one number per file


def write_arrow(rows: DataFrame, folder: str, schema: pa.Schema) -> None:
    """One Parquet file per partition with exactly the Arrow types asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = pa.Table.from_batches(list(batches), rows_schema)
        columns = [
            pa.nulls(given.num_rows) if pa.types.is_null(f.type) else given.column(f.name).cast(f.type) for f in schema
        ]
        table = pa.Table.from_arrays(columns, schema=schema)
        sink = pa.BufferOutputStream()
        pq.write_table(table, sink)
        _write(f"{folder}/part-{TaskContext.get().partitionId():05d}.parquet", sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array([table.num_rows], pa.int64())], names=["rows"])

    from pyspark.sql.pandas.types import to_arrow_schema

    rows_schema = to_arrow_schema(rows.schema)
    rows.mapInArrow(run, "rows long").collect()  # one number per file
