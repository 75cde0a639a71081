"""Byte-level BPE encoding of whole texts by overlapping chunks, and decoding.

A long text is cut into chunks that overlap. Each chunk is pre-tokenised and encoded on its own, wherever it lies;
a chunk that starts inside a pre-token begins with wrong boundaries, but from the first boundary it shares with its
predecessor on, both agree, as a match of the pattern depends only on the text from its start. There the ids are
stitched. The cutter puts into every overlap a place where any tokenisation has a boundary, so stitching never fails.

The token table has one row per part of a document; its parts lie together and in order in one partition, so digests
of whole documents are taken as the parts stream by, with one part in memory.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import shuffle_partitions

# Code points a chunk owns, and those it shares with the next chunk at least.
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 64
MEMO_PIECES = 100_000
# Texts encoded into one output batch: bounds what a task holds of its output.
BATCH_ROWS = 256

TOKENS_SCHEMA = "doc_id long, row long, part int, parts int, ids binary"
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_CHUNK_SCHEMA = "doc_id long, row long, chunk int, chunks int, start long, head_end long, tail_start long, text string"
_LOOSE_SCHEMA = (
    "doc_id long, row long, chunk int, chunks int, ids binary, "
    "head_at array<long>, head_id array<long>, tail_at array<long>, tail_id array<long>"
)
# Where every tokenisation has a boundary: a run of letters or digits ends, or white space follows something else.
_SURE = r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=\S)(?=\s)"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as source:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, source)}


def _encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


def chunk_bounds(text: str, chunk: int, overlap: int, sure) -> list[tuple[int, int]]:
    """``(start, end)`` of each chunk; a chunk's end lies past a sure boundary that follows the next one's start."""
    bounds, start = [], 0
    while True:
        follows = start + chunk
        found = sure.search(text, follows + 1) if follows + 1 < len(text) else None
        if not found or found.end() >= len(text):
            bounds.append((start, len(text)))
            return bounds
        # a pre-token longer than the overlap: the next chunk starts close before its end
        follows = max(follows, found.end() - overlap)
        bounds.append((start, min(len(text), max(follows + overlap, found.end() + 1))))
        start = follows


def _whole(path: str, pattern: str):
    """Texts of one chunk: encoded in place."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path, pattern)
        for batch in (b.slice(at, BATCH_ROWS) for b in batches for at in range(0, b.num_rows, BATCH_ROWS)):
            ids = [np.array(encoding.encode_ordinary(t), "<u4").tobytes() for t in batch.column("text").to_pylist()]
            ones = pa.array([1] * len(ids), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array([0] * len(ids), pa.int32()), ones,
                 pa.array(ids, pa.binary())],
                names=["doc_id", "row", "part", "parts", "ids"],
            )

    return encode


def _cutter(chunk: int, overlap: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        sure = regex.compile(_SURE)
        names = ["doc_id", "row", "chunk", "chunks", "start", "head_end", "tail_start", "text"]
        for batch in batches:
            for doc_id, row, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "row", "text"))):
                bounds = chunk_bounds(text, chunk, overlap, sure)
                for n, (start, end) in enumerate(bounds):
                    head_end = bounds[n - 1][1] if n else 0
                    tail_start = bounds[n + 1][0] if n + 1 < len(bounds) else end
                    values = (doc_id, row, n, len(bounds), start, head_end, tail_start, text[start:end])
                    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 3, pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

    return cut


def _loose(path: str, pattern: str):
    """Chunks encoded each on its own, with the places of the boundaries in the two overlaps."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        encoding, matches, memo = _encoding(path, pattern), regex.compile(pattern), {}
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            ids, marks = [], {n: [] for n in ("head_at", "head_id", "tail_at", "tail_id")}
            for n, text in enumerate(columns["text"]):
                start, last = columns["start"][n], columns["chunk"][n] + 1 == columns["chunks"][n]
                head_end, tail_start = columns["head_end"][n], columns["tail_start"][n]
                found, total, pieces, here = [], 0, [], {k: [] for k in marks}
                for match in matches.finditer(text):
                    if match.end() == len(text) and not last:
                        break  # the next chunk's text may belong to this match
                    found.append((start + match.start(), match.group()))
                for at, piece in found:
                    if at < head_end:
                        here["head_at"].append(at)
                        here["head_id"].append(total)
                    if at >= tail_start:
                        here["tail_at"].append(at)
                        here["tail_id"].append(total)
                    if piece not in memo:
                        if len(memo) > MEMO_PIECES:
                            memo.clear()
                        memo[piece] = np.array(encoding.encode_ordinary(piece), "<u4").tobytes()
                    pieces.append(memo[piece])
                    total += len(memo[piece]) // 4
                if found:  # the end of the last match is a boundary as well
                    here["tail_at"].append(found[-1][0] + len(found[-1][1]))
                    here["tail_id"].append(total)
                ids.append(b"".join(pieces))
                for k in marks:
                    marks[k].append(here[k])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), batch.column("chunk"), batch.column("chunks"),
                 pa.array(ids, pa.binary()), *(pa.array(v, pa.list_(pa.int64())) for v in marks.values())],
                names=["doc_id", "row", "chunk", "chunks", "ids", *marks],
            )

    return encode


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted loose chunks in, parts of documents out: one chunk is held until its successor is seen."""
    held, first = None, 0
    for row in itertools.chain.from_iterable(batch.to_pylist() for batch in batches):
        if held is not None and row["chunk"] > 0:
            ends = dict(zip(held["tail_at"], held["tail_id"]))
            at, begin = next((a, i) for a, i in zip(row["head_at"], row["head_id"]) if a in ends)
            yield _part(held, first, ends[at])
            first = begin
        else:
            first = 0
        held = row
        if row["chunk"] + 1 == row["chunks"]:
            yield _part(row, first, len(row["ids"]) // 4)
            held = None


def _part(row: dict, begin: int, end: int) -> pa.RecordBatch:
    values = (row["doc_id"], row["row"], row["chunk"], row["chunks"], row["ids"][4 * begin : 4 * end])
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in zip(values, types)], names=["doc_id", "row", "part", "parts", "ids"]
    )


def _planned(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str, chunk: int, overlap: int, after, schema):
    """The token table, each partition of it run through ``after`` by the same worker that made it."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    whole = _whole(ranks_path, pattern)
    long_text = F.char_length("text") > chunk
    short = rows.where(~long_text).mapInArrow(lambda batches: after(whole(batches)), schema)
    n = shuffle_partitions(spark)
    loose = (
        rows.where(long_text)
        .mapInArrow(_cutter(chunk, overlap), _CHUNK_SCHEMA)
        .repartition(n, "row", "chunk")
        .mapInArrow(_loose(ranks_path, pattern), _LOOSE_SCHEMA)
    )
    in_order = loose.repartition(n, "row").sortWithinPartitions("row", "chunk")
    return short.unionByName(in_order.mapInArrow(lambda batches: after(_stitch(batches)), schema))


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """Token ids of every text: ``doc_id, row, part, parts, ids`` (little-endian unsigned 32-bit), joined by part.

    The ids are those of encoding each match of the pattern on its own, without special tokens. A NULL or empty text
    gives one part without ids; repeated rows are told apart by ``row``. Other columns of ``docs`` are not read.
    """
    return _planned(docs, ranks_path, pattern, id_col, text_col, chunk_chars, overlap_chars, iter, TOKENS_SCHEMA)


def _decoder(ranks_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _byte_table(ranks_path)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            out = [b"".join(map(of.__getitem__, np.frombuffer(part, "<u4").tolist())) for part in ids]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "bytes"]
            )

    return run


def decode(tokens: DataFrame, ranks_path: str) -> DataFrame:
    """The bytes each part's ids stand for, one token's raw bytes after the other, as column ``bytes``."""
    return tokens.mapInArrow(_decoder(ranks_path), f"{TOKENS_SCHEMA}, bytes binary")


def _byte_table(ranks_path: str) -> list[bytes]:
    ranks = load_ranks(ranks_path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decoded parts in, one row per document out: its parts follow each other."""
    ids_hash = bytes_hash = None
    for batch in batches:
        done = []
        names = ("doc_id", "part", "parts", "ids", "bytes")
        for doc_id, part, parts, ids, text in zip(*(batch.column(n).to_pylist() for n in names)):
            if part == 0:
                ids_hash, bytes_hash, n_tokens = hashlib.sha256(), hashlib.sha256(), 0
            ids_hash.update(ids)
            bytes_hash.update(text)
            n_tokens += len(ids) // 4
            if part + 1 == parts:
                done.append((doc_id, n_tokens, ids_hash.hexdigest(), bytes_hash.hexdigest()))
        columns = list(zip(*done)) if done else [[], [], [], []]
        types = (pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def digests(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """Per row ``doc_id, n_tokens, ids_sha256, decoded_sha256``: what :func:`encode` and :func:`decode` give, digested.

    Encoding, decoding and digesting run in the same worker, so neither ids nor bytes travel between them.
    """
    decoder = _decoder(ranks_path)
    return _planned(
        docs, ranks_path, pattern, id_col, text_col, chunk_chars, overlap_chars,
        lambda batches: _digests(decoder(batches)), DIGEST_SCHEMA,
    )
