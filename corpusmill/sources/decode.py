"""Per-task decoding of compressed text files that Spark's own text source cannot read, or not safely.

Runs inside ``mapInArrow``: each input row names a file, each output row holds some whole lines of it. A stream is decoded
once, piece by piece; memory stays at one block plus one unfinished line. Where a stream breaks, every whole line decoded
before the break has been given out, and an error row follows: the same for all codecs and sizes.
"""

from __future__ import annotations

import bz2
import codecs
import io
import lzma
import os
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs

try:
    import zstandard
except ImportError:  # reported when a zstd file is met
    zstandard = None

# Bytes read at a time, the most one call may decode them to, and the text of one output row, about.
READ_BYTES = 64 << 10
PIECE_BYTES = 4 << 20
BLOCK_BYTES = 1 << 20
MAX_ZSTD_WINDOW = 1 << 31

# Leading bytes of each format.
MAGIC = {
    "zstd": bytes.fromhex("28B52FFD"),
    "xz": bytes.fromhex("FD377A585A00"),
    "bz2": b"BZh",
    "gz": bytes.fromhex("1F8B"),
}
CODEC_OF_EXTENSION = {".zst": "zstd", ".zstd": "zstd", ".xz": "xz", ".bz2": "bz2", ".gz": "gz"}

SNIFF_SCHEMA = "path string, length long, codec string, real_path string"
BLOCKS_SCHEMA = "path string, lines string, error string"
_BLOCKS_ARROW = pa.schema([("path", pa.string()), ("lines", pa.string()), ("error", pa.string())])
_CORRUPT = (EOFError, lzma.LZMAError, zlib.error, OSError, ValueError)


class ReadFailed(RuntimeError):
    """Storage trouble, not bad data: the task fails and Spark retries it."""


class Unreadable(ValueError):
    """The file is gone or may not be read: reported for that file, the others go on."""


def filesystem_of(path: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system a path lives on, and the path as that file system names it."""
    if path.startswith("file:") or "://" not in path:
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    scheme, rest = path.split("://", 1)
    return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{quote(rest)}")


class _Storage(io.RawIOBase):
    def __init__(self, path: str):
        self._file = None
        try:
            fs, name = filesystem_of(path)
            self._file = fs.open_input_stream(name, compression=None, buffer_size=1 << 20)
        except (PermissionError, FileNotFoundError) as error:
            raise Unreadable(str(error)) from error
        except Exception as error:
            raise ReadFailed(f"cannot open {path}: {error}") from error

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        try:
            return self._file.readinto(buffer)
        except Exception as error:
            raise ReadFailed(str(error)) from error

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
        super().close()


def sniff(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Name the codec of each file by its first bytes, else by its ending."""
    for batch in batches:
        rows = []
        for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
            try:
                with _Storage(path) as raw:
                    head = io.BufferedReader(raw).read(8)
                codec = next((name for name, magic in MAGIC.items() if head.startswith(magic)), None)
                codec = codec or CODEC_OF_EXTENSION.get(os.path.splitext(path)[1].lower(), "plain")
            except Unreadable:
                codec = "unreadable"
            local = "://" not in path
            rows.append(
                {"path": path, "length": length, "codec": codec, "real_path": os.path.realpath(path) if local else path}
            )
        yield pa.RecordBatch.from_pylist(
            rows,
            schema=pa.schema(
                [("path", pa.string()), ("length", pa.int64()), ("codec", pa.string()), ("real_path", pa.string())]
            ),
        )


class _Zstd:
    """One frame, in the form of the standard library's decompressors."""

    def __init__(self):
        if zstandard is None:
            raise ReadFailed("zstd files need the 'zstandard' package on every executor")
        self._frame = zstandard.ZstdDecompressor(max_window_size=MAX_ZSTD_WINDOW).decompressobj()

    def pieces(self, data: bytes) -> Iterator[bytes]:
        yield self._frame.decompress(data)

    eof = property(lambda self: self._frame.eof)
    unused_data = property(lambda self: self._frame.unused_data)


class _Gzip:
    def __init__(self):
        self._member = zlib.decompressobj(wbits=31)

    def pieces(self, data: bytes) -> Iterator[bytes]:
        while data:
            yield self._member.decompress(data, PIECE_BYTES)
            data = self._member.unconsumed_tail

    eof = property(lambda self: self._member.eof)
    unused_data = property(lambda self: self._member.unused_data)


class _Bounded:
    """bz2 and xz: a small input may stand for a very long output, so that is taken in steps."""

    def __init__(self, decompressor):
        self._stream = decompressor()

    def pieces(self, data: bytes) -> Iterator[bytes]:
        yield self._stream.decompress(data, PIECE_BYTES)
        while not (self._stream.eof or self._stream.needs_input):
            yield self._stream.decompress(b"", PIECE_BYTES)

    eof = property(lambda self: self._stream.eof)
    unused_data = property(lambda self: self._stream.unused_data)


DECODERS = {
    "zstd": _Zstd,
    "gz": _Gzip,
    "bz2": lambda: _Bounded(bz2.BZ2Decompressor),
    "xz": lambda: _Bounded(lzma.LZMADecompressor),
}


def decoded(raw: io.RawIOBase, codec: str) -> Iterator[bytes]:
    """The decoded bytes of all members, frames or streams a file is made of; a file cut short is an error."""
    if codec == "plain":
        while data := raw.read(READ_BYTES):
            yield data
        return
    stream = None
    while data := raw.read(READ_BYTES):
        while data:
            if stream is None:
                data = data.lstrip(b"\0")  # padding between streams
                if not data:
                    break
                stream = DECODERS[codec]()
            yield from stream.pieces(data)
            if not stream.eof:
                break
            data, stream = stream.unused_data, None
    if stream is not None:
        raise EOFError("the file ends before its stream does")


def line_blocks(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole lines in blocks, every line ending turned into a newline, the last one of a block left out.

    A byte-order mark is dropped. When ``pieces`` raises, the lines before the break have been yielded, but not the
    unfinished one.
    """
    held, size, first = [], 0, True

    def normal(text: bytes) -> bytes:
        return text.replace(b"\r\n", b"\n").replace(b"\r", b"\n") if b"\r" in text else text

    def whole_lines() -> Iterator[bytes]:
        nonlocal held, size, first
        text = b"".join(held)
        # a carriage return at the edge may be the first half of a pair
        edge = len(text) - text.endswith(b"\r")
        cut = max(text.rfind(b"\n", 0, edge), text.rfind(b"\r", 0, edge)) + 1
        held, size = [text[cut:]], len(text) - cut
        if cut:
            lines = text[:cut].removeprefix(codecs.BOM_UTF8) if first else text[:cut]
            first = False
            yield normal(lines)[:-1]

    try:
        for piece in pieces:
            held.append(piece)
            size += len(piece)
            if size >= BLOCK_BYTES and (b"\n" in piece or b"\r" in piece):
                yield from whole_lines()
    except Exception:
        yield from whole_lines()
        raise
    rest = b"".join(held)
    rest = rest.removeprefix(codecs.BOM_UTF8) if first else rest
    if rest:
        yield normal(rest).removesuffix(b"\n")


def _row(path: str, lines: str | None, error: str | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in (path, lines, error)], schema=_BLOCKS_ARROW)


def decode_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(path, codec)`` in; blocks of lines out, and one error row per broken file."""
    corrupt = _CORRUPT + ((zstandard.ZstdError,) if zstandard else ())
    for batch in batches:
        for path, codec in zip(batch.column("path").to_pylist(), batch.column("codec").to_pylist()):
            try:
                with _Storage(path) as raw:
                    for block in line_blocks(decoded(io.BufferedReader(raw, 1 << 20), codec)):
                        yield _row(path, block.decode("utf-8", "replace"))
            except corrupt as error:
                yield _row(path, None, f"{type(error).__name__}: {error}")
