"""Token counts through a cache keyed by digests of the normalised text and of the tokenizer's version.

A count depends only on the normalised text and the tokenizer, so it is stored under both digests. A run joins
its documents' digests to the cache, sends one text per unknown digest to the tokenizer, appends the new counts,
and reads every count from the cache. Copies, and texts counted by an earlier run, are never encoded again.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import stage

CACHE_SCHEMA = "digest binary, n_tokens long"
# Longer texts are encoded in pieces cut at a space, where no token can reach across.
PIECE_CHARS = 1 << 20
# Distinct words whose counts a task remembers before it starts afresh.
MEMO_WORDS = 400_000
# Longer words are encoded each time.
MEMO_CHARS = 64

# Characters for which one-to-one lower-casing is exact and composition changes nothing.
_PLAIN = "\\x20-\\x7e\\t\\n\\rÀ-ÖØ-öø-ÿ"


def tokenizer_version(path: str) -> str:
    """SHA-256 of the tokenizer file and the release of the library that reads it."""
    import tokenizers

    digest = hashlib.sha256(f"tokenizers {tokenizers.__version__}\n".encode())
    with open(path, "rb") as source:
        digest.update(source.read())
    return digest.hexdigest()


def normalised(text: Column) -> Column:
    """Content on which the count can depend: runs of blanks count as one, and so does case in plain Latin texts.

    Texts with ``<|`` keep their case, as special strings are told apart by it, and so do texts with other scripts
    or combining marks, where lower-casing could meet composition.
    """
    trimmed = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\t\r\n ]*[\t\r\n][\t\r\n ]*| {2,}", " "))
    plain = trimmed.rlike(f"^[{_PLAIN}]*$") & ~trimmed.contains("<|")
    return F.when(plain, F.lower(trimmed)).otherwise(trimmed)


class WordCounter:
    """Counts tokens of lower-case word-end BPE tokenizers, remembering the count of each word met.

    For plain texts the pre-token pattern is applied here and each distinct pre-token goes to the library's model
    once; any other text goes to the library whole. Both give the library's count.
    """

    # Fixed value: the tokenizer file's own pre-token pattern, its classes narrowed to the plain characters.
    LETTERS = "a-zß-öø-ÿ"
    PRE_TOKENS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\x20\t\n\r{LETTERS}0-9]+")
    PLAIN = re.compile("[\x20-\x7e\t\n\rÀ-ÖØ-öø-ÿ]*")

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        pattern = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.word_wise = steps[0].get("pattern", {}).get("Regex") == pattern
        # byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in printable]
        self.alphabet = [chr(b) if b in printable else chr(256 + hidden.index(b)) for b in range(256)]
        self.memo = _Memo(self._model_count)

    def _model_count(self, word: str) -> int:
        return len(self.library.model.tokenize("".join([self.alphabet[b] for b in word.encode()])))

    def count(self, text: str) -> int:
        return sum(self._count_piece(piece) for piece in cut_at_spaces(text, PIECE_CHARS))

    def _count_piece(self, text: str) -> int:
        if self.word_wise and "<|" not in text and self.PLAIN.fullmatch(text):
            if len(self.memo) > MEMO_WORDS:
                self.memo.clear()
            return sum(map(self.memo.__getitem__, self.PRE_TOKENS.findall(text.lower())))
        return len(self.library.encode(text, add_special_tokens=False).ids)


class _Memo(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= MEMO_CHARS:
            self[key] = value
        return value


def cut_at_spaces(text: str, size: int) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, each but the first starting at a space."""
    start = 0
    while len(text) - start > size:
        cut = text.rfind(" ", start + 1, start + size)
        if cut < 0:
            cut = text.find(" ", start + size)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


@lru_cache(maxsize=1)
def word_counter(path: str, version: str) -> WordCounter:
    """One counter per process: tasks that follow each other in a worker share it, as each load leaves memory behind."""
    return WordCounter(path)


def _encoder(path: str, version: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = word_counter(path, version)
        for batch in batches:
            counts = [counter.count(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest").cast(pa.binary()), pa.array(counts, pa.int64())], names=["digest", "n_tokens"]
            )

    return encode


def cached_counts(spark: SparkSession, cache_path: str, version: str, digests: DataFrame) -> DataFrame:
    """``digest, n_tokens`` stored for some digests under one tokenizer version; what two runs appended counts once.

    A cache grows with all runs: only the digests asked for go on to the aggregation.
    """
    stored = spark.read.schema(CACHE_SCHEMA).parquet(version_path(spark, cache_path, version))
    return stored.join(digests, "digest", "left_semi").groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def version_path(spark: SparkSession, cache_path: str, version: str) -> str:
    """The folder of one tokenizer version in the cache: runs with other tokenizers never read it."""
    path = f"{cache_path.rstrip('/')}/tokenizer={version}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


def token_counts(
    docs: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row, counted without begin, end or added special tokens.

    ``cache_path`` names a folder that later runs find again: what they know is not encoded anew. A NULL or empty text has
    0 bytes and 0 tokens. Repeated rows each come back; a NULL id stays NULL; very long texts are encoded in pieces. Other
    columns of ``docs`` are not read, so their names do not matter.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer_path)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # with its id, a plain hash of the text names a row's text again without normalising it twice
    texts = texts.withColumn("place", F.xxhash64("text"))
    digest = F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest")
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    # digests are a few bytes a document: staged, they spare another pass over the texts
    digests = stage(texts.select("doc_id", "place", n_bytes, digest), "token-digests")

    mine = stage(digests.select("digest").distinct(), "token-keys")
    known = cached_counts(spark, cache_path, version, mine)
    first = F.min(F.struct("doc_id", "place")).alias("first")
    misses = digests.groupBy("digest").agg(first).join(known, "digest", "left_anti").select("digest", "first.*")
    # the texts stream past hash tables of ids: they are neither sorted nor spilled
    wanted = texts.alias("t").join(
        misses.alias("m").hint("shuffle_hash"),
        (F.col("t.place") == F.col("m.place")) & F.col("t.doc_id").eqNullSafe(F.col("m.doc_id")),
    )
    fresh = wanted.select("m.digest", "t.text").mapInArrow(
        _encoder(tokenizer_path, version), "digest binary, n_tokens long"
    )
    fresh.write.mode("append").parquet(version_path(spark, cache_path, version))
    # many documents may share a digest: between staged tables both sides are plain shuffles, so AQE can split a hot one
    return digests.join(stage(cached_counts(spark, cache_path, version, mine), "token-counts"), "digest").select("doc_id", "n_bytes", "n_tokens")
