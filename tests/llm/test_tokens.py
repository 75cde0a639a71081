import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import byte_bpe, token_counts
from corpusmill.session import scratch_dir

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={}
    )


def scraps(seed, n, sep=""):
    rng = random.Random(seed)
    parts = ["a", "bc", "X", "é", "É", "ß", "1", "23", "'", "'s", "'ll", "\"", ".", "--", " ", "  ", "\n", "\t", "\r\n", " ",
             "漢", "😀", "é", "<|", "<|endoftext|>", "²", "_", "İ", "J̌"]
    return [sep.join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(n)]


def test_counts_are_the_librarys(spark, messy_docs, library):
    found = token_counts.token_counts(messy_docs, WORDS, scratch_dir(spark, "cache")).collect()
    want = []
    for row in messy_docs.collect():
        text = row["text"] or ""
        want.append((row["doc_id"], len(text.encode()), len(library.encode(text, add_special_tokens=False).ids)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_counter_on_scraps(library):
    counter = token_counts.WordCounter(WORDS)
    assert counter.word_wise
    for text in scraps(1, 3000):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_pieces_cut_at_spaces_keep_the_count(library, monkeypatch):
    monkeypatch.setattr(token_counts, "PIECE_CHARS", 9)
    counter = token_counts.WordCounter(WORDS)
    for text in scraps(2, 800, " "):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_normal_form_keeps_the_count(spark, library):
    texts = scraps(3, 1500)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for text, normal in df.select("text", token_counts.normalised(df.text)).collect():
        a, b = (len(library.encode(t, add_special_tokens=False).ids) for t in (text, normal))
        assert a == b, (text, normal)


def test_cache_is_used_and_filled(spark, make_docs):
    cache, version = scratch_dir(spark, "cache"), token_counts.tokenizer_version(WORDS)
    docs = make_docs([(1, "one two", "en", "a"), (2, "ONE  two ", "en", "a"), (3, "three", "en", "a")])

    def stored(of=version):
        return spark.read.schema(token_counts.CACHE_SCHEMA).parquet(f"{cache}/tokenizer={of}")

    first = token_counts.token_counts(docs, WORDS, cache)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in first.collect()) == [(1, 2), (2, 2), (3, 1)]
    assert stored().count() == 2  # equal content is encoded once
    token_counts.token_counts(docs, WORDS, cache).count()
    assert stored().count() == 2
    # counts of another tokenizer lie elsewhere, and stored counts are believed
    stored().select("digest", (F.col("n_tokens") + 97).alias("n_tokens")).write.parquet(f"{cache}/tokenizer=other")
    assert token_counts.token_counts(docs, WORDS, cache).agg({"n_tokens": "max"}).first()[0] == 2
    stored("other").write.mode("append").parquet(f"{cache}/tokenizer={version}")
    assert token_counts.token_counts(docs, WORDS, cache).agg({"n_tokens": "max"}).first()[0] == 99


def test_second_call_of_the_query_encodes_nothing(spark):
    from corpusmill.llm import suite
    from corpusmill.session import shared_dir

    folder = f"{shared_dir(spark)}/token-counts/tokenizer={token_counts.tokenizer_version(WORDS)}"
    first = {r["doc_id"]: r for r in suite.op1_token_counts(spark, "/root/testdata/sf0.001").collect()}
    before = spark.read.parquet(folder).count()
    again = {r["doc_id"]: r for r in suite.op1_token_counts(spark, "/root/testdata/sf0.001").collect()}
    assert first == again and spark.read.parquet(folder).count() == before > 0
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in again.values())


def test_no_documents(spark, make_docs):
    empty = make_docs([])
    assert token_counts.token_counts(empty, WORDS, scratch_dir(spark, "cache")).collect() == []
    assert byte_bpe.digests(empty, RANKS, public_tokenizers.PATTERN).collect() == []
    assert byte_bpe.decode(byte_bpe.encode(empty, RANKS, public_tokenizers.PATTERN), RANKS).collect() == []


@pytest.mark.parametrize("chunk,overlap", [(byte_bpe.CHUNK_CHARS, byte_bpe.OVERLAP_CHARS), (50, 8)])
def test_ids_and_bytes(messy_docs, encoding, chunk, overlap):
    sizes = {"chunk_chars": chunk, "overlap_chars": overlap}
    found = byte_bpe.digests(messy_docs, RANKS, public_tokenizers.PATTERN, **sizes).collect()
    parts = byte_bpe.decode(byte_bpe.encode(messy_docs, RANKS, public_tokenizers.PATTERN, **sizes), RANKS).collect()
    texts = {}
    for part in sorted(parts, key=lambda r: (r["row"], r["part"])):
        texts[part["row"]] = texts.get(part["row"], b"") + bytes(part["bytes"])
    assert sorted(texts.values()) == sorted((r["text"] or "").encode() for r in messy_docs.collect())
    want = []
    for row in messy_docs.collect():
        ids = np.array(encoding.encode_ordinary(row["text"] or ""), "<u4")
        raw = (row["text"] or "").encode()
        want.append((row["doc_id"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_stitching_small_chunks(make_docs, encoding):
    texts = scraps(4, 300) + ["a" * 500, " " * 300, "\n" * 99 + "x", "!" * 200 + "'s", "x'" * 90, "1 " * 80, "a'sb" * 60]
    docs = make_docs([(n, t, None, None) for n, t in enumerate(texts)])
    tokens = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk_chars=6, overlap_chars=3).collect()
    by_doc = {}
    for row in sorted(tokens, key=lambda r: (r["doc_id"], r["part"])):
        by_doc[row["doc_id"]] = by_doc.get(row["doc_id"], b"") + bytes(row["ids"])
    for n, text in enumerate(texts):
        assert by_doc[n] == np.array(encoding.encode_ordinary(text), "<u4").tobytes(), repr(text)
    assert any(row["parts"] > 3 for row in tokens)


def test_tasks_of_a_process_share_one_counter(monkeypatch):
    loads = []
    monkeypatch.setattr(token_counts, "WordCounter", lambda path, real=token_counts.WordCounter: loads.append(path) or real(path))
    batch = pa.RecordBatch.from_pydict({"digest": [b"1", b"2"], "text": ["one two", "x" * 200]})
    for _ in range(3):
        (found,) = token_counts._encoder(WORDS, "of this test")(iter([batch]))
        assert found.column("n_tokens")[0].as_py() == 2
    assert loads == [WORDS]
    assert set(token_counts.word_counter(WORDS, "of this test").memo) == {"one", "two"}  # a memo of short words only
