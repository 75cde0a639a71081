import hashlib

import numpy as np
import pytest

import corpus_pipeline
from corpusmill.llm import byte_bpe, simhash
from corpusmill.llm.common import stage
from test_lines_and_copies import plain_groups, plain_line_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_by_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, stage(step(spark, docs, sf_dir), name)
        seen[name] = before.collect(), docs.collect()
        if name != "byte_bpe":
            assert docs.columns == COLUMNS

    given, known = seen["language_id"]
    assert set(known) <= set(given) and len(known) >= 0.98 * len(given)
    known, lines = seen["line_dedup"]
    want = [(i, t) for i, _, _, t in plain_line_dedup([(r["doc_id"], r["text"]) for r in known])]
    assert sorted(((r["doc_id"], r["text"]) for r in lines), key=str) == want
    assert all(r["n_chars"] == len(r["text"]) for r in lines)
    lines, single = seen["simhash_near_dedup"]
    prints = [(r["doc_id"], simhash.fingerprint(r["text"].encode())) for r in lines]
    groups = plain_groups(prints)
    assert sorted(r["doc_id"] for r in single) == sorted(i for i, fp in prints if groups[fp] == i)
    single, mixed = seen["source_mix"]
    assert set(mixed) <= set(single) and max(mixed.count(r) for r in set(mixed)) <= 3
    mixed, tokens = seen["byte_bpe"]
    raw = sorted((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in mixed)
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in tokens) == raw


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


@pytest.mark.parametrize("empty", [True, False])
def test_odd_tables(spark, messy_docs, empty):
    docs = messy_docs.limit(0) if empty else messy_docs
    docs = stage(docs, "odd")
    for name, step in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(step(spark, docs, ""), name)
        if name != "byte_bpe":
            assert docs.columns == columns
    assert docs.count() == 0 if empty else docs.count() > 0


def test_decoding_is_concatenation(tmp_path):
    import public_tokenizers

    table = byte_bpe._byte_table(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    assert b"".join(table[i] for i in np.arange(256)) != b"" and len(set(table)) == len(table)
