"""A corpus pipeline in five stages: language, repeated lines, near duplicates, source mix, token ids.

Every stage takes the table its predecessor wrote and returns the next one; all but the last return the columns of
``documents``. ``run`` applies them in order, each result written as Parquet to the shared scratch folder and read back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import byte_bpe, language_id, line_dedup, mixing, simhash
from corpusmill.llm.common import stage
from corpusmill.llm.suite import BYTE_RANKS

#: Documents whose language is less certain than this are rejected.
MIN_LANGUAGE_SCORE = 0.5


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those without letters and those with an unsure language go.

    The languages are learned from the documents' own labels; if there is none, nothing can be told and all go.
    """
    found = language_id.identify(docs, language_id.train(docs))
    sure = (F.col("found.lang") != language_id.UNDETERMINED) & (F.col("found.score") >= MIN_LANGUAGE_SCORE)
    return found.where(sure).select("doc.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a document of smaller id holds; ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(docs)
    fresh = {"text": F.col("kept.text"), "n_chars": F.char_length("kept.text").cast("long")}
    return kept.select(*[fresh.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id.

    Groups are those of SimHash fingerprints of three-word shingles at two bits or fewer. Texts without a word, such as
    what line dedup emptied, are one group.
    """
    return simhash.one_of_each(docs, shingle_words=simhash.SHINGLE_WORDS, max_bits=simhash.MAX_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: rows may repeat up to three times, each shard in random order."""
    return mixing.mix(docs).select("doc.*")


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row of the mix its number of token ids, and digests of the ids and of the bytes they decode to."""
    path = public_tokenizers.path(BYTE_RANKS)
    return byte_bpe.digests(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", keep_known_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("byte_bpe", encode_texts),
]

#: Language scores are sums of logarithms learned from a hashed share of the rows: SQL cannot express the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
