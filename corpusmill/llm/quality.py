"""Quality by importance resampling.

Target and raw text are each modelled as a bag of hashed word unigrams and bigrams. A document's log importance weight is
the sum over its n-grams of the log ratio of the two models, and Gumbel top-k on the weights draws k documents without
replacement in proportion to their importance. The raw model counts every document; the target model counts labelled
good documents, of which a bounded number is drawn by a hash of the id.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import stage
from corpusmill.llm.token_counts import PIECE_CHARS, cut_at_spaces

BUCKETS = 10_000
TARGET_DOCS = 20_000
SEED = 11
MEMO_TOKENS = 400_000
# Bins of one pass over the keys, and rows that one task may rank: both bound work, neither drops rows.
BINS, RANKED_ROWS = 4_096, 20_000
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Features:
    """Buckets of a text's word unigrams and bigrams."""

    def __init__(self, buckets: int):
        self.buckets, self.memo = np.uint64(buckets), {}

    def of(self, text: str) -> Iterator[np.ndarray]:
        last = None
        for piece in cut_at_spaces(text, PIECE_CHARS):
            tokens = _TOKEN.findall(piece.lower())
            for token in set(tokens).difference(self.memo):
                self.memo[token] = zlib.crc32(token.encode("utf-8", "surrogatepass")) * 0x9E3779B1 & 0xFFFFFFFFFFFF
            one = np.fromiter(map(self.memo.__getitem__, tokens), np.uint64, len(tokens))
            if len(self.memo) > MEMO_TOKENS:
                self.memo.clear()
            yield (one % self.buckets).astype(np.int64)
            run = one if last is None else np.concatenate((last, one))
            with np.errstate(over="ignore"):
                two = (run[:-1] * _FACTOR ^ run[1:]) * _FACTOR >> np.uint64(16)
            yield (two % self.buckets).astype(np.int64)
            last = run[-1:] if len(run) else None


def _counter(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target, features = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64), Features(buckets)
        for batch in batches:
            for text, good in zip(batch.column("text").to_pylist(), batch.column("good").to_pylist()):
                for found in features.of(text):
                    counted = np.bincount(found, minlength=buckets)
                    raw += counted
                    if good:
                        target += counted
        met = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array(raw[met]), pa.array(target[met])], names=["bucket", "raw", "target"]
        )

    return run


def log_ratios(docs: DataFrame, good_ids: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket log of target over raw probability. ``docs`` holds ``doc_id, text``, ``good_ids`` a bounded ``doc_id``."""
    good = F.broadcast(good_ids.select(F.col("doc_id").alias("good_id")))
    marked = docs.join(good, F.col("doc_id") == F.col("good_id"), "left").select(
        F.coalesce("text", F.lit("")).alias("text"), F.col("good_id").isNotNull().alias("good")
    )
    counted = (
        marked.mapInArrow(_counter(buckets), "bucket int, raw long, target long")
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    )  # at most one row per bucket
    raw, target = np.ones(buckets), np.ones(buckets)
    for row in counted:
        raw[row["bucket"]] += row["raw"]
        target[row["bucket"]] += row["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigher(ratios: np.ndarray):
    """A function of a text column giving its log importance weight and its number of n-grams."""

    @F.arrow_udf("log_weight double, n_grams long")
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = Features(len(ratios))
        for texts in batches:
            weights, sizes = [], []
            for text in texts.to_pylist():
                found = list(features.of(text or ""))
                weights.append(float(sum(ratios[f].sum() for f in found)))
                sizes.append(sum(map(len, found)))
            yield pa.StructArray.from_arrays(
                [pa.array(weights, pa.float64()), pa.array(sizes, pa.int64())], names=["log_weight", "n_grams"]
            )

    return weigh


def top_k(rows: DataFrame, k: int, key: str, tie: str) -> DataFrame:
    """``rows`` with ``selected``: the k highest of column ``key``, ties to the smaller ``tie``.

    The threshold is closed in on by histograms of the key, so no sort or single task sees more than a small band.
    """
    low, high, above = -float("inf"), float("inf"), 0
    edge = rows.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n")).first()
    if k >= edge["n"] or k <= 0 or edge["low"] is None:
        return rows.withColumn("selected", F.lit(k > 0))
    low, high, band = edge["low"], edge["high"], edge["n"]
    while band > RANKED_ROWS and high > low:
        width = (high - low) / BINS
        inside = rows.where(F.col(key).between(low, high))
        bin_of = F.least(F.floor((F.col(key) - low) / width), F.lit(BINS - 1))
        bins = inside.groupBy(bin_of.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
        )
        for row in sorted(bins.collect(), key=lambda r: -r["bin"]):  # at most BINS rows
            if above + row["n"] >= k:
                break
            above += row["n"]
        if (row["low"], row["high"]) == (low, high):
            break
        low, high, band = row["low"], row["high"], row["n"]
    order = Window.partitionBy("band").orderBy(F.desc(key), tie)
    banded = rows.withColumn("band", F.col(key).between(low, high))
    placed = banded.where("band").withColumn("selected", F.row_number().over(order) <= k - above)
    settled = banded.where(~F.col("band")).withColumn("selected", F.col(key) > high)
    return settled.unionByName(placed).drop("band")


def resample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    share: float | None = None,
    target_docs: int = TARGET_DOCS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, log_weight, n_grams, gumbel_key, selected`` of every row.

    ``labels`` holds the id and a label that is 1 for target documents; a document is target if all its labels are 1.
    ``share`` of the rows is drawn: if None, the share of target documents among the labelled ones, all rows if there
    is none. NULL and empty texts weigh 0. A row without id gets the noise of an empty id. Repeated rows have equal
    keys; which of them is drawn at the threshold is left to the order of the table. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    judged = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("label"))
    judged = judged.where("doc_id is not null and label is not null").groupBy("doc_id").agg((F.min("label") == 1).alias("good"))
    good = judged.where("good").orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_docs).select("doc_id")
    ratios = log_ratios(rows, good, buckets)
    found = judged.agg(F.avg(F.col("good").cast("int")).alias("share")).first()["share"]
    share = share if share is not None else (1.0 if found is None else found)

    uniform = (F.shiftrightunsigned(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(seed)), 11) + F.lit(0.5)) / F.lit(2.0**53)
    weighed = rows.select("doc_id", weigher(ratios)(F.col("text")).alias("w")).select("doc_id", "w.*")
    keyed = stage(weighed.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform))), "importance")
    return top_k(keyed, round(share * keyed.count()), "gumbel_key", "doc_id")
