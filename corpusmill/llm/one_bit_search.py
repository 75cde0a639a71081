"""Approximate nearest neighbours by inner product with randomly rotated one-bit codes.

A vector is taken relative to the corpus mean, scaled to length one, padded with zeros to a multiple of its length,
rotated at random, and kept as the signs of its coordinates in packed bits, with two scalars: its distance from the mean,
and the inner product of the rotated vector with its own code, which corrects the estimate. A query is rotated alike and
rounded to whole numbers of a few bits, so its inner product with a code is a sum of population counts: the code's words
AND each bit plane of the query. The estimate's error is bounded, with high probability for the code, and surely for the
rounding. All shards first tell each query's k best lower bounds. Only vectors whose upper bound reaches the k-th of all of
them are then fetched and reranked: codes travel without vectors. There is no cap on how many those are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import vectors as V
from corpusmill.llm.common import stage

# Width of the error bounds in standard deviations. A true neighbour is lost only if it is estimated too low, and the k-th
# best too high, by about so much together.
EPSILON = 1.0
#: Bits of a code per component of a vector.
BITS_PER_COMPONENT = 8
#: Bits a query's coordinate is rounded to.
QUERY_BITS = 8
SEED = 7

CODES_SCHEMA = "vec_id long, code binary, distance double, own double"


def code_width(components: int, bits: int = BITS_PER_COMPONENT) -> int:
    """Bits of a code: whole words."""
    return max(64, -(-components * bits // 64) * 64)


def rotation(components: int, width: int | None = None, seed: int = SEED) -> np.ndarray:
    """Orthonormal rows at random: turns vectors of some components, as if padded with zeros, into ``width`` of them."""
    width = width or components
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((width, components)))[0].T


def encode(rows: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distances from the mean, and inner products of the rotated unit vectors with their codes."""
    offset = V.widened(rows, len(mean)) - mean
    distance = np.sqrt((offset * offset).sum(axis=1))
    turned = (offset / np.where(distance > 0, distance, 1)[:, None]) @ turn
    own = np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[1])
    return np.packbits(turned > 0, axis=1), distance, np.where(distance > 0, own, 1.0)


def build_index(vectors: DataFrame, bits: int = BITS_PER_COMPONENT, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """The code table of ``(vec_id, v)`` and the corpus mean; every row is indexed."""
    width = vectors.select(F.max(F.size("v"))).first()[0] or 1
    # the mean: one number per component, whatever the number of rows
    sums = vectors.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("s")).collect()
    total = max(1, vectors.count())
    mean = np.zeros(width)
    for row in sums:
        mean[row["at"]] = row["s"] / total
    # fewer digits than the sum's order of addition can disturb: reruns agree
    mean = np.round(mean, 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(width, code_width(width, bits), seed)
        for batch in batches:
            codes, distance, own = encode(V.matrix(batch.column("v"), width), mean, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(distance), pa.array(own)],
                names=["vec_id", "code", "distance", "own"],
            )

    return vectors.mapInArrow(run, CODES_SCHEMA), mean


class RoundedQuery:
    """A rotated query as whole numbers of a few bits, cut into bit planes packed like codes."""

    def __init__(self, turned: np.ndarray, bits: int = QUERY_BITS):
        self.low = turned.min()
        self.step = (turned.max() - self.low) / ((1 << bits) - 1) or 1.0
        whole = np.rint((turned - self.low) / self.step).astype(np.int64)
        planes = (whole[None, :] >> np.arange(bits)[:, None]) & 1
        self.planes = np.packbits(planes.astype(np.uint8), axis=1).view("<u8")
        self.total, self.width = int(whole.sum()), len(turned)
        # what rounding can add to or take from a sum of signed coordinates
        self.rounding = float(np.abs(turned - (self.low + self.step * whole)).sum())

    def signed_sums(self, codes: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """Per code the sum of the query's coordinates, those of bit 0 negated: counted in words, nothing is unpacked."""
        counted, words = np.zeros(len(codes), np.uint32), codes.T
        for n, plane in enumerate(self.planes):
            counted += np.bitwise_count(words & plane[:, None]).sum(axis=0, dtype=np.uint32) << np.uint32(n)
        counted = counted.astype(np.int64)
        return self.low * (2 * ones - self.width) + self.step * (2 * counted - self.total)


class OneBitShard:
    def __init__(self, ids, codes: np.ndarray, distance: np.ndarray, own: np.ndarray, mean: np.ndarray, turn: np.ndarray, k: int, epsilon: float):
        self.ids, self.mean, self.turn, self.k = ids, mean, turn, k
        # word by word in memory: counts of one word lie side by side
        self.codes = np.ascontiguousarray(codes.T).T
        self.ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        width, own = turn.shape[1], np.clip(own, 1e-9, 1)
        self.gain = distance / (own * np.sqrt(width))
        self.doubt = epsilon * distance * np.sqrt(1 - own * own) / (own * np.sqrt(max(1, width - 1)))

    def search(self, ids: np.ndarray, queries: np.ndarray, floors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        # coordinates beyond the index's width meet zeros only
        queries = V.widened(queries, len(self.mean))[:, : len(self.mean)]
        for own, query, floor in zip(ids, queries, floors):
            turned = query @ self.turn
            rounded = RoundedQuery(turned)
            middle = query @ self.mean + self.gain * rounded.signed_sums(self.codes, self.ones)
            reach = np.linalg.norm(turned) * self.doubt + self.gain * rounded.rounding
            others = self.ids != own
            low, high = middle - reach, middle + reach
            known = low[others]
            if len(known) >= self.k:
                floor = max(floor, np.partition(known, len(known) - self.k)[len(known) - self.k])
            near = np.flatnonzero((high >= floor) & others)
            yield self.ids[near], low[near], high[near]


def code_shard(mean: np.ndarray, bits: int, k: int, epsilon: float, seed: int):
    def build(rows: pa.Table) -> OneBitShard:
        code = rows.column("code").combine_chunks()
        codes = np.frombuffer(b"".join(code.to_pylist()), "<u8").reshape(rows.num_rows, -1)
        turn = rotation(len(mean), code_width(len(mean), bits), seed)
        distance, own = (rows.column(name).to_numpy() for name in ("distance", "own"))
        return OneBitShard(rows.column("vec_id").to_numpy(), codes, distance, own, mean, turn, k, epsilon)

    return build


def inner_product(a: str, b: str):
    """In double precision, added component by component: the same for equal rows wherever they lie."""
    products = F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0)))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def candidates(
    codes: DataFrame, mean: np.ndarray, queries: DataFrame, k: int, bits: int, epsilon: float, seed: int, shard_rows: int
) -> DataFrame:
    """``query_id, vec_id``: the rows whose upper bound reaches the k-th best lower bound over all shards."""
    build = code_shard(mean, bits, k, epsilon, seed)
    return V.search_shards(codes, queries, k, build, shard_rows, pilot_everywhere=True).select("query_id", "vec_id")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    epsilon: float = EPSILON,
    seed: int = SEED,
    shard_rows: int = V.SHARD_ROWS,
    bits: int = BITS_PER_COMPONENT,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: per query the k nearest found by inner product, ties to smaller ids.

    Scores are those of the original vectors in double precision. Vectors that are NULL, zero or hold NULL or
    non-finite components take no part, nor do rows without id. Vectors of different lengths are compared over their
    common components; the longest sets the width of all codes. Rows that repeat an id are each other's own row and no
    candidates. Other columns are not read.
    """
    def taking_part(df: DataFrame) -> DataFrame:
        return V.named(df, id_col, vector_col).where(F.exists("v", lambda x: x != 0))

    rows, asked = taking_part(vectors), taking_part(queries)
    codes, mean = build_index(rows, bits, seed)
    found = candidates(stage(codes, "one-bit-codes"), mean, asked, k, bits, epsilon, seed, shard_rows).distinct()
    # vectors are fetched for the candidates alone
    left = asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("_query"))
    scored = found.join(rows, "vec_id").join(left, "query_id").select("query_id", "vec_id", inner_product("v", "_query").alias("score"))
    return V.ranked(scored, k)
