"""Exact top-k by inner product with a KD-tree per shard.

A shard's rows are turned to their principal axes and split at the median of the widest one, down to small leaves; every
node keeps the tight box of its rows along those axes, and their centre and radius. The best-first walk of a query opens
the node of the highest bound and stops when no bound reaches the query's k-th score, which starts from what the pilot
shard found. A node's bound is the lower of what its box and its ball allow; scores come from the rows themselves.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import vectors as V

LEAF_ROWS = 64
# Bounds are computed along turned axes: what rounding may take from them, relative to the largest score possible.
SLACK = 1e-9


class KDTree:
    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int, leaf_rows: int = LEAF_ROWS):
        self.k, order, self.scored = k, np.arange(len(ids)), 0
        middle = rows.mean(axis=0)
        self.axes = np.linalg.eigh((rows - middle).T @ (rows - middle))[1] if rows.shape[1] else np.zeros((0, 0))
        turned = rows @ self.axes
        self.low, self.high, self.centre, self.radius, self.span, self.children = [], [], [], [], [], []
        work = [(0, len(ids), -1)]
        while work:
            start, end, parent = work.pop()
            node, part = len(self.span), order[start:end]
            box = turned[part]
            low, high, centre = box.min(axis=0), box.max(axis=0), box.mean(axis=0)
            self.low.append(low)
            self.high.append(high)
            self.centre.append(centre)
            self.radius.append(np.sqrt(((box - centre) ** 2).sum(axis=1).max()))
            self.span.append((start, end))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            # rows that are all alike cannot be told apart by a split
            if end - start > leaf_rows and (high > low).any():
                half = (end - start) // 2
                order[start:end] = part[np.argpartition(box[:, np.argmax(high - low)], half)]
                work += [(start, start + half, node), (start + half, end, node)]
        self.ids, self.rows = ids[order], rows[order]
        self.low, self.high, self.centre = np.array(self.low), np.array(self.high), np.array(self.centre)
        self.radius, self.largest = np.array(self.radius), np.sqrt((rows * rows).sum(axis=1).max(initial=0))

    def search(self, ids: np.ndarray, queries: np.ndarray, floors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        queries = V.widened(queries, self.rows.shape[1])[:, : self.rows.shape[1]]
        turned, length = queries @ self.axes, np.sqrt((queries * queries).sum(axis=1))
        # a box: each coordinate at its better end; a ball: from its centre along the query
        box = np.maximum(turned, 0) @ self.high.T + np.minimum(turned, 0) @ self.low.T
        ball = turned @ self.centre.T + length[:, None] * self.radius
        bounds = np.minimum(box, ball) + SLACK * (1 + length * self.largest)[:, None]
        for own, query, bound, floor in zip(ids, queries, bounds, floors):
            found, scores = self._walk(own, query, bound, floor)
            yield found, scores, scores

    def _walk(self, own: int, query: np.ndarray, bound: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
        best_ids, best_scores = np.empty(0, np.int64), np.empty(0)
        heap = [(-bound[0], 0)]
        while heap and -heap[0][0] >= floor:  # a bound that ties may hide a smaller id
            _, node = heapq.heappop(heap)
            if self.children[node]:
                for child in self.children[node]:
                    if bound[child] >= floor:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            start, end = self.span[node]
            scores = self.rows[start:end] @ query
            self.scored += end - start
            near = (scores >= floor) & (self.ids[start:end] != own)
            if near.any():
                best_ids, best_scores = V.best(
                    np.concatenate((best_ids, self.ids[start:end][near])),
                    np.concatenate((best_scores, scores[near])),
                    self.k,
                )
                if len(best_ids) == self.k:
                    floor = max(floor, best_scores[-1])
        return best_ids, best_scores


def shard_tree(k: int):
    def build(rows: pa.Table) -> KDTree:
        return KDTree(rows.column("vec_id").to_numpy(), V.matrix(rows.column("v").combine_chunks()), k)

    return build


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """Components as floor(scale * x), whole numbers in double precision."""
    return vectors.withColumn("v", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x).cast("double")))


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = V.SHARD_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: per query the k highest integer inner products, ties to smaller ids.

    Vectors that are NULL or hold NULL or non-finite components take no part, nor do rows without id. Vectors of
    different lengths are compared over their common components; an empty vector scores 0. Scores are exact while their
    magnitude stays below 2^53. An id is one row of the table: rows that repeat an id are each other's own row. With
    no candidates there are no rows. Very long vectors widen a shard's matrix. Other columns are not read.
    """
    rows = quantised(V.named(vectors, id_col, vector_col), scale)
    asked = quantised(V.named(queries, id_col, vector_col), scale)
    hits = V.search_shards(rows, asked, k, shard_tree(k), shard_rows)
    return V.ranked(hits.select("query_id", "vec_id", F.col("low").cast("long").alias("score")), k)
