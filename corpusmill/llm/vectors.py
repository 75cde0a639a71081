"""Sharded search of vectors: rows are dealt over shards by a hash of their id, queries travel to the shards.

A task holds one shard's rows, builds its index, and answers the queries that stream by in batches, so memory is bounded
by a shard and a batch, whatever the number of queries. Where there are fewer shards than cores, a shard is held by
several tasks that share its queries. Every query is first asked in one shard that its id names, so this pilot is spread
over all tasks; the k-th score it reaches there is a bound that is passed on to all shards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import stage

SHARD_ROWS = 8_192
QUERY_BATCH = 256
_HITS = "query_id long, vec_id long, low double, high double"


class Searcher(Protocol):
    def search(self, ids: np.ndarray, queries: np.ndarray, floors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each query the ids of rows here that may reach its floor, with bounds of their scores from both sides.

        An exact search gives each query's k best and equal bounds.
        """


def usable(vector: Column) -> Column:
    """True for vectors that are not NULL and hold only finite numbers."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )


def named(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v`` of the rows that take part: with an id and a usable vector."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """The vectors as rows; shorter ones end in zeros, so scores count the common components."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = max([int(lengths.max(initial=0)), width or 0])
    if len(flat) == len(column) * width:
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    for row, (start, n) in enumerate(zip(np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)):
        out[row, :n] = flat[start : start + n]
    return out


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return rows if rows.shape[1] >= width else np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def _answers(build: Callable[[pa.Table], Searcher], k: int, floors_only: bool):
    """Rows of one place in (those of its shard, then queries); hits out, or each query's k best lower bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index = [], None
        for batch in batches:
            queries = int(batch.column("is_query").true_count)
            rows = batch.num_rows - queries
            if rows:
                held.append(batch.slice(0, rows))
            if not queries:
                continue
            if index is None and held:
                index, held = build(pa.Table.from_batches(held).combine_chunks()), []
            if index is None:
                continue
            for at in range(rows, batch.num_rows, QUERY_BATCH):
                few = batch.slice(at, QUERY_BATCH)
                ids, floors = few.column("vec_id").to_numpy(), few.column("floor").to_numpy()
                found = list(index.search(ids, matrix(few.column("v")), floors))
                if floors_only:
                    lows = [np.partition(low, len(low) - k)[len(low) - k :] if len(low) > k else low for _, low, _ in found]
                    names = np.repeat(ids, [len(low) for low in lows])
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.concatenate(lows).astype(float))], names=["query_id", "low"])
                    continue
                columns = [np.concatenate([hit[n] for hit in found]) for n in range(3)]
                sizes = [len(hit[0]) for hit in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, sizes)), *(pa.array(c.astype(t)) for c, t in zip(columns, ("i8", "f8", "f8")))],
                    names=["query_id", "vec_id", "low", "high"],
                )

    return run


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to the smaller id."""
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search_shards(
    rows: DataFrame,
    queries: DataFrame,
    k: int,
    build: Callable[[pa.Table], Searcher],
    shard_rows: int = SHARD_ROWS,
    pilot_everywhere: bool = False,
) -> DataFrame:
    """``query_id, vec_id, low, high``: what the shards find for each query, at least its k best rows over all of them.

    ``rows`` hold ``vec_id`` and what the index is built from, ``queries`` hold ``vec_id, v``. A query's own row is no
    candidate. With ``pilot_everywhere`` all shards tell their k best lower bounds first, so that the k-th of all is the
    floor everywhere: for searches whose bounds are cheap and whose hits are not.
    """
    shards = max(1, -(-rows.count() // shard_rows))
    # a shard is held by as many tasks as it takes to use all cores
    slices = max(1, rows.sparkSession.sparkContext.defaultParallelism // shards)
    shard, part = F.pmod(F.xxhash64("vec_id"), F.lit(shards)), F.pmod(F.hash("vec_id"), F.lit(slices))
    dealt = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("part"), shard.alias("shard"), F.lit(False).alias("is_query"))
    own = F.pmod(F.xxhash64(F.lit("pilot"), "vec_id"), F.lit(shards))

    def asked(where: DataFrame, floors_only: bool, kind: str) -> DataFrame:
        both = dealt.unionByName(where.withColumn("is_query", F.lit(True)), allowMissingColumns=True)
        placed = both.withColumn("place", (F.col("shard") * slices + F.col("part")).cast("int"))
        laid = placed.repartitionById(shards * slices, "place").sortWithinPartitions("is_query", "vec_id")
        return laid.mapInArrow(_answers(build, k, floors_only), kind)

    here = queries.select("vec_id", "v", part.alias("part"), F.lit(float("-inf")).alias("floor"))
    if shards == 1:
        return asked(here.withColumn("shard", F.lit(0)), False, _HITS)
    def everywhere(df: DataFrame) -> DataFrame:
        return df.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    first = everywhere(here) if pilot_everywhere else here.withColumn("shard", own)
    lows = asked(first, True, "query_id long, low double")
    order = Window.partitionBy("query_id").orderBy(F.desc("low"))
    kth = lows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).where(F.col("n") == k)
    floors = stage(kth.select("query_id", F.col("low").alias("floor")), "pilot-floors")
    bound = here.drop("floor").join(floors, F.col("vec_id") == F.col("query_id"), "left")
    bound = bound.select("vec_id", "v", "part", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    return asked(everywhere(bound), False, _HITS)


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest scores of each query, ties to smaller ids."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
