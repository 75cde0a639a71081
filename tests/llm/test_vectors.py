import math

import numpy as np
import pytest

from corpusmill.llm import kd_search, one_bit_search

SCHEMA = "vec_id long, embedding array<float>, label int, v string, shard int, floor string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, "y") for i, v in rows], SCHEMA)


def plain(rows, queries, k, score):
    """All pairs; vectors of different lengths meet in their common components."""
    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in good:
        if not queries(q):
            continue
        scored = sorted((-score(qv, v), i) for i, v in good if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def whole(a, b):
    return sum(math.floor(1024 * x) * math.floor(1024 * y) for x, y in zip(a, b))


def real(a, b):
    total = 0.0  # added one by one: sum() compensates for rounding
    for x, y in zip(a, b):
        total += x * y
    return total


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    found = [(n, rng.standard_normal(16).astype(np.float32).tolist()) for n in range(700)]
    same = rng.standard_normal(16).astype(np.float32).tolist()
    found += [(n, same) for n in range(700, 900)]  # many ties
    found += [(900, None), (901, [None] * 16), (902, [float("nan")] + same[1:]), (903, [float("inf")] + same[1:]), (None, same)]
    return found + [(1000, same[:5]), (1005, same + [1.0, 2.0])]


def test_exact_top_k(spark, rows):
    df = table(spark, rows)
    got = kd_search.exact_top_k(df, df.where("vec_id % 5 = 0"), 10, shard_rows=200).collect()
    assert sorted(map(tuple, got)) == plain(rows, lambda i: i % 5 == 0, 10, whole)


def test_few_candidates(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [])]
    df = table(spark, rows)
    assert sorted(map(tuple, kd_search.exact_top_k(df, df, 10).collect())) == plain(rows, lambda i: True, 10, whole)
    near = one_bit_search.nearest(df, df, 10).collect()
    assert sorted(map(tuple, near)) == plain(rows[:2], lambda i: True, 10, real)  # the empty vector is zero


def test_no_vectors(spark):
    df = table(spark, [(1, None), (2, [float("nan")])])
    for empty in (df, df.limit(0)):
        assert kd_search.exact_top_k(empty, empty, 3).collect() == []
        assert one_bit_search.nearest(empty, empty, 3).collect() == []
    one = table(spark, [(1, [1.0])])
    assert kd_search.exact_top_k(one, one, 3).collect() == []
    assert one_bit_search.nearest(one, one, 3).collect() == []


def test_recall_and_scores(spark, rows):
    df = table(spark, rows)
    got = one_bit_search.nearest(df, df.where("vec_id % 4 = 0"), 20, shard_rows=300).collect()
    want = plain(rows, lambda i: i % 4 == 0, 20, real)
    assert len(got) == len(want)
    score = {(q, i): s for q, _, i, s in want}
    hits = [(r["query_id"], r["vec_id"]) for r in got]
    assert sum(h in score for h in hits) >= 0.98 * len(want)
    assert all(r["score"] == score[h] for r, h in zip(got, hits) if h in score)


def test_recall_on_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = one_bit_search.nearest(df, df.where("vec_id % 20 = 0"), 20, shard_rows=150).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = {(q, i) for q, _, i, _ in plain(rows, lambda i: i % 20 == 0, 20, real)}
    assert sum((r["query_id"], r["vec_id"]) in want for r in got) >= 0.95 * len(want)


def test_estimates_stay_within_their_bounds():
    rng = np.random.default_rng(2)
    rows = rng.standard_normal((2000, 64))
    turn = one_bit_search.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    code, distance, own = one_bit_search.encode(rows, np.zeros(64), turn)
    assert code.shape == (2000, 8)
    query = rng.standard_normal(64)
    signs = np.unpackbits(code, axis=1) * 2.0 - 1
    estimate = distance * (signs @ (query @ turn)) / (own * 8)
    bound = 3 * np.linalg.norm(query) * distance * np.sqrt(1 - own**2) / (own * np.sqrt(63))
    assert (np.abs(estimate - rows @ query) <= bound).mean() > 0.99


def test_population_counts_are_sums_of_signed_coordinates():
    rng = np.random.default_rng(6)
    code = rng.integers(0, 256, (50, 64), dtype=np.uint8)
    words, signs = code.view("<u8"), np.unpackbits(code, axis=1) * 2.0 - 1
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    for turned in (rng.standard_normal(512), np.zeros(512), np.full(512, -2.5)):
        rounded = one_bit_search.RoundedQuery(turned)
        assert (np.abs(rounded.signed_sums(words, ones) - signs @ turned) <= rounded.rounding + 1e-9).all()
        assert rounded.rounding <= 512 * rounded.step / 2 + 1e-9


def one_shard(ids, rows, k):
    mean = rows.mean(axis=0)
    turn = one_bit_search.rotation(rows.shape[1], one_bit_search.code_width(rows.shape[1]))
    code, distance, own = one_bit_search.encode(rows, mean, turn)
    return one_bit_search.OneBitShard(ids, np.ascontiguousarray(code).view("<u8"), distance, own, mean, turn, k, one_bit_search.EPSILON)


def test_few_vectors_are_reranked():
    """At most a tenth of the rows of sf0.1, with nine tenths of the neighbours among them at least."""
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    ids, rows = table["vec_id"].to_numpy(), np.array(table["embedding"].to_pylist(), float)
    asked, found, hits = ids % 20 == 0, 0, 0
    for at, (near, low, high) in zip(np.flatnonzero(asked), one_shard(ids, rows, 20).search(ids[asked], rows[asked], np.full(asked.sum(), -np.inf))):
        scores = np.where(ids == ids[at], -np.inf, rows @ rows[at])
        found, hits = found + len(near), hits + len(set(ids[np.argsort(-scores)[:20]]) & set(near))
        assert (low <= high).all() and ids[at] not in near
    assert found <= 0.1 * asked.sum() * len(ids) and hits >= 0.9 * 20 * asked.sum()


def test_trees_score_few_rows_of_clustered_vectors():
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((40, 64)) * 3
    rows = np.floor(1024 * (centres[rng.integers(0, 40, 4000)] + rng.standard_normal((4000, 64)) * 0.3))
    ids = np.arange(4000)
    tree = kd_search.KDTree(ids, rows, 10)
    asked = ids % 100 == 0
    for at, (near, scores, _) in zip(np.flatnonzero(asked), tree.search(ids[asked], rows[asked], np.full(asked.sum(), -np.inf))):
        want = np.where(ids == at, -np.inf, rows @ rows[at])
        order = np.lexsort((ids, -want))[:10]
        assert near.tolist() == order.tolist() and scores.tolist() == want[order].tolist()
    assert tree.scored < 0.1 * asked.sum() * len(ids)
