import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import mixing


def plain_targets(sizes):
    """Shares by weight, the excess over the caps shared anew until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(order)}
    target, total = {}, float(sum(sizes.values()))
    open_ = set(order)
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over
    return target


def check(docs, rows, tolerance=0.02):
    sizes = {}
    for r in docs:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        sizes[r["source"]] = sizes.get(r["source"], 0) + n
    want = plain_targets(sizes)
    by_target = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        by_target.setdefault((r["source_size"], round(r["target"], 3)), []).append(r)
    assert sorted((n, round(want[s], 3)) for s, n in sizes.items()) == sorted(by_target) or len(by_target) < len(sizes)
    for (_, target), own in by_target.items():
        if len([s for s, n in sizes.items() if round(want[s], 3) == target]) == 1:
            assert abs(sum(r["taken"] for r in own) - target) <= max(tolerance * target, min([r["size"] for r in own if r["size"]], default=0))
    return sizes


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mixture(docs).collect()
    assert len(rows) == docs.count()
    check(docs.collect(), rows)
    again = mixing.mixture(docs.repartition(7)).collect()
    key = lambda r: r["doc_id"]
    assert [(r["doc_id"], r["taken"], r["shards"]) for r in sorted(rows, key=key)] == [
        (r["doc_id"], r["taken"], r["shards"]) for r in sorted(again, key=key)
    ]


def test_messy_documents(messy_docs):
    rows = mixing.mixture(messy_docs).collect()
    assert len(rows) == messy_docs.count()
    check(messy_docs.collect(), rows, tolerance=1.0)
    mixed = mixing.mix(messy_docs)
    assert mixed.select("doc.*").columns == messy_docs.columns
    copies = {}
    for r in mixed.collect():
        k = (r["doc"]["doc_id"], r["doc"]["text"])
        copies[k] = copies.get(k, 0) + 1
    plain = {}
    for r in rows:
        plain[r["doc_id"]] = plain.get(r["doc_id"], 0) + len(r["shards"])
    for doc_id in plain:
        assert plain[doc_id] == sum(n for (i, _), n in copies.items() if i == doc_id)


def test_no_documents_and_no_words(make_docs):
    assert mixing.mixture(make_docs([])).collect() == []
    rows = mixing.mixture(make_docs([(1, "", "en", "a"), (2, None, "en", None)])).collect()
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in rows) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


@pytest.mark.parametrize("sizes", [{"a": 1000, "b": 5, "c": 0, None: 70}, {"x": 10, "y": 10, "z": 10}, {"s": 3}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_hypergeometric_draws(spark):
    df = spark.range(2_000).select(((F.col("id") + 0.5) / 2_000).alias("u"))
    for population, marked, draws in ((50, 20, 10), (10, 10, 4), (10, 0, 4), (7, 3, 7), (500, 200, 250)):
        drawn = df.select(mixing.hypergeometric(F.lit(population), F.lit(marked), F.lit(draws), F.col("u")).alias("k"))
        k = np.array([r["k"] for r in drawn.collect()])
        assert k.min() >= max(0, draws + marked - population) and k.max() <= min(marked, draws)
        mean = draws * marked / population
        spread = mean * (1 - marked / population) * (population - draws) / max(1, population - 1)
        assert k.mean() == pytest.approx(mean, abs=0.02) and k.var() == pytest.approx(spread, rel=0.03, abs=1e-9)


def test_splitting_tree_keeps_quotas(spark):
    quotas = {"a": 700, "b": 33, "c": 0, None: 5}
    df = spark.createDataFrame(list(quotas.items()), "source string, quota long")
    leaves = mixing.split_quotas(df, shards=6).collect()
    total = {}
    for r in leaves:
        total[r["shard"]] = total.get(r["shard"], 0) + r["last"] - r["first"]
    assert set(total) == set(range(6)) and max(total.values()) - min(total.values()) <= 3
    for source, quota in quotas.items():
        own = sorted((r["first"], r["last"]) for r in leaves if r["source"] == source)
        assert own[0][0] == 0 and own[-1][1] == quota and all(x[1] == y[0] for x, y in zip(own, own[1:]))


@pytest.mark.parametrize("seed", [1, 5])
def test_a_long_document_leaves_no_gap(spark, seed):
    sizes = [40 + (n * 37) % 160 for n in range(300)]
    sizes.append(sum(sizes) // 2)  # a third of its source
    rows = [(n, "a", size) for n, size in enumerate(sizes)] + [(1000, "b", 3 * sum(sizes))]
    sized = spark.createDataFrame(rows, "row long, source string, size long").withColumn("doc_id", F.col("row"))
    sized = sized.localCheckpoint()
    target = {r["source"]: r["target"] for r in mixing.targets(sized, weights=(1, 5)).collect()}["a"]
    copies = {r["row"]: len(r["shards"]) for r in mixing.draw(sized, seed=seed, weights=(1, 5)).collect()}
    rest = round(target) - sum(size * copies[n] for n, size in enumerate(sizes))
    passes = int(target // sum(sizes))
    left_out = [size for n, size in enumerate(sizes) if copies[n] == passes]
    assert 0 <= rest < min(left_out)


def left_out_rows_fit_nowhere(rows):
    """Per source: what is missing to the target is less than any row that could have been taken once more."""
    sources = {}
    for r in rows:
        sources.setdefault((r["source_size"], r["target"]), []).append(r)
    for (size, target), own in sources.items():
        passes = min(int(target / size), 3) if size else 0
        gap = int(target + 0.5) - sum(r["taken"] for r in own)
        assert gap >= 0
        for r in own:
            if r["size"] and r["taken"] // r["size"] == passes < 3:
                assert r["size"] > gap, (size, target, gap, r)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered_mix_leaves_out_no_row_that_fits(spark, sf):
    from corpusmill.llm import suite

    rows = suite.op8_mixture(spark, f"/root/testdata/{sf}").collect()
    by_source = {}
    docs = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
    for r in rows:
        by_source.setdefault(docs[r["doc_id"]], []).append(r)
    for own in by_source.values():
        left_out_rows_fit_nowhere(own)


def test_a_long_row_leaves_no_gap_that_others_fill(make_docs):
    docs = make_docs([(n, "w " * (5 if n else 1_000), "en", "a") for n in range(200)] + [(900 + n, "w " * 50, "en", "b") for n in range(60)])
    rows = mixing.mixture(docs).collect()
    left_out_rows_fit_nowhere([r for r in rows if r["source_size"] == 1_995])
    left_out_rows_fit_nowhere([r for r in rows if r["source_size"] == 3_000])


def test_rows_without_id_lie_in_many_blocks(spark, make_docs):
    docs = make_docs([(None, f"text number {n}", "en", "a") for n in range(400)] + [(n, "w " * 9, "en", "b") for n in range(400)])
    shards = [tuple(r["shards"]) for r in mixing.mixture(docs).where("doc_id IS NULL").collect()]
    assert len(set(shards)) > 4 and len(shards) == 400


def test_shards_split_the_quotas_exactly(spark):
    rows = mixing.mixture(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), shards=5).collect()
    words = [sum(r["size"] * r["shards"].count(shard) for r in rows) for shard in range(5)]
    assert sum(words) == sum(r["taken"] for r in rows)
    assert max(words) < 2.5 * sum(words) / 5
