import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import components, line_dedup, simhash
from corpusmill.llm.components import components as connected


def plain_line_dedup(rows, min_chars=10):
    owner = {}
    last = float("inf")  # rows without id come last
    for doc_id, text in rows:
        for key in line_dedup.line_keys((text or "").encode(), min_chars):
            if key is not None:
                owner[key] = min(owner.get(key, last), last if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keys = line_dedup.line_keys((text or "").encode(), min_chars)
        keep = [ln for ln, k in zip(lines, keys) if k is None or owner[k] == (last if doc_id is None else doc_id)]
        out.append((doc_id, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


def dedup(df, **options):
    rows = line_dedup.dedup_lines(df, **options).select("doc.doc_id", "kept.*").collect()
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in rows), key=str)


def test_messy_lines(messy_docs):
    rows = [(r["doc_id"], r["text"]) for r in messy_docs.collect()]
    assert dedup(messy_docs) == plain_line_dedup(rows)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (7, 3)])
def test_lines_over_any_number_of_batches(make_docs, batches, fanout):
    rng = random.Random(5)
    pool = [f"line number {n} {'é' * (n % 9)}" for n in range(60)] + ["short", "", "  ", "Exactly10!", "ééééééééé", "éééééééééé"]
    rows = [(n, "\n".join(rng.choice([str.upper, str, lambda s: f" {s}\t"])(rng.choice(pool)) for _ in range(rng.randint(0, 12)))) for n in range(150)]
    rng.shuffle(rows)
    docs = make_docs([(n, t, "en", "a") for n, t in rows])
    assert dedup(docs, batches=batches, fanout=fanout) == plain_line_dedup(rows)


def test_line_runs_hold_each_line_once(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for first in range(0, 50, 10):
        runs.add(spark.range(first, first + 10).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("h1"), F.lit(0).cast("long").alias("h2")))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    runs.close()
    assert sorted((r["h1"], r["owner"]) for r in runs.owners().collect()) == [(n, n) for n in range(7)]


def test_no_lines(make_docs):
    assert dedup(make_docs([])) == []


def plain_groups(rows):
    """Smallest reachable id by comparing all pairs of distinct fingerprints."""
    prints = {}
    for doc_id, fp in rows:
        prints.setdefault(fp, []).append(doc_id)
    keys = list(prints)
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    a = np.array(keys, np.int64).view(np.uint64)
    for n, key in enumerate(keys):
        for m in np.flatnonzero(np.bitwise_count(a[n + 1 :] ^ a[n]) <= simhash.MAX_BITS):
            x, y = root(key), root(keys[n + 1 + m])
            parent[x] = y
    best = {}
    for fp, ids in prints.items():
        found = [i for i in ids if i is not None]
        if found:
            best[root(fp)] = min(best.get(root(fp), min(found)), min(found))
    return {fp: best.get(root(fp)) for fp in prints}


def check_near_duplicates(df):
    rows = [(r["doc_id"], simhash.fingerprint((r["text"] or "").encode())) for r in df.collect()]
    groups = plain_groups(rows)
    want = sorted(((i, f"{fp & (2**64 - 1):016x}", groups[fp]) for i, fp in rows), key=str)
    got = simhash.near_duplicates(df).collect()
    assert sorted(map(tuple, got), key=str) == want


def test_fingerprint_is_the_majority_of_shingle_hashes():
    import xxhash

    def plain(text):
        words = text.translate({c: c + 32 for c in range(65, 91)}).encode().split()
        if not words:
            return 0
        shingles = [b" ".join(words[n : n + 3]) for n in range(max(1, len(words) - 2))]
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    for text in ["", " \n", "One", "one TWO", "a b c", "a b c d", "É é x y z z z z", "to be or not to be " * 9]:
        assert simhash.fingerprint(text.encode()) & (2**64 - 1) == plain(text)


def test_messy_near_duplicates(messy_docs):
    check_near_duplicates(messy_docs)


def test_planted_copies(spark):
    check_near_duplicates(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_no_documents(make_docs):
    assert simhash.near_duplicates(make_docs([])).collect() == []
    assert simhash.one_of_each(make_docs([])).collect() == []


def test_links_of_crowded_keys(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(60):  # many prints that share a half, and walks away from a base
            flips = rng.sample(range(32), rng.randint(0, 3)) if rng.random() < 0.7 else rng.sample(range(64), rng.randint(0, 4))
            prints.add(base ^ sum(1 << f for f in flips))
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    a = np.array(signed, np.int64)
    want = {
        (min(x, y), max(x, y))
        for n, x in enumerate(signed)
        for y in a[n + 1 :][np.bitwise_count(a[n + 1 :].view(np.uint64) ^ np.uint64(x & (2**64 - 1))) <= 2].tolist()
    }
    assert len(found) == len(want) and {(r["a"], r["b"]) for r in found} == want and len(want) > 500


def test_components_of_chains_stars_and_rings(spark):
    chain = [(n, n + 1) for n in range(100, 160)]
    star = [(500, n) for n in range(501, 560)]
    ring = [(n, (n - 1000 + 1) % 17 + 1000) for n in range(1000, 1017)]
    loose = [(7, 3), (3, 7), (9, 9)]
    df = spark.createDataFrame(chain + star + ring + loose, "a long, b long")
    found = {r["node"]: r["component"] for r in connected(df).collect()}
    want = {n: 100 for n in range(100, 161)} | {n: 500 for n in range(500, 560)} | {n: 1000 for n in range(1000, 1017)} | {3: 3, 7: 3}
    assert found == want
    assert components.components(df.limit(0)).collect() == []


def test_one_of_each_group_stays(make_docs):
    text = "the same words come again and again in this little text about nothing at all"
    docs = make_docs([(4, text, "en", "a"), (2, text, "en", "b"), (2, text, "en", "b"), (3, text.upper(), "en", "a"),
                      (8, "something else entirely, with other words in it", "en", "a"), (None, text, "en", "a"), (None, "without id, but twice the same text", "en", "a"),
                      (None, "without id, but twice the same text", "en", "a"), (9, "one id and", "en", "a"), (9, "two texts of it", "en", "a")])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    found = sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in kept.collect())
    assert found == [
        (False, 2, text), (False, 8, "something else entirely, with other words in it"), (False, 9, "one id and"),
        (False, 9, "two texts of it"), (True, None, "without id, but twice the same text"),
    ]


def test_fewer_bits_link_less(spark):
    prints = spark.createDataFrame([(0,), (1,), (3,), (-1,)], "fp long")
    assert sorted(map(tuple, simhash.links(prints, 1).collect())) == [(0, 1), (1, 3)]
    assert simhash.links(prints, 0).collect() == []
    with pytest.raises(ValueError):
        simhash.links(prints, 3)
