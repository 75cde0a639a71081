"""Spelling variants against all pairs of words compared letter by letter."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from corpusmill.llm import spelling_variants as S


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(docs, typo_every=None, min_count=2):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if typo_every and h % typo_every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= min_count}
    rows, forms = {}, {}
    for word, n in words.items():
        near = [w for w in words if one_edit(word, w)]
        best = min(near, key=lambda w: (-words[w], w), default=None)
        if best and words[best] >= 5 * n:
            forms[word] = best
        rows[word] = (n, len(near))
    def root(w):
        return root(forms[w]) if w in forms else w
    return {w: (forms.get(w), root(w), n, near, words.get(forms.get(w))) for w, (n, near) in rows.items()}


def random_words(n, seed, letters="abé"):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(5, 7))) for _ in range(n)]


@pytest.fixture
def docs():
    rnd = random.Random(5)
    words = random_words(500, 3)
    # chains of forms: each edit five times rarer than the last
    chain = ["quietly"] * 130 + ["quietlx"] * 26 + ["quiitlx"] * 5 + ["quiitxx"]
    texts = [" ".join(rnd.choices(words, k=400)) for _ in range(8)] + [" ".join(chain)]
    rows = [(n, text) for n, text in enumerate(texts)]
    return rows + [(100, None), (101, ""), (None, texts[0]), (None, texts[0]), (7, "123 !? --"), (8, words[0] * 20_000)]


@pytest.mark.parametrize("typo_every,block_words", [(None, 16), (7, 512)])
def test_against_all_pairs(spark, docs, typo_every, block_words):
    table = spark.createDataFrame([(i, t, "w", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    found = S.spelling_variants(table, min_count=2, typo_every=typo_every, block_words=block_words)
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found.collect()}
    want = plain(docs, typo_every)
    assert got == want
    assert any(near > 3 for *_, near, _ in want.values())
    if typo_every is None:
        assert got["quiitlx"][:2] == ("quietlx", "quietly")


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.spelling_variants(empty).collect() == []
    assert S.spelling_variants(spark.createDataFrame([(1, "a b c")], "doc_id long, text string")).collect() == []


def test_products_find_the_pairs_of_two_blocks():
    words = sorted(set(random_words(400, 9, "abcé")))
    for size in (5, 6):
        for longer in (0, 1):
            a, b = [w for w in words if len(w) == size], [w for w in words if len(w) == size + longer]
            left, right = S.near_pairs(S.Block(a, np.ones(len(a))), S.Block(b, np.ones(len(b))))
            assert {(a[i], b[j]) for i, j in zip(left, right)} == {(x, y) for x in a for y in b if one_edit(x, y)}


def test_pieces_of_a_text_end_with_a_run(monkeypatch):
    monkeypatch.setattr(S, "TEXT_CHARS", 7)
    pattern = re.compile("[a-z]+")
    text = "alpha beta  gammadeltaepsilon, x yy zzz" + "q" * 50
    assert [w for piece in S.runs(text, pattern) for w in piece] == pattern.findall(text)


def test_partners_name_each_pair_of_blocks_once(spark):
    heads = spark.createDataFrame([(6, m, p) for m in range(8) for p in range(2)] + [(7, 1, 0)], "size int, mark int, part int")
    found = [(tuple(r["a"]), tuple(r["b"])) for r in S.partners(heads, 3).collect()]
    assert len(found) == len(set(found)) and not any((b, a) in found for a, b in found if a != b)
    same = {(a, b) for a, b in found if b[0] == 6}
    blocks = [(6, m, p) for m in range(8) for p in range(2)]
    assert same == {(a, b) for a in blocks for b in blocks if a <= b and (a[1] ^ b[1]).bit_count() <= 2}
    assert {a[1] for a, b in found if b[0] == 7} == {0, 1, 3, 5}
