"""Language identification by word-first backoff.

A word the model knows is scored by its log frequency in each language. A word it does not know is scored by its character
n-grams: the longest order of which it knows any, else the next shorter. A text's language is the one with the highest
sum over its words and the language's own log frequency.

The tables are counted by Spark over a bounded sample of labelled documents of every language. Of each language and order
they keep the entries that make up all but a stated share of its occurrences, so a rare language loses no more than a
frequent one; their size is bounded by that of the sample. They travel to the tasks, each of which remembers the scores
of the words it met.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import stage
from corpusmill.llm.token_counts import PIECE_CHARS, cut_at_spaces

UNDETERMINED = "und"
#: Documents to learn from, about, and of each language at least (all of them, if it has fewer), drawn by a hash of the id.
TRAIN_DOCS, LANGUAGE_DOCS = 20_000, 500
#: Share of a language's occurrences that rare entries of an order may take with them when they are left out.
LOSS = 0.05
ORDERS = (4, 3, 2, 1)
MEMO_WORDS = 300_000
_WORD = re.compile(r"[^\W\d_]+")
_COUNTS_SCHEMA = "grams int, gram string, lang string, n long"


def remainder(doc_id: Column, parts: int = 4) -> Column:
    """CRC-32 of the id as text, modulo ``parts``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts))


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case; none if the text has no letter."""
    found = _WORD.findall(text.lower())
    return found if any(c.isalpha() for word in found for c in word) else []


def grams_of(word: str, order: int) -> list[str]:
    """Character n-grams of the word between its ends; single characters without the ends."""
    padded = f" {word} " if order > 1 else word
    return [padded[n : n + order] for n in range(len(padded) - order + 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter = Counter()

    def drained() -> Iterator[pa.RecordBatch]:
        # order 0 stands for whole words, -1 for documents
        counts: Counter = Counter()
        for (lang, word), n in words.items():
            if word is None:
                counts[-1, "", lang] += n
                continue
            counts[0, word, lang] += n
            for order in ORDERS:
                for gram in grams_of(word, order):
                    counts[order, gram, lang] += n
        words.clear()
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([k[2] for k in keys], pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["grams", "gram", "lang", "n"],
        )

    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            words[lang, None] += 1
            for piece in cut_at_spaces(text, PIECE_CHARS):
                words.update((lang, word) for word in words_of(piece))
        if len(words) > MEMO_WORDS:
            yield from drained()
    yield from drained()


@dataclass
class Table:
    """Log frequencies by language: a row of ``scores`` per gram."""

    rows: dict[str, int]
    scores: np.ndarray

    def get(self, gram: str) -> np.ndarray | None:
        row = self.rows.get(gram)
        return None if row is None else self.scores[row]


@dataclass
class Model:
    """``tables`` by order of n-gram, order 0 holding whole words."""

    languages: list[str]
    prior: np.ndarray
    tables: dict[int, Table]

    def word_scores(self, word: str) -> np.ndarray:
        known = self.tables[0].get(word)
        if known is not None:
            return known
        for order in ORDERS:
            rows = [row for row in map(self.tables[order].get, grams_of(word, order)) if row is not None]
            if rows:
                return np.mean(rows, axis=0)
        return np.zeros(len(self.languages))


def drawn_documents(rows: DataFrame, max_docs: int, language_docs: int) -> DataFrame:
    """A share of ``doc_id, text, lang`` by a hash of the id: of each language the common share, or more if that is few."""
    sizes = rows.groupBy("lang").count()
    total = max(1, rows.count())
    share = F.greatest(F.lit(max_docs / total), F.lit(language_docs) / F.col("count"))
    limits = sizes.select(F.col("lang").alias("_lang"), F.least(F.lit(1 << 20), F.ceil(share * (1 << 20))).alias("_limit"))
    drawn = rows.join(F.broadcast(limits), F.col("lang") == F.col("_lang"))  # a row per language
    return drawn.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.col("_limit")).select("text", "lang")


def rare_limits(counts: DataFrame, loss: float) -> DataFrame:
    """``grams, lang, least``: the count from which entries are kept, those below being ``loss`` of the occurrences at most."""
    sizes = counts.groupBy("grams", "lang", "n").agg(F.sum("n").alias("occurrences"))
    key = Window.partitionBy("grams", "lang")
    upto = F.sum("occurrences").over(key.orderBy("n"))
    lost = sizes.withColumn("lost", upto <= F.lit(loss) * F.sum("occurrences").over(key))
    return lost.groupBy("grams", "lang").agg(F.coalesce(F.max(F.when(F.col("lost"), F.col("n"))), F.lit(0)).alias("least"))


def train(
    docs: DataFrame,
    lang_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_docs: int = TRAIN_DOCS,
    language_docs: int = LANGUAGE_DOCS,
    loss: float = LOSS,
) -> Model:
    """Learn from the rows that have a language and a text.

    Of more than ``max_docs`` a hash of the id draws a share, of each language ``language_docs`` at least if it has them.
    """
    rows = docs.select(
        F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    drawn = drawn_documents(rows, max_docs, language_docs)
    counted = drawn.mapInArrow(_count, _COUNTS_SCHEMA).groupBy("grams", "gram", "lang")
    counts = stage(counted.agg(F.sum("n").alias("n")), "language-counts")
    totals = {(r["grams"], r["lang"]): (r["n"], r["kinds"]) for r in counts.groupBy("grams", "lang").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()}
    limits = F.broadcast(rare_limits(counts, loss))  # a row per order and language
    kept = counts.where("grams >= 0").join(limits, ["grams", "lang"]).where("n > least").select("grams", "gram", "lang", "n")

    languages = sorted({lang for order, lang in totals if order == -1})
    place = {lang: n for n, lang in enumerate(languages)}
    seen = np.array([totals[-1, lang][0] for lang in languages], float)
    # columns, not rows: a model's entries are many small values
    entries = stage(kept, "language-entries").toArrow()
    tables = {}
    for order in (0, *ORDERS):
        found = entries.filter(pc.equal(entries["grams"], order))
        rows_of: dict[str, int] = {}
        at = np.fromiter((rows_of.setdefault(gram.as_py(), len(rows_of)) for gram in found["gram"]), np.int64)
        langs = np.fromiter((place[lang.as_py()] for lang in found["lang"]), np.int64)
        counted = np.zeros((len(rows_of), len(languages)))
        counted[at, langs] = found["n"].to_numpy()
        size = np.array([totals.get((order, lang), (0, 0))[0] for lang in languages], float)
        kinds = max([totals.get((order, lang), (0, 0))[1] for lang in languages], default=0)
        tables[order] = Table(rows_of, np.log((counted + 0.5) / (size + 0.5 * kinds + 1)))
    return Model(languages, np.log(seen / seen.sum()) if languages else seen, tables)


def predictor(model: Model):
    """A function of a text column giving ``lang`` and ``score``, the language's share of the posterior."""

    def score(text: str | None, words: dict, table: np.ndarray) -> tuple[str, float, np.ndarray]:
        total, letters = model.prior.copy(), False
        for piece in cut_at_spaces(text or "", PIECE_CHARS):
            found = words_of(piece)
            letters = letters or bool(found)
            for word in set(found).difference(words):
                if len(words) == len(table):
                    table = np.concatenate((table, np.zeros_like(table)))
                words[word] = len(words)
                table[words[word]] = model.word_scores(word)
            if found:
                total += table[list(map(words.__getitem__, found))].sum(axis=0)
            if len(words) > MEMO_WORDS:
                words.clear()
        if not letters or not model.languages:
            return UNDETERMINED, 0.0, table
        best = int(np.argmax(total))
        return model.languages[best], float(1 / np.exp(total - total[best]).sum()), table

    @F.arrow_udf("lang string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, table = {}, np.zeros((1024, len(model.languages)))
        for texts in batches:
            langs, scores = [], []
            for text in texts.to_pylist():
                lang, share, table = score(text, words, table)
                langs.append(lang)
                scores.append(share)
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"]
            )

    return predict


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``doc, found``: every row as a struct, and the predicted ``lang`` and its ``score`` from 0 to 1.

    ``und`` with score 0 where the text is NULL or has no letter, or no language was learned. Ties go to the language
    that sorts first. Very long texts are read piece by piece, repeated rows come back each. The columns of ``docs`` travel
    in the struct, whatever their names; only the text is looked at.
    """
    return docs.select(F.struct("*").alias("doc"), predictor(model)(F.col(text_col)).alias("found"))
