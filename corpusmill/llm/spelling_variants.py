"""Spelling variants grouped by blocked Gram matrices of letter counts.

One edit changes a word's letter counts by one letter (insertion, deletion) or by one letter less and another more
(replacement), so near words have counts at a squared distance of at most two. Words of one length lie in blocks; the
NumPy product of two blocks' count matrices gives the squared distances of all their pairs, those of two at most are
verified letter by letter. Lengths meet themselves and the next one.

Blocks are also cut by a signature: which of some common letters a word holds. One edit turns at most two of those bits
(an insertion sets at most one), so a block meets the blocks of equal length within two bits and of the next length
within one bit, by equality joins on block names: exact, and far fewer products than all pairs of blocks. A block's words
travel to its partners; a task holds one block and reads its partners one after the other. What a product finds is
counted per word at once, so no pair leaves a task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import stage

# The letters of a run, and what makes a word.
LETTERS = "A-Za-zÀ-ÿ"
MIN_LETTERS, MIN_COUNT, FORM_FACTOR = 6, 5, 5

#: Words of a block, about; more words of one name are dealt over several blocks by hash.
BLOCK_WORDS = 512
#: Letters in a block's signature at most.
MAX_BITS = 14
#: Columns of a count matrix; letters that share one only lower distances. Latin letters of one byte never do.
COLUMNS = 160
#: Characters of a text split at a time, and words a task counts before it hands them on.
TEXT_CHARS = 4 << 20
TASK_WORDS = 300_000

BLOCK = ["size", "mark", "part"]


def runs(text: str, letters: re.Pattern) -> Iterator[list[str]]:
    """The maximal runs of letters, a piece of the text at a time; pieces end where a run ends."""
    start = 0
    while start < len(text):
        end = start + TEXT_CHARS
        if end < len(text) and (over := letters.match(text, end)):
            end = over.end()
        yield letters.findall(text, start, end)
        start = end


def lowered(word: str) -> str:
    return word.lower() if word.isascii() else word.encode().lower().decode()


def _counted(letters: str, typo_every: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, counts = re.compile(f"[{letters}]+"), Counter()

        def drained():
            words, n = pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())
            counts.clear()
            return pa.RecordBatch.from_arrays([words, n], names=["word", "n"])

        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text")
            for row in range(batch.num_rows):
                text = texts[row].as_py() or ""
                if typo_every is None:
                    for piece in runs(text, pattern):
                        counts.update(lowered(word) for word in piece)
                else:
                    own = Counter()
                    for piece in runs(text, pattern):
                        own.update(piece)
                    start = zlib.crc32(f"{ids[row].as_py() or ''}:".encode())
                    for word, n in own.items():
                        word = lowered(word)
                        h = zlib.crc32(word.encode(), start)
                        if h % typo_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                        counts[word] += n
                if len(counts) > TASK_WORDS:
                    yield drained()
        if counts:
            yield drained()

    return run


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    letters: str = LETTERS,
    typo_every: int | None = None,
) -> DataFrame:
    """``word, n`` of the letter runs, A-Z in lower case, that are long and frequent enough.

    With ``typo_every``, a run whose checksum with its document's id is a multiple loses the letter at the checksum's
    place, all in the same way in one document: a test bed of misspellings.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    counts = rows.mapInArrow(_counted(letters, typo_every), "word string, n long")
    counts = counts.where(F.char_length("word") >= min_letters)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def marks(words: DataFrame, block_words: int) -> list[str]:
    """The letters of the signatures: those that halve the words best, as many as the number of words asks for.

    Collected is one row per letter of the alphabet.
    """
    held = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter"))
    found = held.where("letter <> ''").groupBy("letter").count().collect()
    total = words.count()
    # lengths cut about eight ways before any letter does
    bits = min(MAX_BITS, max(0, int(np.ceil(np.log2(max(1, total / (8 * block_words)))))))
    found.sort(key=lambda r: (abs(2 * r["count"] - total), r["letter"]))
    return [r["letter"] for r in found[:bits]]


def blocks(words: DataFrame, letters: list[str], block_words: int) -> DataFrame:
    """``size, mark, part, words, ns``: a block per row, its words by falling count, then code points."""
    mark = F.lit(0)
    for bit, letter in enumerate(letters):
        mark = mark + F.when(F.contains("word", F.lit(letter)), 1 << bit).otherwise(0)
    named = words.select("word", "n", F.char_length("word").cast("int").alias("size"), mark.cast("int").alias("mark"))
    sizes = named.groupBy("size", "mark").agg(F.ceil(F.count(F.lit(1)) / block_words).alias("parts"))
    parted = named.join(sizes, ["size", "mark"]).withColumn("part", F.pmod(F.xxhash64("word"), "parts").cast("int"))
    held = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "word")))
    return parted.groupBy(*BLOCK).agg(held.alias("held")).select(
        *BLOCK, F.col("held.word").alias("words"), F.transform("held.n", lambda n: -n).alias("ns")
    )


def partners(heads: DataFrame, bits: int) -> DataFrame:
    """``a, b``: names of the blocks to compare; ``b`` has the same length and comes no earlier, or the next length."""
    near = [sum(1 << bit for bit in chosen) for k in range(3) for chosen in combinations(range(bits), k)]
    wider = [0] + [1 << bit for bit in range(bits)]
    turns = F.array(
        *[F.struct(F.lit(0).alias("more"), F.lit(m).alias("turn")) for m in near],
        *[F.struct(F.lit(1).alias("more"), F.lit(m).alias("turn")) for m in wider],
    )
    asked = heads.select(F.struct(*BLOCK).alias("a"), F.explode(turns).alias("t")).select(
        "a", (F.col("a.size") + F.col("t.more")).alias("size"), F.col("a.mark").bitwiseXOR(F.col("t.turn")).alias("mark")
    )
    both = asked.join(heads, ["size", "mark"]).select("a", F.struct(*BLOCK).alias("b"))
    return both.where((F.col("a.size") < F.col("b.size")) | (F.col("a") <= F.col("b")))


class Block:
    def __init__(self, words: list[str], ns: np.ndarray):
        self.words, self.ns = words, ns
        size = len(words[0])
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), size)
        self.counts = np.zeros((len(words), COLUMNS), np.float32)
        rows, columns = np.arange(len(words)), self.codes % COLUMNS
        for place in range(size):
            self.counts[rows, columns[:, place]] += 1
        self.squares = (self.counts * self.counts).sum(axis=1)
        self.used = np.flatnonzero(self.counts.any(axis=0))
        self.near, self.best, self.best_n = np.zeros(len(words), np.int64), [None] * len(words), np.zeros(len(words), np.int64)

    def meets(self, rows: np.ndarray, others: np.ndarray, other: Block) -> None:
        """Count near pairs; others are numbered from the most frequent on, so each row's smallest is its best."""
        order = np.lexsort((others, rows))
        rows, others = rows[order], others[order]
        at, first, n = np.unique(rows, return_index=True, return_counts=True)
        self.near[at] += n
        for row, other_row in zip(at.tolist(), others[first].tolist()):
            word, word_n = other.words[other_row], other.ns[other_row]
            if self.best[row] is None or (-word_n, word) < (-self.best_n[row], self.best[row]):
                self.best[row], self.best_n[row] = word, word_n

    def rows(self) -> pa.RecordBatch:
        at = np.flatnonzero(self.near)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.words[i] for i in at], pa.string()), pa.array(self.near[at]),
             pa.array([self.best[i] for i in at], pa.string()), pa.array(self.best_n[at])],
            names=["word", "near", "best", "best_n"],
        )


def near_pairs(a: Block, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs that one edit parts; ``b`` is as long as ``a`` or one letter longer."""
    squared = a.squares[:, None] + b.squares[None, :] - 2 * (a.counts[:, a.used] @ b.counts[:, a.used].T)
    left, right = np.nonzero(squared <= 2.5)
    short, long = a.codes[left], b.codes[right]
    size = short.shape[1]
    if long.shape[1] == size:
        apart = (short != long).sum(axis=1) == 1
    else:
        head = np.cumprod(short == long[:, :-1], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
        tail = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
        apart = head + tail >= size
    return left[apart], right[apart]


def _block(batch: pa.RecordBatch, row: int) -> Block:
    return Block(batch.column("words")[row].as_py(), batch.column("ns")[row].values.to_numpy())


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by block ``a``: first its own words, then those of its partners."""
    own = None
    for batch in batches:
        guests = batch.column("guest").to_pylist()
        for row in range(batch.num_rows):
            block = _block(batch, row)
            if not guests[row]:
                if own is not None:
                    yield own.rows()
                own = block
                left, right = near_pairs(own, own)
                own.meets(left, right, own)
                continue
            left, right = near_pairs(own, block)
            if len(left):
                own.meets(left, right, block)
                block.meets(right, left, own)
                yield block.rows()
    if own is not None:
        yield own.rows()


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, n_near, best, best_n`` of every word of ``word, n`` that has a word one edit away.

    ``best`` is the most frequent of them, ties to the smallest in code-point order. Words are distinct and not empty.
    """
    letters = marks(words, block_words)
    held = stage(blocks(words, letters, block_words), "word-blocks")
    heads = held.select(*BLOCK)
    pairs = partners(heads, len(letters)).where(F.col("a") != F.col("b"))
    content = held.select(F.struct(*BLOCK).alias("b"), "words", "ns")
    guests = pairs.join(content, "b").select("a", F.lit(True).alias("guest"), "words", "ns")
    hosts = content.select(F.col("b").alias("a"), F.lit(False).alias("guest"), "words", "ns")
    laid = hosts.unionByName(guests).repartition("a").sortWithinPartitions("a", "guest")
    found = laid.select("guest", "words", "ns").mapInArrow(_compared, "word string, near long, best string, best_n long")
    order = F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(order).alias("first")).select(
        "word", "n_near", F.col("first.word").alias("best"), (-F.col("first.n")).alias("best_n")
    )


def roots(forms: DataFrame, hops: int) -> DataFrame:
    """``word, root``: the end of each word's chain of forms in ``word, form``, none longer than ``hops``."""
    found = stage(forms.select("word", F.col("form").alias("root")), "word-roots")
    done = 1
    while done < hops:
        onward = found.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        found = found.join(onward, F.col("root") == F.col("_word"), "left").select(
            "word", F.coalesce("_root", "root").alias("root")
        )
        found, done = stage(found, "word-roots"), 2 * done
    return found


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    factor: int = FORM_FACTOR,
    letters: str = LETTERS,
    typo_every: int | None = None,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts.

    A word's form is the most frequent word one edit away (ties: smallest in code-point order) if it is at least
    ``factor`` times as frequent; its root is where following forms ends, the word itself if it has none. NULL and empty
    texts hold no words, a NULL id is written as nothing, repeated rows count each, very long texts are split piece by
    piece. Other columns are not read; without words there are no rows.
    """
    words = stage(word_counts(docs, id_col, text_col, min_letters, min_count, letters, typo_every), "words")
    near = near_words(words, block_words)
    has_form = F.col("best_n") >= factor * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", F.when(has_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("best_n")).alias("form_n"),
    )
    judged = stage(judged, "word-forms")
    # each hop multiplies the count
    most, hops = judged.agg(F.max("n")).first()[0] or 0, 1
    while min_count * max(2, factor) ** hops <= most:
        hops += 1
    ends = roots(judged.where("form IS NOT NULL"), hops)
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
