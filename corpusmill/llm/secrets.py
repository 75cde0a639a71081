"""Secret scan: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Everything is DataFrame expressions. Matches are found by writing marks around them and splitting the text there; their
places are running sums over the pieces, taken for texts with matches only. The two models are first-order chains over
characters, counted from labelled strings; a long token outside the patterns is a secret if the log-likelihood ratio of
random against ordinary is high enough.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import stage

# The base patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
MIN_LENGTH = {"assign": 6, "access": 20, "hex": 24}

# Strings the models judge, their least length, and the least log-likelihood ratio of a secret.
TOKEN = "[A-Za-z0-9+/_=-]+"
MIN_TOKEN = 16
MIN_RATIO = 8.0
# Weight of a character's own frequency in the chance of a step to it.
BACKOFF = 5.0
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"

# Marks are private-use characters; a text that holds them gets others in their place, which no pattern matches either.
_OPEN, _VALUE, _CLOSE = "", "", ""
_STAND_INS = ""


def _pieces(text: Column, kind: int, pattern: str, group: int, quick: str) -> Column:
    """Structs of a text's pieces: the text before the first match, then each match with what follows it."""
    marked = F.regexp_replace(text, pattern, f"{_OPEN}$0{_VALUE}${group}{_CLOSE}")

    def piece(part: Column, n: Column) -> Column:
        match = F.when(n == 0, "").otherwise(F.substring_index(part, _VALUE, 1))
        value = F.when(n == 0, "").otherwise(F.substring_index(F.substring_index(part, _CLOSE, 1), _VALUE, -1))
        rest = F.when(n == 0, part).otherwise(F.substring_index(part, _CLOSE, -1))
        return F.struct(
            F.lit(kind).alias("kind"), n.alias("n"), F.char_length(match).alias("length"),
            (F.char_length(match) + F.char_length(rest)).alias("step"), value.alias("value"),
        )

    return F.when(text.rlike(quick), F.transform(F.split(marked, _OPEN), piece))


def _spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, kind, start, end, value`` of all matches and long tokens of ``doc_id, text_hash, text``."""
    clean = F.when(
        F.col("text").rlike(f"[{_OPEN}{_VALUE}{_CLOSE}]"),
        F.translate("text", _OPEN + _VALUE + _CLOSE, _STAND_INS),
    ).otherwise(F.col("text"))
    # a run of hex digits or token characters is one match whatever its length, so short runs need no marks
    found = F.flatten(
        F.array_compact(
            F.array(
                _pieces(clean, 0, ASSIGN, 2, ASSIGN),
                _pieces(clean, 1, ACCESS, 0, "AKIA"),
                _pieces(clean, 2, HEX.replace("+", f"{{{MIN_LENGTH['hex']},}}"), 0, f"[0-9a-f]{{{MIN_LENGTH['hex']}}}"),
                _pieces(clean, 3, TOKEN[:-1] + f"{{{MIN_TOKEN},}}", 0, TOKEN[:-1] + f"{{{MIN_TOKEN}}}"),
            )
        )
    )
    pieces = docs.select("doc_id", "text_hash", F.explode(found).alias("p")).select("doc_id", "text_hash", "p.*")
    # rows that repeat a document give the same pieces
    place = ["doc_id", "text_hash", "kind", "n"]
    pieces = pieces.groupBy(*place).agg(*(F.first(c).alias(c) for c in ("length", "step", "value")))
    before = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    started = pieces.withColumn("start", F.coalesce(F.sum("step").over(before), F.lit(0)).cast("long"))
    least = F.when(F.col("kind") == 0, F.char_length("value") >= MIN_LENGTH["assign"]).otherwise(
        F.col("length") >= F.element_at(F.array(F.lit(0), F.lit(MIN_LENGTH["access"]), F.lit(0), F.lit(0)), F.col("kind") + 1)
    )
    return started.where((F.col("n") > 0) & least).select(
        "doc_id", "text_hash", "kind", "start", (F.col("start") + F.col("length")).alias("end"), "value"
    )


def _letters(token: Column) -> Column:
    """The token's characters as places in the alphabet, 0 for any other."""
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def _steps(letters: Column) -> Column:
    size, width = F.size(letters), len(ALPHABET) + 1
    ahead = F.slice(letters, 2, F.greatest(size - 1, F.lit(0)))
    behind = F.slice(letters, 1, F.greatest(size - 1, F.lit(0)))
    return F.zip_with(behind, ahead, lambda a, b: a * width + b)


def train(samples: DataFrame) -> list[float]:
    """Log ratios of the two chains, one for each pair of characters, from ``token, is_random``.

    Each distinct string counts once. Only the counts of pairs, a number bounded by the alphabet, reach the driver.
    """
    steps = samples.where("token is not null").distinct().select("is_random", F.explode(_steps(_letters(F.col("token")))).alias("step"))
    width = len(ALPHABET) + 1
    counts = {True: [0] * width**2, False: [0] * width**2}
    for row in steps.groupBy("is_random", "step").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["is_random"]][row["step"]] += row["n"]
    chains = [_smoothed(counts[kind], width) for kind in (True, False)]
    return [round(math.log(random / plain), 6) for random, plain in zip(*chains)]


def _smoothed(counts: list[int], width: int) -> list[float]:
    """Chances of each step; where a character was seldom followed by anything, those of the next character alone."""
    total = sum(counts) + 0.5 * width
    alone = [(sum(counts[c::width]) + 0.5) / total for c in range(width)]
    chances = []
    for first in range(0, width**2, width):
        row = counts[first : first + width]
        chances += [(n + BACKOFF * p) / (sum(row) + BACKOFF) for n, p in zip(row, alone)]
    return chances


def log_ratio(token: Column, ratios: list[float]) -> Column:
    """Log-likelihood ratio of a string under the chain of random strings against that of identifiers."""
    # one literal text instead of thousands of literals keeps the plan small
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    return F.aggregate(_steps(_letters(token)), F.lit(0.0), lambda total, step: total + F.element_at(table, step + 1))


def labelled_samples(spans: DataFrame) -> DataFrame:
    """``token, is_random`` drawn from the corpus: the patterns' values, and long tokens of letters or of digits alone."""
    random = spans.where("kind < 3").select(F.col("value").alias("token"), F.lit(True).alias("is_random"))
    plain = spans.where((F.col("kind") == 3) & F.col("value").rlike("^([A-Za-z_/-]+|[0-9]+)$"))
    return random.unionByName(plain.select(F.col("value").alias("token"), F.lit(False).alias("is_random")))


def find_secrets(
    docs: DataFrame,
    samples: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_ratio: float = MIN_RATIO,
) -> DataFrame:
    """``doc_id, text_hash, spans``: per row its spans as structs ``kind, start, end, value, ratio``, in order.

    Kinds 0 to 2 are the base patterns, leftmost and not overlapping within a kind; kind 3 are the models' finds, long
    tokens that overlap no base span. Places count code points, the end exclusive. ``samples`` (``token, is_random``)
    trains the models; by default they learn from the corpus. A NULL or empty text has no spans. Repeated rows come back
    each, a NULL id stays NULL. Other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    spans = stage(_spans(rows), "secret-spans")
    ratios = train(samples if samples is not None else labelled_samples(spans))

    of_doc = Window.partitionBy("doc_id", "text_hash").orderBy("start", "kind")
    base_end = F.max(F.when(F.col("kind") < 3, F.col("end"))).over(of_doc.rowsBetween(Window.unboundedPreceding, 0))
    base_start = F.min(F.when(F.col("kind") < 3, F.col("start"))).over(of_doc.rowsBetween(0, Window.unboundedFollowing))
    free = (F.coalesce(base_end, F.lit(0)) <= F.col("start")) & (F.coalesce(base_start, F.col("end")) >= F.col("end"))
    judged = spans.withColumn("free", free).withColumn("ratio", F.when(F.col("kind") == 3, log_ratio(F.col("value"), ratios)))
    kept = judged.where("kind < 3 or (free and ratio >= %r)" % min_ratio)
    listed = kept.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "value", "ratio"))).alias("spans")
    )
    ids = rows.select("doc_id", "text_hash").alias("r")
    return ids.join(
        listed.alias("s"),
        F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("r.text_hash") == F.col("s.text_hash")),
        "left",
    ).select("r.doc_id", "r.text_hash", F.coalesce("s.spans", F.array().cast(listed.schema["spans"].dataType)).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )
