"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits that differ in at most two bits agree, in one of two halves, up to one bit. Every half is
therefore indexed under its 32 variants with one bit left out: two fingerprints within reach share a variant key. The
members of keys met more than once are cut again, into thirds of the bits that their key leaves open (at most two of
those differ, so one third is equal), and joined on key and third, so a crowded key never pairs all its members. Pairs
are verified in full and come out once. Everything runs on distinct fingerprints: copies come back as members of their class and are never paired.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import shuffle_partitions, stage, utf8
from corpusmill.llm.components import components

MAX_BITS = 2
SHINGLE_WORDS = 3
SEED = 42
# Shingles hashed at a time: bounds the memory of a very long text.
BLOCK = 65_536


def shingle_hashes(text: bytes, shingle_words: int) -> Iterator[np.ndarray]:
    """The hashes of a text's word shingles in order, a block at a time; a shorter text is one shingle."""
    import xxhash

    words = text.lower().split()  # on bytes: A-Z, and blanks \x20 \x09-\x0D
    if not words:
        return
    whole, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    reach = min(shingle_words, len(words)) - 1
    starts, ends = starts[: len(words) - reach].tolist(), ends[reach:].tolist()
    for at in range(0, len(starts), BLOCK):
        hashes = [digest(whole[s:e], SEED) for s, e in zip(starts[at : at + BLOCK], ends[at : at + BLOCK])]
        yield np.array(hashes, "<u8")


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text's word shingles as a signed 64-bit number; 0 without words."""
    counts, shingles = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, shingle_words):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        shingles += len(hashes)
    return int(np.packbits(2 * counts > shingles, bitorder="little").view("<i8")[0])


def _fingerprints(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text, shingle_words) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints, pa.int64()), batch.column("place")], names=["doc_id", "fp", "place"]
            )

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS):
    """``doc_id, fp, place`` of every row; NULL and wordless texts have the fingerprint 0. ``place`` hashes the text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"), _place(text_col).alias("place"))
    return rows.mapInArrow(_fingerprints(shingle_words), "doc_id long, fp long, place long")


def _place(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _half(fp: Column, number: int) -> Column:
    return F.shiftrightunsigned(fp, 32 * number).bitwiseAND(F.lit(0xFFFFFFFF))


def _variants(prints: DataFrame) -> DataFrame:
    """64 rows per fingerprint: ``fp, key``; the key holds the half's number, the bit left out, and the other bits."""
    keys = [
        _half(F.col("fp"), half).bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << bit))).bitwiseOR(F.lit((half * 32 + bit) << 32))
        for half in (0, 1)
        for bit in range(32)
    ]
    return prints.select("fp", F.explode(F.array(*keys)).alias("key"))


def _close(a: Column, b: Column, key: Column, cell: Column, max_bits: int) -> Column:
    """True for a pair within reach, at the first key and the first cell that it shares, so a pair comes out once."""
    apart = a.bitwiseXOR(b)
    low, high = _half(apart, 0), _half(apart, 1)
    # one bit of the low half differs: the number of bits below it is its place
    bit = F.when(low == 0, 0).otherwise(F.bit_count(low - 1))
    first_key = F.when(F.bit_count(low) <= 1, bit).otherwise(F.lit(32))
    # beyond the key, the halves differ in the open bits only
    half = F.when(F.bit_count(low) <= 1, high).otherwise(low)
    thirds = [F.shiftrightunsigned(half, 11 * n).bitwiseAND(F.lit(0x7FF)) for n in range(2)]
    first_cell = F.when(thirds[0] == 0, 0).when(thirds[1] == 0, 1).otherwise(2)
    return (
        (F.bit_count(apart) <= max_bits)
        & (F.shiftrightunsigned(key, 32) == first_key)
        & (F.shiftrightunsigned(cell, 11) == first_cell)
    )


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """All pairs ``(a, b)``, a < b, of the distinct fingerprints ``fp`` that differ in ``max_bits`` bits or fewer."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"halves with one bit left out reach {MAX_BITS} bits, not {max_bits}")
    spark = prints.sparkSession
    spread = stage(prints.select("fp").repartition(shuffle_partitions(spark)), "fingerprints")
    # few keys are met twice: only their members go on
    met = F.count(F.lit(1)).over(Window.partitionBy("key"))
    members = stage(_variants(spread).withColumn("n", met).where("n > 1").drop("n"), "variant-keys")

    # what a key leaves open is the other half and the bit left out: thirds of 11 bits, the bit being the last one
    low_key = F.shiftrightunsigned("key", 37) == 0
    bit = F.shiftrightunsigned("key", 32).bitwiseAND(F.lit(31)).cast("int")
    other = F.when(low_key, _half(F.col("fp"), 1)).otherwise(_half(F.col("fp"), 0))
    own = F.when(low_key, _half(F.col("fp"), 0)).otherwise(_half(F.col("fp"), 1))
    left_out = F.call_function("shiftrightunsigned", own, bit).bitwiseAND(F.lit(1))
    rest = other.bitwiseOR(F.shiftleft(left_out, 32))
    thirds = [
        F.shiftrightunsigned(rest, 11 * n).bitwiseAND(F.lit(0x7FF)).bitwiseOR(F.lit(n << 11)) for n in range(3)
    ]
    cells = stage(members.select("key", "fp", F.explode(F.array(*thirds)).alias("cell")), "variant-cells")
    same_cell = (F.col("l.key") == F.col("r.key")) & (F.col("l.cell") == F.col("r.cell")) & (F.col("l.fp") < F.col("r.fp"))
    close = cells.alias("l").join(
        cells.alias("r"), same_cell & _close(F.col("l.fp"), F.col("r.fp"), F.col("l.key"), F.col("l.cell"), max_bits)
    )
    return close.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def _components(prints: DataFrame, max_bits: int) -> DataFrame:
    """``fp, component, component_id`` of the distinct fingerprints: the class, and its smallest document id."""
    classes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes")
    grouped = components(links(classes, max_bits))
    member = classes.join(grouped, classes.fp == grouped.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    member = stage(member, "fingerprint-components")
    names = stage(member.groupBy("component").agg(F.min("first_id").alias("component_id")), "component-names")
    return stage(member.join(names, "component").select("fp", "component", "component_id"), "named-fingerprints")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row; components are named by their smallest document id.

    Texts whose fingerprints differ in ``max_bits`` bits or fewer are linked, copies included; components are the
    transitive closure. NULL, empty and wordless texts share the fingerprint 0 and link like any other; very long texts
    are hashed block by block. Repeated rows come back each. A row without id takes part, and is named by the smallest
    id it reaches (NULL if there is none). Other columns of ``docs`` are not read.
    """
    prints = stage(fingerprints(docs, id_col, text_col, shingle_words), "document-fingerprints")
    # one fingerprint may be that of a third of all documents: both sides are plain shuffles, so AQE can split it
    return prints.join(_components(prints, max_bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row of the smallest id, then text hash.

    Rows without id come last, so a component of such rows keeps one of them. Of rows that repeat id and text one stays.
    All columns come back as they are.
    """
    prints = stage(fingerprints(docs, id_col, text_col, shingle_words), "document-fingerprints")
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "place")
    first = prints.join(_components(prints, max_bits), "fp").groupBy("component").agg(F.min(own).alias("first"))
    chosen = stage(first.select("first.*"), "one-of-each")
    places = prints.groupBy("doc_id", "place").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id", "place")

    def rows_of(wanted: DataFrame) -> DataFrame:
        here = F.col(f"d.{id_col}").cast("long").eqNullSafe(F.col("c.doc_id")) & (_place(f"d.{text_col}") == F.col("c.place"))
        return docs.alias("d").join(wanted.alias("c").hint("shuffle_hash"), here, "left_semi")

    same = F.col("c.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("c.place") == F.col("p.place"))
    repeated = stage(chosen.alias("c").join(places.alias("p"), same, "left_semi"), "repeated-rows")
    if repeated.isEmpty():
        return rows_of(chosen)
    single = chosen.alias("c").join(repeated.alias("p"), same, "left_anti")
    # only rows that repeat are sorted
    return rows_of(single).unionByName(rows_of(repeated).dropDuplicates([id_col, text_col]))
