"""HTML character references undone with column expressions.

Named references come from the standard library's HTML 5 table; the fixed values below are HTML's replacements for
numeric references to control characters, and the code points it ignores.
"""

from __future__ import annotations

from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points 0x80 to 0x9F stand for these Windows-1252 characters, the others stay themselves.
C1_REPLACEMENTS = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†", 0x87: "‡", 0x88: "ˆ", 0x89: "‰", 0x8A: "Š",
    0x8B: "‹", 0x8C: "Œ", 0x8E: "Ž", 0x91: "‘", 0x92: "’", 0x93: "“", 0x94: "”", 0x95: "•", 0x96: "–", 0x97: "—",
    0x98: "˜", 0x99: "™", 0x9A: "š", 0x9B: "›", 0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}
# References looked up before the whole table, as nearly all of a text's are among them.
FREQUENT = ("amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;")
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


# What the tables' text is cut at; neither stands in a name or a character.
_ENTRY, _PAIR = "\x01", "\x02"


@lru_cache(maxsize=None)
def _table(open_only: bool) -> str:
    """Names and characters as one text; ``open_only``: the names that count without a semicolon."""
    return _ENTRY.join(name + _PAIR + text for name, text in html5.items() if not (open_only and name.endswith(";")))


@lru_cache(maxsize=None)
def _open_lengths() -> tuple[int, ...]:
    """Lengths of the names that count without a semicolon, longest first."""
    return tuple(sorted({len(name) for name in html5 if not name.endswith(";")}, reverse=True))


def _named(open_only: bool = False) -> Column:
    """The table as a map: one literal, which the optimizer folds, however many names it has."""
    return F.str_to_map(F.lit(_table(open_only)), F.lit(_ENTRY), F.lit(_PAIR))


def _character(code: Column) -> Column:
    """The character of a code point; NULL beyond Unicode."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _numeric(reference: Column) -> Column:
    digits = F.regexp_extract(reference, "^#[xX]?([0-9a-fA-F]+)", 1)
    base = F.when(reference.rlike("^#[xX]"), 16).otherwise(10)
    # more digits than any code point has mean one beyond Unicode
    plain = F.regexp_replace(digits, "^0+(?=.)", "")
    code = F.when(F.length(plain) > 10, F.lit(0x110000)).otherwise(
        F.when(base == 16, F.conv(plain, 16, 10)).otherwise(plain).cast("bigint")
    )
    replaced = F.element_at(
        F.create_map(*(F.lit(x) for pair in C1_REPLACEMENTS.items() for x in pair)), F.least(code, F.lit(0x100)).cast("int")
    )
    unseen = (
        code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | code.between(0x7F, 0x9F)
        | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("�"))
        .when(code == 0xD, F.lit("\r"))
        .when(code.between(0x80, 0x9F) & replaced.isNotNull(), replaced)
        .when(code.isin(0x81, 0x8D, 0x8F, 0x90, 0x9D), _character(code))
        .when(unseen, F.lit(""))
        .otherwise(_character(code))
    )


def _resolved(pair: Column) -> Column:
    """A piece of text that followed an ampersand, with the reference it starts with resolved."""
    part, reference = pair["part"], pair["reference"]
    whole = F.concat(F.element_at(_named(), reference), F.substr(part, F.length(reference) + 1))
    # the longest beginning that is a name of its own, as in &notit;
    starts = [
        F.when(
            F.length(reference) > n,
            F.concat(F.element_at(_named(open_only=True), F.left(reference, F.lit(n))), F.substr(part, F.lit(n + 1))),
        )
        for n in _open_lengths()
    ]
    resolved = F.when(reference == "", F.concat(F.lit("&"), part))
    for name in FREQUENT:
        resolved = resolved.when(reference == name, F.concat(F.lit(html5[name]), F.substr(part, F.lit(len(name) + 1))))
    return (
        resolved.when(reference.startswith("#"), F.concat(_numeric(reference), F.substr(part, F.length(reference) + 1)))
        .otherwise(F.coalesce(whole, *starts, F.concat(F.lit("&"), part)))
    )


def html_unescape(text: Column) -> Column:
    """Undo HTML character references, named and numeric, as browsers read them. All in the JVM."""
    parts = F.split(text, "&")
    after = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    # the reference is named by a step of its own, as it is looked at many times
    pairs = F.transform(after, lambda p: F.struct(p.alias("part"), F.regexp_extract(p, REFERENCE, 1).alias("reference")))
    rest = F.transform(pairs, _resolved)
    joined = F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))
    return F.when(text.contains("&"), joined).otherwise(text)
