"""Column expressions over file paths and file names."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dump names start with a two-letter kind, then year and month.
DUMP_NAME = r"(?i)^(RC|RS)_([0-9]{4})-([0-9]{2})"
DUMP_KINDS = {"RC": "comments", "RS": "submissions"}

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_dir(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def extension(path: Column) -> Column:
    """Lower-case extension with its dot; empty for none and for dot-files such as ``.profile``."""
    return F.lower(F.regexp_extract(base_name(path), r"[^.].*?(\.[^.]*)$", 1))


def path_part(path: Column) -> Column:
    """The path without scheme and authority."""
    return F.regexp_replace(path, _SCHEME, "")


def local_path_part(path: str) -> str:
    """Driver-side counterpart of :func:`path_part`; relative local paths become absolute."""
    if re.match(_SCHEME, path):
        path = re.sub(_SCHEME, "", path)
    else:
        path = os.path.abspath(path)
    return path.rstrip("/") or "/"


def plain_path(path: Column) -> Column:
    """Local files lose their ``file:`` scheme, so a path reads as a user would type it."""
    return F.regexp_replace(path, "^file:(//)?(?=/)", "")


def scanned_path() -> Column:
    """Path of the file a row was scanned from, with URI escapes undone."""
    uri = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return plain_path(F.url_decode(uri))


def relative_path(path: Column, root: str) -> Column:
    """The path below ``root``; for a single file, its name."""
    base = local_path_part(root)
    part = path_part(path)
    below = F.substr(part, F.lit(len(base.rstrip("/")) + 2))
    return F.when(part == F.lit(base), base_name(part)).otherwise(below)


def dump_kind(name: Column) -> Column:
    code = F.upper(F.regexp_extract(name, DUMP_NAME, 1))
    kind = F.lit(None).cast("string")
    for prefix, label in DUMP_KINDS.items():
        kind = F.when(code == prefix, label).otherwise(kind)
    return kind


def dump_month(name: Column) -> Column:
    year, month = F.regexp_extract(name, DUMP_NAME, 2), F.regexp_extract(name, DUMP_NAME, 3)
    return F.when(year != "", F.concat_ws("-", year, month))


def escape_glob(path: str) -> str:
    """Spark expands globs in the paths it is given; a listed file must be taken literally."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def glob_pattern(glob: str) -> str:
    """A regular expression for a relative-path glob, where ``**/`` stands for any folders."""
    parts = re.split(r"(\*\*/|\*+|\?|\[[^\]]+\])", glob)
    meaning = {"**/": "(?:[^/]+/)*", "?": "[^/]"}
    out = []
    for part in parts:
        if part.startswith("["):
            out.append("[^" + part[2:] if part.startswith("[!") else part)
        elif part.strip("*") == "" and part:
            out.append("[^/]*")
        else:
            out.append(meaning.get(part, re.escape(part)))
    return "^" + "".join(out) + "$"
