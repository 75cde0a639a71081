"""Listing input files as a DataFrame.

The listing is Spark's own (parallel, any file system). Names starting with ``_`` or ``.`` are hidden from Spark's
readers; jobs that would miss data for that reason refuse to run and name the files (:func:`refuse_hidden`).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions import paths as P
from corpusmill.session import scratch_dir
from corpusmill.sources.decode import filesystem_of

# Fixed value: the file endings that count as record dumps.
DUMP_ENDINGS = (".zst", ".zstd", ".xz", ".bz2", ".gz", ".json", ".jsonl")
DUMP_GLOB = "*.{zst,zstd,xz,bz2,gz,json,jsonl}"
PARQUET_GLOB = "*.{parquet,parq}"
# Entries of a folder that a task hands on at a time.
ENTRY_BATCH = 10_000


def list_files(
    spark: SparkSession,
    root: str,
    glob: str | None = None,
    recursive: bool = True,
    ignore: Iterable[str] = (),
) -> DataFrame:
    """One row per file: ``path, name, ext, length, modified``. File contents are never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listed = reader.load(P.escape_glob(root)).select("path", "length", F.col("modificationTime").alias("modified"))
    if not recursive:
        here = P.path_part(F.col("path"))
        base = P.local_path_part(root)
        listed = listed.filter((P.parent_dir(here) == base.rstrip("/")) | (here == base))
    path = P.plain_path(F.col("path"))
    files = listed.select(
        path.alias("path"),
        P.base_name(path).alias("name"),
        P.extension(path).alias("ext"),
        "length",
        "modified",
    )
    return without(files, ignore)


def without(files: DataFrame, ignore: Iterable[str]) -> DataFrame:
    """A listing without the files whose exact name is on the ignore list."""
    ignored = sorted(set(ignore))
    return files.filter(~F.col("name").isin(ignored)) if ignored else files


class HiddenFiles(ValueError):
    """Files that look like input but that Spark's readers cannot see."""


ENTRY_SCHEMA = "path string, is_folder boolean, hidden boolean"


def is_hidden(name: str) -> bool:
    """Whether Spark's readers pass over a file or folder for its name; ``_kind=x`` is a partition folder."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of folders; what lies in a hidden folder is hidden."""
    for batch in batches:
        for folder, hidden in zip(batch.column("path").to_pylist(), batch.column("hidden").to_pylist()):
            fs, name = filesystem_of(folder)
            if fs.get_file_info(name).type != pafs.FileType.Directory:
                continue
            found = fs.get_file_info(pafs.FileSelector(name, allow_not_found=True))
            for at in range(0, len(found), ENTRY_BATCH):
                some = found[at : at + ENTRY_BATCH]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{folder.rstrip('/')}/{f.base_name}" for f in some], pa.string()),
                        pa.array([f.type == pafs.FileType.Directory for f in some], pa.bool_()),
                        pa.array([hidden or is_hidden(f.base_name) for f in some], pa.bool_()),
                    ],
                    names=["path", "is_folder", "hidden"],
                )


def walk(spark: SparkSession, root: str, recursive: bool = True) -> Iterator[DataFrame]:
    """Entries of a folder tree, hidden ones too, a level at a time: ``path, is_folder, hidden``.

    The folders of a level are a DataFrame that tasks list; entries never meet on the driver. A level is listed once,
    and stays cached while its follower is read. A root that is a file, or is not there, has no entries.
    """
    tasks = max(1, 4 * spark.sparkContext.defaultParallelism)
    folders, kept = spark.createDataFrame([(root, False)], "path string, hidden boolean"), []
    try:
        while True:
            entries = folders.mapInArrow(_listed, ENTRY_SCHEMA).persist()
            kept.append(entries)
            yield entries
            below = entries.where("is_folder").select("path", "hidden")
            if not recursive or below.isEmpty():
                return
            for done in kept[:-1]:
                done.unpersist()
            kept = kept[-1:]
            # one folder may hold most folders of the next level
            folders = below.repartition(tasks)
    finally:
        for done in kept:
            done.unpersist()


def hidden_files(spark: SparkSession, root: str, endings: Iterable[str], recursive: bool = True, most: int = 10) -> tuple[int, list[str]]:
    """How many files below ``root`` end like input and are hidden from Spark's readers, and the first few of them.

    They are hidden by their own name or that of a folder above.
    """
    endings, count, first = tuple(endings), 0, []
    for entries in walk(spark, root, recursive):
        named = reduce(Column.__or__, [F.lower("path").endswith(ending) for ending in endings])
        found = entries.where(F.col("hidden") & ~F.col("is_folder") & named).select("path")
        more = found.count()
        if more:
            count, first = count + more, first + [r["path"] for r in found.orderBy("path").limit(most).collect()]
    return count, sorted(first)[:most]


def refuse_hidden(spark: SparkSession, root: str, endings: Iterable[str], recursive: bool = True) -> None:
    count, first = hidden_files(spark, root, endings, recursive)
    if count:
        raise HiddenFiles(f"{count} files below {root} have names that Spark takes as hidden; rename them: {', '.join(first)}")


def list_dumps(spark: SparkSession, root: str, recursive: bool = False, ignore: Iterable[str] = ()) -> DataFrame:
    """Record dumps below ``root`` with the kind and month their names carry."""
    files = list_files(spark, root, DUMP_GLOB, recursive, ignore)
    return files.withColumns({"kind": P.dump_kind(F.col("name")), "month": P.dump_month(F.col("name"))})


def ordered(files: DataFrame, *ties: str) -> DataFrame:
    """A listing in the order in which jobs take files: by name, then path, then ``ties``."""
    return files.orderBy(P.base_name(F.col("path")), "path", *ties)


def numbered(files: DataFrame, place: str = "place") -> DataFrame:
    """A listing with each file's place (from 1) in the order in which jobs take files.

    Tasks sort and number a range of names each; the ranges' sizes, a row per task, give the place where each starts.
    The sorted listing is staged, so that sizes and places come from one sort. Repeated paths may lie in several ranges.
    """
    spark, folder = files.sparkSession, scratch_dir(files.sparkSession, "ordered-files")
    tied = files.withColumn("__tie", F.monotonically_increasing_id())
    placed = ordered(tied, "__tie").drop("__tie").withColumn("__at", F.monotonically_increasing_id())
    placed.write.parquet(folder)
    staged = spark.read.schema(placed.schema).parquet(folder).withColumn("__part", F.shiftright("__at", 33))
    sizes = staged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")
    starts = sizes.select("__part", before.alias("__start"))
    within = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return staged.join(F.broadcast(starts), "__part").select(
        *files.columns, (F.col("__start") + within + 1).cast("int").alias(place)
    )


def list_dataset(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """All visible files of a stored dataset (or the one file given)."""
    return list_files(spark, root, glob, recursive=True)
