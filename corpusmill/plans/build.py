"""From compressed dumps to one topic's Parquet table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import paths as P
from corpusmill.functions.scalars import iso_now
from corpusmill.operators.records import (
    BAD,
    BROKEN,
    MATCH,
    OTHER,
    TOO_LARGE,
    TOPIC_FIELD,
    classify_lines,
    count_totals,
    inferred_fields,
    ingest_counts,
    read_errors,
    record_schema,
    typed_records,
)
from corpusmill.operators.shapes import MAX_KEYS
from corpusmill.operators.types import align_to_schema
from corpusmill.session import delete_path, prepare, scratch_dir
from corpusmill.sinks.write import parquet_codec, spread_for_write, write_parquet, write_report
from corpusmill.sources.files import DUMP_ENDINGS, list_dumps, refuse_hidden
from corpusmill.sources.lines import read_lines
from corpusmill.sources.parquet import parquet_schema

FOLDERS = ("_kind", "_month")
# Statuses of staged lines: a folder each, so that a pass over the matches reads nothing else.
STATUSES = (BAD, OTHER, MATCH, BROKEN, TOO_LARGE)


def refuse_below(path: str, folder: str) -> None:
    inner, outer = P.local_path_part(path), P.local_path_part(folder)
    if inner == outer or inner.startswith(outer.rstrip("/") + "/"):
        raise ValueError(f"{path} lies inside {folder}: a second run would read its own output")


class NoRecords(LookupError):
    """No line matched the topic; nothing was written."""


@dataclass(frozen=True)
class BuildResult:
    out: str
    report: str
    files_scanned: int
    lines_total: int
    bad_json: int
    matched: int
    rows_written: int
    files_broken: int


def build_topic(
    spark: SparkSession,
    input_path: str,
    out: str,
    topic: str,
    field: str = TOPIC_FIELD,
    recursive: bool = True,
    ignore: Iterable[str] = (),
    compression: str = "zstd",
    schema_from: str | None = None,
    report: str | None = None,
    staged: str | None = None,
    keep_staged: bool = False,
    rows_per_group: int = 0,
    map_fields: Iterable[str] = (),
    json_fields: Iterable[str] = (),
    max_keys: int = MAX_KEYS,
) -> BuildResult:
    """Keep the records of one topic from all dumps below a folder.

    The dumps are read and parsed once. That pass stages the matches, and for other lines no more than the file they
    are from, in a folder per status; counters, schema and result are then computed from the staged table. With
    ``schema_from`` no schema is inferred; without it, objects with more than ``max_keys`` keys must be named in
    ``map_fields`` or ``json_fields``. The report is written also when the run fails; it and the result must not
    lie below the input, where the next run would read them.
    """
    prepare(spark)
    parquet_codec(compression)
    ignore = sorted(set(ignore))
    report = report or f"{out.rstrip('/')}.report"
    for path in (out, report):
        refuse_below(path, input_path)
    refuse_hidden(spark, input_path, DUMP_ENDINGS, recursive)
    target = parquet_schema(spark, schema_from) if schema_from else None
    files = list_dumps(spark, input_path, recursive, ignore).select("path", "length").persist()
    staging = staged or scratch_dir(spark, "staged-records")
    settings = {
        "input": input_path,
        "out": out,
        "topic": topic,
        "recursive": str(recursive).lower(),
        "ignore": ",".join(ignore),
        "compression": compression,
        "schema_from": schema_from,
    }
    counts = None
    try:
        settings["files"] = str(files.count())
        if files.isEmpty():
            raise FileNotFoundError(f"no dumps below {input_path} (recursive={recursive})")
        stage_lines(classify_lines(read_lines(files), topic, field), staging)
        lines = spark.read.schema(STAGED_SCHEMA).parquet(staging)

        # one row per file from here on
        counts = (
            files.select("path")
            .join(ingest_counts(lines), "path", "left")
            .fillna(0)
            .join(read_errors(lines), "path", "left")
            .persist()
        )
        totals = {r.path: r for r in count_totals(counts).filter("path IS NULL").collect()}[None]
        n_files, n_broken = counts.agg(F.count(F.lit(1)), F.count("error")).first()

        rows, dropped = 0, []
        if totals.matched:
            records = lines.filter(F.col("status") == MATCH).select("path", "record")
            if target is None:
                schema, dropped = inferred_fields(records, "record", map_fields, json_fields, max_keys)
                result = typed_records(records, schema)
            else:
                result = align_to_schema(typed_records(records, target), target)
            folders = FOLDERS if target is None else ()
            rows = write_parquet(
                spread_for_write(result, *folders), out, compression, folders, rows_per_group=rows_per_group
            )

        status = "ok" if totals.matched else "no_matches"
        finish = {
            "status": status,
            "files_scanned": n_files,
            "files_broken": n_broken,
            "lines_total": totals.lines_total,
            "bad_json": totals.bad_json,
            "too_large": totals.too_large,
            "matched": totals.matched,
            "rows_written": rows,
        }
        write_report(ingest_report(counts, _events(spark, "start", settings, finish, dropped)), report)
        if not totals.matched:
            raise NoRecords(f"no records with {field} = {topic!r}; nothing written")
        return BuildResult(
            out, report, n_files, totals.lines_total, totals.bad_json, totals.matched, rows, n_broken
        )
    except NoRecords:
        raise
    except Exception as error:
        begun = "no_input" if settings.get("files") == "0" else "start"
        failed = _events(spark, begun, settings, error=f"{type(error).__name__}: {error}")
        write_report(failed if counts is None else ingest_report(counts, failed), report)
        raise
    finally:
        files.unpersist()
        if counts is not None:
            counts.unpersist()
        if not keep_staged:
            delete_path(spark, staging)


STAGED_SCHEMA = "path string, record variant, error string, status string"


def stage_lines(classified: DataFrame, folder: str) -> None:
    """Write classified lines, a folder per status. The few folders are all open at once, so nothing is sorted."""
    conf, name = classified.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, str(len(STATUSES)))
    try:
        classified.select("path", "record", "error", "status").write.mode("overwrite").partitionBy("status").parquet(folder)
    finally:
        conf.set(name, before)


def _events(
    spark: SparkSession,
    status: str,
    settings: dict,
    finish: dict | None = None,
    dropped: list[str] | None = None,
    error: str | None = None,
) -> DataFrame:
    """The run's own log entries: its settings, and its totals or the error that ended it."""
    rows = [("config", status, settings, None, None, None)]
    if finish:
        numbers = {k: int(v) for k, v in finish.items() if k != "status"}
        rows.append(("finish", finish["status"], None, numbers, dropped, None))
    if error:
        rows.append(("finish", "aborted", None, None, None, error))
    return spark.createDataFrame(
        rows,
        "event string, status string, settings map<string,string>, totals map<string,bigint>,"
        " dropped_fields array<string>, error string",
    ).select(iso_now().alias("ts"), "*")


def ingest_report(counts: DataFrame, events: DataFrame) -> DataFrame:
    """One log row per file between the run's start and its end."""
    files = counts.select(
        iso_now().alias("ts"),
        F.lit("file").alias("event"),
        F.when(F.col("error").isNotNull(), "error")
        .when(F.col("matched") == 0, "no_matches")
        .otherwise("ok")
        .alias("status"),
        F.col("path").alias("file"),
        "lines_total",
        "bad_json",
        "too_large",
        "matched",
        # every match is written
        F.col("matched").alias("rows_written"),
        "error",
    )
    return events.unionByName(files, allowMissingColumns=True)


def topic_table(
    df: DataFrame,
    schema: T.StructType | None = None,
    map_fields: Iterable[str] = (),
    json_fields: Iterable[str] = (),
    max_keys: int = MAX_KEYS,
) -> DataFrame:
    """The typed, normalised records of ``classify_lines`` output, as a DataFrame.

    With a schema nothing runs until the result is asked for. Without one the matches are staged once, in the shared
    scratch folder, and both the schema and the result come from there: no line is parsed twice.
    """
    records = df.filter(F.col("status") == MATCH).select("path", "record")
    if schema is not None:
        return align_to_schema(typed_records(records, schema), schema)
    folder = scratch_dir(df.sparkSession, "topic-records")
    records.write.parquet(folder)
    records = df.sparkSession.read.schema(records.schema).parquet(folder)
    return typed_records(records, record_schema(records, "record", map_fields, json_fields, max_keys))
