"""The registered queries: each runs one or more operators over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import entities, nested, paths, scalars
from corpusmill.operators import corpus, profile, records, shapes, union
from corpusmill.operators.types import align_to_schema
from corpusmill.plans.build import build_topic, topic_table
from corpusmill.plans.merge import merge_folder
from corpusmill.session import prepare, scratch_dir
from corpusmill.sinks.write import PARQUET_CODECS, write_csv, write_parquet
from corpusmill.sources.files import list_dataset, list_dumps, list_files, numbered, without
from corpusmill.sources.lines import lines_of, read_lines
from corpusmill.sources.parquet import parquet_footers, parquet_schema, read_parquet
from corpusmill.suite.fixtures import ENCODINGS, write_arrow, write_dumps

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- lines and records -------------------------------------------------------------------------


def _document_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        F.to_json(F.struct(F.upper("source").alias("subreddit"), "doc_id", "lang", "text", "n_chars")).alias("line"),
    )


@query
def jsonl_topic_filter(spark, sf_dir):
    docs = _document_json(spark, sf_dir)
    lines = lines_of(docs, F.lit("RC_2025-01.jsonl"), F.col("line"))
    schema = T.StructType.fromDDL("doc_id bigint, subreddit string, lang string, text string, n_chars bigint, _kind string, _month string")
    return topic_table(records.classify_lines(lines, "sRc3"), schema)


@query
def topic_by_language(spark, sf_dir):
    found = jsonl_topic_filter(spark, sf_dir)
    return found.groupBy("lang").agg(F.count(F.lit(1)).alias("records"), F.sum("n_chars").alias("chars"))


@query
def jsonl_ingest_stats(spark, sf_dir):
    docs = _document_json(spark, sf_dir)
    line, number = F.col("line"), F.col("doc_id")
    damaged = (
        F.when(number % 10 == 0, F.expr("left(line, length(line) - 5)"))
        .when(number % 7 == 0, F.lit(" \t "))
        .when(number % 11 == 0, F.concat(F.lit("["), line, F.lit("]")))
        .when(number % 13 == 0, F.concat(line, F.lit(" {}")))
        .otherwise(line)
    )
    lines = lines_of(docs, F.concat(F.lit("dump-"), F.col("lang")), damaged)
    return records.count_totals(records.ingest_counts(records.classify_lines(lines, "src3")))


@query
def json_field_types(spark, sf_dir):
    """A topic that is a number or missing never matches, even when its text would."""
    events = _table(spark, sf_dir, "events")
    topic = (
        F.when(F.col("event_id") % 3 == 0, F.lit('{"subreddit":"7","event_id":'))
        .when(F.col("event_id") % 3 == 1, F.lit('{"subreddit":7,"event_id":'))
        .otherwise(F.lit('{"subreddit":"x","subreddit":"7","event_id":'))
    )
    lines = lines_of(events, F.lit("f"), F.concat(topic, F.col("event_id"), F.lit("}")))
    return topic_table(records.classify_lines(lines, "7"), T.StructType.fromDDL("event_id bigint, subreddit string"))


@query
def created_cast(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    which = F.col("event_id") % 5
    value = (
        F.when(which == 0, F.col("user_id").cast("string"))
        .when(which == 1, F.col("value").cast("decimal(18,2)").cast("string"))
        .when(which == 2, F.concat(F.lit('" '), F.col("user_id"), F.lit('"')))
        .when(which == 3, F.lit('"n/a"'))
        .otherwise(F.lit("true"))
    )
    line = F.concat(
        F.lit('{"subreddit":"All","edited":false,"event_id":'), F.col("event_id"), F.lit(',"created_utc":'), value, F.lit("}")
    )
    schema = T.StructType.fromDDL("event_id bigint, created_utc bigint, _created_utc_raw string")
    return topic_table(records.classify_lines(lines_of(events, F.lit("f"), line), "all"), schema)


@query
def id_keyed_objects(spark, sf_dir):
    """An object whose keys are ids is read as a MAP, so the schema does not grow with the ids."""
    events = _table(spark, sf_dir, "events")
    line = F.concat(
        F.lit('{"subreddit":"All","event_id":'), F.col("event_id"), F.lit(',"users":{"'), F.col("event_id"), F.lit('":'),
        F.col("user_id"), F.lit('},"props":'), F.col("props"), F.lit("}"),
    )
    lines = records.classify_lines(lines_of(events, F.lit("f"), line), "all")
    table = topic_table(lines, map_fields=["users"], json_fields=["props"])
    return table.select(
        "event_id",
        F.map_keys("users")[0].alias("key"),
        F.map_values("users")[0].alias("user"),
        F.replace("props", F.lit(" "), F.lit("")).alias("props"),
        F.lit(len(table.columns)).cast("bigint").alias("columns"),
    )


@query
def open_object_keys(spark, sf_dir):
    """Object paths of orders written as JSON, and whether they are tables of ids that a schema must not spell out."""
    text = F.concat(
        F.lit('{"status":"'), "o_orderstatus", F.lit('","by_order":{"'), "o_orderkey", F.lit('":'), F.col("o_totalprice").cast("bigint"),
        F.lit('},"meta":{"by_day":{"'), F.date_format("o_orderdate", "EEE"), F.lit('":1},"list":[{"'), F.substring("o_orderpriority", 1, 1), F.lit('":1}]}}'),
    )
    found = shapes.object_keys(_table(spark, sf_dir, "orders").select(F.parse_json(text).alias("record")), F.col("record"), max_keys=100)
    return found.select("path", "first_key", "last_key", "is_open")


@query
def mixed_type_fields(spark, sf_dir):
    """A field that is a number here and text or an object there keeps every value as text."""
    events = _table(spark, sf_dir, "events")
    which = F.col("event_id") % 3
    mixed = (
        F.when(which == 0, F.col("user_id").cast("string"))
        .when(which == 1, F.concat(F.lit('"'), F.col("event_type"), F.lit('"')))
        .otherwise(F.col("props"))
    )
    line = F.concat(
        F.lit('{"subreddit":"All","event_id":'), F.col("event_id"), F.lit(',"gone":{},"none":[null],"mixed":'), mixed, F.lit("}")
    )
    table = topic_table(records.classify_lines(lines_of(events, F.lit("f"), line), "all"))
    text = F.replace(F.col("mixed"), F.lit(" "), F.lit(""))
    return table.drop("_source_path", "_kind", "_month", "subreddit").withColumn("mixed", text)


@query
def normalize_records(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        F.upper("source").alias("subreddit"),
        (F.col("n_chars") + 0.75).alias("created_utc"),
        F.lit(True).alias("edited"),
        F.concat(F.lit("&lt;"), F.col("lang"), F.lit("&gt;")).alias("title"),
    )
    normal = records.normalize(docs)
    return normal.drop("_created_utc_raw").withColumn("dropped", F.lit("edited" not in normal.columns))


@query
def html_unescape(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", entities.html_unescape(F.col("html")).alias("html"))


def _dump_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyy-MM")
    which = F.col("o_orderkey") % 4
    name = (
        F.when(which == 0, F.concat(F.lit("RC_"), month, F.lit(".zst")))
        .when(which == 1, F.concat(F.lit("rs_"), month, F.lit("_part.jsonl")))
        .when(which == 2, F.concat(F.lit("x_RC_"), month, F.lit(".zst")))
        .otherwise(F.concat(F.lit("RC-"), month, F.lit(".gz")))
    )
    return _table(spark, sf_dir, "orders").select("o_orderkey", name.alias("name"))


@query
def kind_month_from_name(spark, sf_dir):
    names = _dump_names(spark, sf_dir)
    return names.select(
        "o_orderkey", paths.dump_kind(F.col("name")).alias("kind"), paths.dump_month(F.col("name")).alias("month")
    )


@query
def provenance_columns(spark, sf_dir):
    located = _dump_names(spark, sf_dir).select("o_orderkey", F.concat(F.lit("/dumps/"), F.col("name")).alias("_source_path"))
    return records.with_provenance(located)


# ---- nested values -----------------------------------------------------------------------------


@query
def sanitize_nested(spark, sf_dir):
    number = F.col("event_id")
    events = _table(spark, sf_dir, "events").select(
        "event_id",
        F.struct(
            F.when(number % 2 == 0, F.col("user_id")).alias("a"),
            F.struct(F.when(number % 3 == 0, F.col("value")).alias("x"), F.lit(None).alias("void")).alias("inner"),
        ).alias("s"),
        F.when(number % 5 == 0, F.array().cast("array<bigint>"))
        .when(number % 5 == 1, F.array(F.lit(None).cast("bigint")))
        .when(number % 5 == 2, F.array(F.lit(None).cast("bigint"), F.col("user_id")))
        .otherwise(F.array("user_id"))
        .alias("list"),
        F.array(
            F.struct(F.when(number % 2 == 0, F.col("user_id")).alias("k")),
            F.struct(F.when(number % 3 == 0, F.col("user_id")).alias("k")),
        ).alias("structs"),
        F.array().alias("nothing"),
    )
    clean = nested.sanitize(events)
    return clean.select(
        "event_id",
        F.col("s").isNull().alias("s_null"),
        F.col("s.a").alias("s_a"),
        F.col("s.inner").isNull().alias("inner_null"),
        F.col("s.inner.x").alias("inner_x"),
        F.coalesce(F.size("list"), F.lit(-1)).cast("bigint").alias("list_size"),
        F.element_at("list", -1).alias("list_last"),
        F.col("structs").isNull().alias("structs_null"),
        F.col("structs")[0].isNull().alias("first_null"),
        F.lit(len(clean.columns)).cast("bigint").alias("columns"),
    )


@query
def drop_all_null_fields(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select(
        "event_id",
        F.lit(None).alias("void"),
        F.lit(None).cast("string").alias("no_text"),
        F.array().cast("array<int>").alias("no_items"),
        F.struct(F.lit(None).cast("int").alias("x")).alias("no_parts"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("click_value"),
    )
    return nested.drop_all_null_columns(nested.sanitize(events))


@query
def nested_to_json(spark, sf_dir):
    value = F.struct(
        "user_id",
        F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("kind"),
        F.array("event_id", "user_id").alias("ids"),
        F.col("event_type").cast("binary").alias("raw"),
    )
    events = _table(spark, sf_dir, "events").select("event_id", value.alias("v"))
    text = events.select("event_id", nested.json_text(F.col("v"), events.schema["v"].dataType).alias("t"))
    return text.select(
        "event_id",
        F.get_json_object("t", "$.user_id").cast("bigint").alias("user_id"),
        F.get_json_object("t", "$.kind").alias("kind"),
        F.get_json_object("t", "$.ids[0]").cast("bigint").alias("first_id"),
        F.get_json_object("t", "$.raw").alias("raw"),
        F.col("t").contains('"kind":').alias("keeps_null_fields"),
    )


# ---- schemas and unions ------------------------------------------------------------------------


@query
def align_schema(spark, sf_dir):
    target = T.StructType.fromDDL(
        "o_orderstatus STRING, o_orderkey INT, extra DOUBLE, o_totalprice BIGINT, o_custkey TINYINT, o_orderpriority INT"
    )
    return align_to_schema(_table(spark, sf_dir, "orders"), target)


@query
def union_by_name_widen(spark, sf_dir):
    customers = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), "c_mktsegment"
    )
    suppliers = _table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").cast("int").alias("key"), F.col("s_acctbal").alias("balance"), "s_nationkey"
    )
    return union.union_by_name([customers, suppliers])


@query
def union_files_by_name(spark, sf_dir):
    return union.union_files(list_files(spark, sf_dir, "{customer,supplier,nation}.parquet"), order="name")


@query
def union_type_conflict(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    folder = scratch_dir(spark, "conflict")
    orders.select("o_orderkey", F.col("o_custkey").alias("v")).write.parquet(f"{folder}/a")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice").cast("decimal(18,2)").cast("string")).otherwise(
        F.col("o_orderpriority")
    )
    orders.select("o_orderkey", text.alias("v"), F.col("o_orderstatus").cast("binary").alias("w")).write.parquet(f"{folder}/b")
    orders.select(
        "o_orderkey", F.lit(None).cast("double").alias("v"), F.struct("o_orderstatus").alias("w")
    ).write.parquet(f"{folder}/c")
    merged = union.union_files(list_files(spark, folder, "*.parquet"))
    return merged.select(
        "o_orderkey", F.round("v", 2).alias("v"), F.coalesce(F.get_json_object("w", "$.o_orderstatus"), "w").alias("w")
    )


@query
def union_schema_types(spark, sf_dir):
    """The union schema of all tables in the folder."""
    schema = union.union_schema(list_files(spark, sf_dir, "*.parquet"), order="name")
    seen = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return spark.createDataFrame(seen, "column string, type string")


@query
def merge_parquet_folder(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    folder, out = scratch_dir(spark, "merge-in"), scratch_dir(spark, "merged")
    events.select("event_id", "event_type", F.col("user_id").cast("int").alias("user_id")).write.parquet(f"{folder}/a")
    events.select("event_id", "value", "user_id").write.parquet(f"{folder}/b")
    events.select(F.col("event_type").alias("extra"), (F.col("event_id") + 0.5).alias("user_id")).write.parquet(f"{folder}/c")
    merge_folder(spark, folder, out)
    return read_parquet(spark, out)


# ---- profiling ---------------------------------------------------------------------------------


def _gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("event_id")
    return _table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        F.when(number % 50 == 0, F.lit(float("nan"))).when(number % 7 != 0, F.col("value")).alias("value"),
        F.when(number % 3 == 0, F.array("user_id")).alias("users"),
        F.lit(None).cast("string").alias("nothing"),
    )


@query
def filter_expression(spark, sf_dir):
    return profile.filter_view(_table(spark, sf_dir, "events"), "value > 100 AND event_type == 'click'").drop("props")


@query
def not_equal_keep_missing(spark, sf_dir):
    events = _gappy_events(spark, sf_dir)
    return events.filter(scalars.ne_keep_missing(F.col("event_type"), "click")).select("event_id", "event_type")


@query
def row_count(spark, sf_dir):
    return profile.row_count(_table(spark, sf_dir, "lineitem"))


@query
def shape(spark, sf_dir):
    return profile.shape(_table(spark, sf_dir, "lineitem"))


@query
def column_profile(spark, sf_dir):
    return profile.column_profile(_gappy_events(spark, sf_dir))


@query
def info_summary(spark, sf_dir):
    return profile.info(_table(spark, sf_dir, "lineitem")).drop("type")


@query
def min_max(spark, sf_dir):
    return profile.min_max(_gappy_events(spark, sf_dir), "value")


@query
def min_max_all_missing(spark, sf_dir):
    other = F.when(F.col("event_type") != F.lower("event_type"), F.col("event_type"))
    return profile.min_max(_table(spark, sf_dir, "events").withColumn("nothing", other), "nothing")


@query
def column_types(spark, sf_dir):
    return profile.column_types(_table(spark, sf_dir, "lineitem"))


@query
def unknown_column(spark, sf_dir):
    """A column that does not exist is an error that names it, whatever is asked about it."""
    events = _table(spark, sf_dir, "events")
    said = []
    for ask in (profile.min_max, profile.value_counts, profile.sample_column):
        try:
            ask(events, "no_such")
        except ValueError as error:
            said.append(str(error).split(",")[0])
    return events.agg(F.count("event_id").alias("rows")).withColumn("error", F.lit("; ".join(sorted(set(said)))))


@query
def value_counts(spark, sf_dir):
    return profile.value_counts(_gappy_events(spark, sf_dir), "event_type")


@query
def value_counts_topk(spark, sf_dir):
    return profile.value_counts(_table(spark, sf_dir, "lineitem"), "l_partkey", 25)


@query
def frequent_values(spark, sf_dir):
    return profile.frequent_values(_table(spark, sf_dir, "lineitem"), "l_partkey", 25)


@query
def value_counts_nan(spark, sf_dir):
    return profile.value_counts(_gappy_events(spark, sf_dir), "value", 30)


@query
def null_fractions(spark, sf_dir):
    labels = _table(spark, sf_dir, "labels")
    labelled = _table(spark, sf_dir, "documents").select("doc_id", "lang").join(labels, "doc_id", "left")
    found = profile.null_fractions(labelled.withColumn("nan", F.lit(float("nan"))), 3)
    return found.withColumn("null_fraction", F.round("null_fraction", 9))


@query
def head_rows(spark, sf_dir):
    return profile.dataset_head(spark, f"{sf_dir}/orders.parquet", 25)


@query
def tail_rows(spark, sf_dir):
    return profile.dataset_tail(spark, f"{sf_dir}/orders.parquet", 25)


@query
def head_by_key(spark, sf_dir):
    return profile.head(_table(spark, sf_dir, "lineitem"), 40, order_by=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query
def tail_filtered(spark, sf_dir):
    clicks = profile.filter_view(_table(spark, sf_dir, "events"), "event_type = 'click'")
    return profile.tail(clicks, 40, order_by=["event_id"])


@query
def sample_rows(spark, sf_dir):
    return profile.sample_rows(_table(spark, sf_dir, "orders"), 50, seed=7, key=["o_orderkey"])


@query
def sample_column(spark, sf_dir):
    return profile.sample_column(_gappy_events(spark, sf_dir), "value", 50, seed=7, key=["event_id"])


@query
def sample_all_columns(spark, sf_dir):
    return profile.sample_all_columns(_gappy_events(spark, sf_dir), 3, seed=7, key=["event_id"])


@query
def sample_one_per_column(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return profile.sample_all_columns(orders, seed=7, key=["o_orderkey"])


@query
def sample_checks(spark, sf_dir):
    """A sample of every order is the whole table; a smaller one has distinct members only."""
    orders = _table(spark, sf_dir, "orders")
    few = profile.sample_rows(orders, 100, seed=3).select("o_orderkey")
    member = few.join(orders.select("o_orderkey"), "o_orderkey", "left_semi")
    return member.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("distinct_keys"))


@query
def sample_column_checks(spark, sf_dir):
    """The drawn values are values of the column, and the same ones whatever the partitioning."""
    events = _gappy_events(spark, sf_dir)
    drawn = profile.sample_column(events, "value", 50, seed=7, key=["event_id"])
    again = profile.sample_column(events.repartition(5), "value", 50, seed=7, key=["event_id"])
    member = drawn.join(events.select("value"), "value", "left_semi")
    return (
        member.groupBy("value").agg(F.count(F.lit(1)).alias("a"))
        .join(again.groupBy("value").agg(F.count(F.lit(1)).alias("b")), "value", "full")
        .agg(F.sum("a").alias("n"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("differing"))
    )


@query
def sample_all_columns_checks(spark, sf_dir):
    picked = profile.sample_all_columns(_gappy_events(spark, sf_dir), 3, seed=7, key=["event_id"])
    return picked.groupBy("column").agg(F.count("value").alias("n"))


# ---- scalar functions --------------------------------------------------------------------------


@query
def human_sizes(spark, sf_dir):
    size = (F.col("o_totalprice") * F.pow(F.lit(10.0), F.col("o_orderkey") % 9)).cast("bigint")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", size.alias("bytes"))
    return orders.withColumn("size", scalars.human_bytes(F.col("bytes")))


@query
def iso_times(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", scalars.iso_seconds(F.col("ts")).alias("ts"))


@query
def iso_now(spark, sf_dir):
    now = scalars.iso_now().rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d[+-]\d{4}$")
    return _table(spark, sf_dir, "events").select("event_id", now.alias("iso"))


@query
def path_parts(spark, sf_dir):
    file = F.concat(F.lit("file:/data/set."), F.col("p_size"), F.lit("/"), F.col("p_brand"), F.lit("."), F.upper("p_type"))
    part = _table(spark, sf_dir, "part").select("p_partkey", file.alias("f"))
    return part.select(
        "p_partkey",
        paths.base_name(F.col("f")).alias("name"),
        paths.extension(F.col("f")).alias("ext"),
        paths.relative_path(F.col("f"), "/data").alias("below"),
        paths.plain_path(F.col("f")).alias("path"),
    )


@query
def blank_text(spark, sf_dir):
    # words gone, the blanks between them stay; or everything gone
    emptied = F.concat(F.lit("\t"), F.regexp_replace("text", r"\S", ""))
    text: Column = F.when(F.col("turn") == 0, emptied).when(F.col("turn") == 1, F.left("text", F.lit(0))).otherwise(F.col("text"))
    return (
        _table(spark, sf_dir, "conversations")
        .groupBy("turn")
        .agg(F.count_if(scalars.is_blank(text)).alias("blank"), F.count(F.lit(1)).alias("n"))
    )


# ---- files, sources and sinks ------------------------------------------------------------------


def _stored_lineitem(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch_dir(spark, "lineitem")
    write_parquet(
        _table(spark, sf_dir, "lineitem"), folder, "snappy", ("l_returnflag", "l_linestatus"), rows_per_file=50_000
    )
    return folder


@query
def file_inventory(spark, sf_dir):
    """Files per folder and the rows their footers promise."""
    footers = parquet_footers(list_dataset(spark, _stored_lineitem(spark, sf_dir)))
    flag = F.regexp_extract("path", "l_returnflag=([^/]*)", 1)
    status = F.regexp_extract("path", "l_linestatus=([^/]*)", 1)
    return footers.groupBy(flag.alias("l_returnflag"), status.alias("l_linestatus")).agg(F.sum("num_rows").alias("rows"))


def _file_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of files that do not exist: figures about them can be told from the table they are made of."""
    number = F.col("o_orderkey")
    ending = (
        F.when(number % 5 == 0, F.lit(".parquet")).when(number % 5 == 1, F.lit(".PARQ")).when(number % 5 == 2, F.lit("")).otherwise(F.lit(".zst"))
    )
    path = F.concat(F.lit("/data/"), F.lower("o_orderstatus"), F.lit("/RC_"), number, ending)
    return _table(spark, sf_dir, "orders").select(
        path.alias("path"),
        paths.base_name(path).alias("name"),
        paths.extension(path).alias("ext"),
        (F.col("o_custkey") * 1000 + number % 1000).alias("length"),
        F.col("o_orderdate").alias("modified"),
    )


@query
def largest_of_listing(spark, sf_dir):
    return corpus.largest_files(_file_table(spark, sf_dir), "/data")


@query
def extensions_of_listing(spark, sf_dir):
    return corpus.extension_counts(_file_table(spark, sf_dir))


@query
def sizes_of_listing(spark, sf_dir):
    return corpus.file_stats(_file_table(spark, sf_dir))


@query
def ordered_files(spark, sf_dir):
    """Files in the order jobs take them, those on the ignore list left out."""
    kept = without(_file_table(spark, sf_dir), ["RC_4", "RC_5.parquet"])
    return numbered(kept.select("path"))


def _footer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = F.when(F.col("p_size") % 9 == 0, F.lit("unreadable"))
    return _table(spark, sf_dir, "part").select(
        F.concat(F.lit("file:/data/"), "p_partkey", F.lit(".parquet")).alias("path"),
        F.when(error.isNull(), F.col("p_size")).alias("num_row_groups"),
        F.when(error.isNull(), F.col("p_partkey") * 10).alias("num_rows"),
        F.when(error.isNull(), F.col("p_partkey") * F.col("p_size")).alias("total_byte_size"),
        error.alias("error"),
    )


def _stored_text(spark: SparkSession, sf_dir: str) -> str:
    """Orders as text, a file per month: sizes of real files that can also be told from the rows."""
    folder, orders = scratch_dir(spark, "text"), _table(spark, sf_dir, "orders")
    line = F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    months = orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), line.alias("line")).repartition("month")
    months.write.partitionBy("month").text(folder)
    return folder


@query
def largest_files(spark, sf_dir):
    folder = _stored_text(spark, sf_dir)
    found = corpus.largest_files(list_dataset(spark, folder), folder)
    return found.select(F.regexp_extract("file", "month=([^/]*)", 1).alias("month"), "length", "size")


@query
def extension_counts(spark, sf_dir):
    """Files per ending, of a listing with a file per order and of files stored for this, counted as one listing."""
    stored = list_dataset(spark, _stored_text(spark, sf_dir))
    return corpus.extension_counts(_file_table(spark, sf_dir).select("ext").unionAll(stored.select("ext")))


@query
def file_size_stats(spark, sf_dir):
    stats = corpus.file_stats(list_dataset(spark, _stored_text(spark, sf_dir)))
    return stats.withColumn("in_order", F.col("mtime_earliest") <= F.col("mtime_latest")).drop("mtime_earliest", "mtime_latest")


@query
def row_groups(spark, sf_dir):
    """Row groups of stored line items, read from the files' footers."""
    return corpus.row_group_totals(corpus.dataset_footers(spark, _stored_lineitem(spark, sf_dir))).drop("total_byte_size")


@query
def most_row_groups(spark, sf_dir):
    folder = scratch_dir(spark, "groups")
    write_parquet(_table(spark, sf_dir, "orders"), folder, "snappy", ("o_orderpriority", "o_orderstatus"), rows_per_group=100)
    found = corpus.most_row_groups(corpus.dataset_footers(spark, folder), folder, 100)
    priority, status = (F.regexp_extract(F.url_decode("file"), f"{name}=([^/]*)", 1).alias(name) for name in ("o_orderpriority", "o_orderstatus"))
    return found.select(priority, status, "num_row_groups", "num_rows")


@query
def row_groups_of_listing(spark, sf_dir):
    return corpus.row_group_totals(_footer_table(spark, sf_dir))


@query
def most_row_groups_of_listing(spark, sf_dir):
    return corpus.most_row_groups(_footer_table(spark, sf_dir), "/data")


@query
def stored_row_groups(spark, sf_dir):
    """Row groups of files written with a fixed number of rows in each."""
    folder = scratch_dir(spark, "groups")
    write_parquet(_table(spark, sf_dir, "orders"), folder, "snappy", ("o_orderstatus",), rows_per_group=1_000)
    return corpus.row_group_totals(parquet_footers(list_dataset(spark, folder))).select(
        "total_row_groups", "files_unreadable", "total_rows"
    )


@query
def corpus_meta(spark, sf_dir):
    meta = corpus.corpus_meta(spark, _stored_lineitem(spark, sf_dir))
    return meta.select("is_directory", "rows", "cols", F.get_json_object("ext_counts", "$['.parquet']").cast("bigint").alias("files"), "file_count")


@query
def csv_roundtrip(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "csv")
    write_csv(docs, folder)
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("lineSep", "\n")
    return reader.schema(docs.schema).csv(folder)


@query
def csv_first_rows(spark, sf_dir):
    """The first rows of a view by its key, in that order."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    folder = scratch_dir(spark, "csv")
    write_csv(orders, folder, n=70, order_by=["o_orderpriority", "o_orderkey"])
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return spark.read.option("header", True).schema(orders.schema).csv(folder).withColumn("place", place)


@query
def parquet_roundtrip(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    folder = scratch_dir(spark, "codecs")
    for codec in PARQUET_CODECS:
        write_parquet(orders, f"{folder}/codec={codec}", codec)
    return (
        read_parquet(spark, folder)
        .groupBy("codec")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.max("o_orderdate").alias("latest"))
    )


def _codec() -> Column:
    return F.element_at(F.split("path", "/"), -2).alias("codec")


@query
def decode_codecs(spark, sf_dir):
    """The same lines in eight encodings, some with a byte that is no UTF-8."""
    customers = _table(spark, sf_dir, "customer")
    folder = scratch_dir(spark, "encodings")
    odd = F.when(F.col("c_custkey") % 10 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    head, tail = F.concat(F.lit('{"c_name":"'), "c_name"), F.concat(
        F.lit('","c_custkey":'), "c_custkey", F.lit(',"c_acctbal":'), F.col("c_acctbal").cast("decimal(18,2)"), F.lit("}")
    )
    line = F.concat(head.cast("binary"), odd, tail.cast("binary"))
    write_dumps(customers.select(line.alias("line")), folder, list(ENCODINGS))
    lines = read_lines(list_dumps(spark, folder, recursive=True))
    record = F.from_json("value", customers.schema)
    return (
        lines.select(_codec(), record.alias("r"))
        .groupBy("codec")
        .agg(
            F.count("r.c_custkey").alias("n"),
            F.sum("r.c_custkey").alias("keys"),
            F.round(F.sum("r.c_acctbal"), 2).alias("balance"),
            F.count_if(F.col("r.c_name").endswith("\ufffd")).alias("replaced"),
        )
    )


@query
def decode_cut_files(spark, sf_dir):
    """Files cut in the middle, of all orders and of a few: each is reported, and what was decoded is kept from its start."""
    folder, codecs = scratch_dir(spark, "cut"), ["gz", "bz2", "xz", "zst"]
    orders = _table(spark, sf_dir, "orders")
    for part, rows in (("all", orders), ("few", orders.where("o_orderkey % 40 = 0"))):
        line = F.concat_ws(" ", F.monotonically_increasing_id(), "o_orderkey", "o_custkey", F.md5(F.col("o_orderkey").cast("string")))
        write_dumps(rows.select(line.cast("binary").alias("line")), f"{folder}/{part}", codecs, cut=0.8)
    lines = read_lines(list_dumps(spark, folder, recursive=True))
    number = F.split("value", " ")[0].cast("bigint").bitwiseAND(F.lit((1 << 33) - 1))
    files = lines.groupBy("path").agg(
        F.count_if(F.col("error").isNotNull()).alias("errors"),
        F.count("value").alias("kept"),
        (F.max(number) + 1).alias("upto"),
        F.count_if(F.size(F.split("value", " ")) != 4).alias("torn"),
    )
    return files.groupBy(_codec(), F.element_at(F.split("path", "/"), -3).alias("part")).agg(
        F.bool_and(F.col("errors") == 1).alias("reported"),
        F.bool_and(F.col("kept") == F.coalesce("upto", F.lit(0))).alias("from_start"),
        F.sum("torn").alias("torn"),
    )


@query
def union_lattice(spark, sf_dir):
    """What each rule of the type lattice makes of orders stored in two forms."""
    folder, orders = scratch_dir(spark, "lattice"), _table(spark, sf_dir, "orders")
    stamp, number = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey").cast("int")
    text, raw = F.col("o_orderpriority"), F.col("o_orderpriority").cast("binary")
    date = F.col("o_orderdate").cast("date")
    forms = {
        "mixed_sign": (number, pa.int32(), number, pa.uint32()),
        "widest": (number, pa.int32(), number.cast("long"), pa.int64()),
        "one_zone": (stamp, pa.timestamp("us", "UTC"), stamp, pa.timestamp("ms", "UTC")),
        "two_zones": (stamp, pa.timestamp("us", "UTC"), F.col("o_orderdate"), pa.timestamp("us")),
        "text_and_date": (text, pa.string(), date, pa.date32()),
        "all_binary": (raw, pa.binary(), raw, pa.large_binary()),
        "all_null": (F.lit(None).cast("string"), pa.null(), F.lit(None).cast("string"), pa.null()),
        "no_rule": (F.col("o_orderkey") % 2 == 0, pa.bool_(), date, pa.date32()),
    }
    for side in (0, 2):
        rows = orders.select(*(form[side].alias(name) for name, form in forms.items()))
        write_arrow(rows, f"{folder}/{side}", pa.schema([(name, form[side + 1]) for name, form in forms.items()]))
    files = list_files(spark, folder, "*.parquet")
    merged, numbers = union.union_files(files), union.union_schema(files, fallback="float64")
    counted = merged.agg(*(F.count(name).alias(name) for name in forms))
    entries = [
        F.struct(
            F.lit(name).alias("column"), F.lit(merged.schema[name].dataType.simpleString()).alias("type"),
            F.lit(numbers[name].dataType.simpleString()).alias("fallback"), F.col(name).alias("n"),
        )
        for name in forms
    ]
    return counted.select(F.inline(F.array(*entries)))


def _document_dumps(spark: SparkSession, sf_dir: str, codec: str) -> str:
    folder = scratch_dir(spark, "dumps")
    docs = _table(spark, sf_dir, "documents").select(F.upper("source").alias("subreddit"), "doc_id", "lang", "text", "n_chars")
    docs.write.option("compression", codec).json(folder)
    return folder


@query
def build_topic_table(spark, sf_dir):
    out = scratch_dir(spark, "topic")
    build_topic(spark, _document_dumps(spark, sf_dir, "none"), out, "SRC3")
    return read_parquet(spark, out, ["doc_id", "subreddit", "lang", "text", "n_chars"])


@query
def build_topic_aligned(spark, sf_dir):
    out, like = scratch_dir(spark, "topic"), scratch_dir(spark, "like")
    _table(spark, sf_dir, "documents").select(
        "text", F.col("n_chars").cast("int").alias("n_chars"), "doc_id", F.lit("").alias("absent")
    ).write.parquet(like)
    build_topic(spark, _document_dumps(spark, sf_dir, "bzip2"), out, "src5", schema_from=like)
    assert parquet_schema(spark, out) == parquet_schema(spark, like)
    return read_parquet(spark, out)


@query
def build_topic_report(spark, sf_dir):
    out = scratch_dir(spark, "topic")
    build_topic(spark, _document_dumps(spark, sf_dir, "gzip"), out, "src3")
    report = spark.read.json(f"{out}.report")
    return report.groupBy("event").agg(
        F.max("settings.topic").alias("topic"),
        F.sum("rows_written").alias("file_rows"),
        F.sum("lines_total").alias("lines_total"),
        F.sum("bad_json").alias("bad_json"),
        F.sum("matched").alias("matched"),
        F.max("totals.rows_written").alias("rows_written"),
    )
