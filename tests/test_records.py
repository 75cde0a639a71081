import json

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import records as R
from corpusmill.plans.build import topic_table
from corpusmill.sources.lines import lines_of

RAW_LINES = [
    '{"subreddit":"Swim","created_utc":1,"body":"a &amp; b","edited":false}',
    '{"subreddit":"sWIM","created_utc":"2","body":"&lt;x&gt;","extra":{"k":1}}',
    '{"subreddit":"swim","created_utc":3.9}',
    '{"subreddit":"swim","created_utc":"n/a"}',
    '{"subreddit":"other","created_utc":5}',
    '{"subreddit":null}',
    '{"subreddit":7}',
    "{}",
    "",
    "   ",
    "{bad",
    "[1,2]",
    "5",
    '{"subreddit":"x","subreddit":"swim"}',
    '{"subreddit":"swim","v":NaN}',
    '{"subreddit":"swim","mix":1}',
    '{"subreddit":"swim","mix":"z"}',
]


def frame(spark, lines, path="/d/RC_2025-03.zst"):
    df = spark.createDataFrame([(x,) for x in lines], "v string")
    return lines_of(df, F.lit(path), F.col("v"))


def test_lines_beyond_the_limits_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(R, "MAX_RECORD_BYTES", 40)
    lines = ['{"subreddit":"x","n":' + "1" * 5000 + "}", "{" + "x" * 50, "{bad", '{"subreddit":"x","t":"' + "y" * 60 + '"}']
    rows = {r.value: r for r in R.classify_lines(frame(spark, lines), "x").withColumn("value", F.col("error")).collect()}
    assert set(rows) == {"a line of 5022 bytes", "a line of 51 bytes", None}
    counts = R.ingest_counts(R.classify_lines(frame(spark, lines), "x")).first()
    assert (counts.lines_total, counts.bad_json, counts.too_large, counts.matched) == (4, 1, 2, 1)


def test_raw_lines(spark, plain_rows):
    classified = R.classify_lines(frame(spark, RAW_LINES), "Swim")
    counts = R.ingest_counts(classified).collect()
    assert [(r.lines_total, r.bad_json, r.matched) for r in counts] == [(15, 3, 8)]
    rows = plain_rows(topic_table(classified))
    assert len(rows) == 8
    assert "edited" not in rows[0]
    assert {r["subreddit"] for r in rows} == {"swim"}
    assert sorted(r["body"] for r in rows if r["body"]) == ["<x>", "a & b"]
    assert sorted(r["created_utc"] for r in rows if r["created_utc"] is not None) == [1, 2, 3]
    assert [r["_created_utc_raw"] for r in rows if r["_created_utc_raw"]] == ["n/a"]
    assert [r["extra"] for r in rows if r["extra"]] == [{"k": 1}]
    assert sorted(r["mix"] for r in rows if r["mix"]) == ["1", "z"]
    assert {(r["_kind"], r["_month"], r["_source_path"]) for r in rows} == {
        ("comments", "2025-03", "/d/RC_2025-03.zst")
    }


@pytest.mark.parametrize(
    "line",
    [
        "{bad", "[1]", "5", '"s"', "null", "true", '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}]',
        '{"a":1},5] x', "{'a':1}", '{"a":01}', '{"a":1,}', "{a:1}", '{"a":"x\ty"}', '{"a":1} // c', "﻿{}", '{"a"}',
        '{"a":.5}', '{"a":+1}',
    ],
)
def test_bad_lines(spark, line):
    assert [r.status for r in R.classify_lines(frame(spark, [line]), "x").collect()] == [R.BAD]
    with pytest.raises(Exception):
        value = json.loads(line)
        value.get("subreddit")


@pytest.mark.parametrize(
    "line", ['{"a":1}', ' \t{"a":1} \t', "{}", '{"a":NaN,"b":-Infinity}', '{"a":"\\ud83d\\ude00"}', '{"":1}', '{"a":1e400}']
)
def test_good_lines(spark, line):
    assert [r.status for r in R.classify_lines(frame(spark, [line]), "x").collect()] == [R.OTHER]
    assert isinstance(json.loads(line), dict)


@pytest.mark.parametrize("blank", ["", "  ", "\t", " ", " ", "\x1c\x1f", "\x85", "　 \x0b"])
def test_blank_lines_are_not_counted(spark, blank):
    assert not blank.strip()
    assert R.classify_lines(frame(spark, [blank]), "x").count() == 0


@pytest.mark.parametrize(
    "value, number, raw",
    [
        ("3.9", 3, None), ("-3.9", -3, None), ('"2"', 2, None), ('" 12 "', 12, None), ("true", 1, None),
        ("1e3", 1000, None), ('"1.9"', None, "1.9"), ('"1e3"', None, "1e3"), ("1e400", None, "Infinity"),
        ('"abc"', None, "abc"), ("null", None, None), ("9223372036854775808", None, "9223372036854775808"),
    ],
)
def test_time_values(spark, value, number, raw):
    lines = ['{"subreddit":"s","created":%s,"n":1}' % value, '{"subreddit":"s","created":1,"n":2}']
    table = topic_table(R.classify_lines(frame(spark, lines), "s"))
    row = table.filter("n = 1").first()
    assert row["created"] == number
    assert ("_created_raw" in table.columns) == (raw is not None)
    if raw is not None:
        assert row["_created_raw"] == raw


def test_inferred_schema(spark):
    lines = [
        '{"subreddit":"s","i":1,"d":1.5,"w":1,"t":"x","o":{"a":1},"l":[1],"e":{},"n":null,"el":[],"ln":[null],'
        '"le":[{}],"dd":{"x":{}},"A":1,"a":"u","big":123456789012345678901,"b":true,"a.b":1,"c`d":{"e f":2},"path":"p"}',
        '{"subreddit":"s","w":2.5,"o":{"b":"y"},"l":[2.5],"b":1,"_source_path":"mine","_kind":"k"}',
    ]
    table = topic_table(R.classify_lines(frame(spark, lines, "/d/x.json"), "s"))
    types = dict(table.dtypes)
    assert types == {
        "A": "bigint", "a": "string", "b": "string", "big": "decimal(21,0)", "d": "double", "i": "bigint",
        "l": "array<double>", "o": "struct<a:bigint,b:string>", "subreddit": "string", "t": "string", "w": "double",
        "a.b": "bigint", "c`d": "struct<e f:bigint>", "path": "string",
        "_source_path": "string", "_kind": "string", "_month": "string",
    }
    rows = sorted(table.collect(), key=lambda r: r.w)
    assert rows[0].asDict()["a.b"] == 1 and rows[0].asDict()["c`d"]["e f"] == 2
    assert [r["_source_path"] for r in rows] == ["/d/x.json"] * 2
    assert [r["_kind"] for r in rows] == [None, "k"]
    assert [r.b for r in rows] == ["true", "1"]


def test_records_are_sanitized(spark, plain_rows):
    lines = [
        '{"subreddit":"s","n":1,"o":{"a":{},"b":1},"l":[{},{"x":1}]}',
        '{"subreddit":"s","n":2,"o":{"a":{"z":1}},"l":[{}]}',
        '{"subreddit":"s","n":3,"o":{"a":{"z":null}},"l":[]}',
    ]
    rows = plain_rows(topic_table(R.classify_lines(frame(spark, lines), "s")).select("n", "o", "l").orderBy("n"))
    assert rows == [
        {"n": 1, "o": {"a": None, "b": 1}, "l": [None, {"x": 1}]},
        {"n": 2, "o": {"a": {"z": 1}, "b": None}, "l": None},
        {"n": 3, "o": None, "l": None},
    ]


def test_counts_add_up_and_do_not_depend_on_partitions(spark):
    lines = frame(spark, RAW_LINES * 7)
    results = []
    for n in (1, 8):
        classified = R.classify_lines(lines.repartition(n), "swim")
        total = R.count_totals(R.ingest_counts(classified)).filter("path IS NULL").first()
        others = classified.filter("status = 'other'").count()
        assert total.lines_total == total.bad_json + total.too_large + others + total.matched
        results.append(tuple(total)[1:])
    assert results[0] == results[1] == (105, 21, 0, 56)


def test_counters_are_hashed_not_sorted(spark):
    plan = R.ingest_counts(R.classify_lines(frame(spark, RAW_LINES), "swim"))._jdf.queryExecution().executedPlan()
    assert "SortAggregate" not in plan.toString() and "HashAggregate" in plan.toString()


def test_no_match_gives_an_empty_schema(spark):
    classified = R.classify_lines(frame(spark, RAW_LINES), "nobody")
    assert R.record_schema(classified.filter("status = 'match'")).fields == []


def test_normalize_typed_columns(spark):
    df = spark.createDataFrame(
        [("ABC", "12", 3.7, "&#39;a&#39; &notit; &amp;lt;", True)],
        "subreddit string, created string, created_utc double, title string, edited boolean",
    )
    row = R.normalize(df).first()
    assert (row.subreddit, row.created, row.created_utc, row.title) == ("abc", 12, 3, "'a' ¬it; &lt;")
    assert "edited" not in row.asDict()
