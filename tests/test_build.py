import gzip
import json
import lzma
import os
import zlib
from types import SimpleNamespace

import pytest
import zstandard
from pyspark.sql import functions as F

from corpusmill.plans.build import NoRecords, build_topic
from corpusmill.session import scratch_dir


def record(n, topic="Swim", **more):
    return json.dumps({"subreddit": topic, "id": n, "created_utc": str(n), **more})


CUT = gzip.compress("\n".join(record(n, "other", noise=str(hash(n * 7919))) for n in range(1000, 1400)).encode())[:4000]
# the lines that end before the cut
KEPT = zlib.decompressobj(31).decompress(CUT).count(b"\n")


@pytest.fixture
def dumps(tmp_path):
    folder = tmp_path / "in"
    (folder / "deep").mkdir(parents=True)
    comments = "\n".join(
        [record(1, body="a &gt; b", gone={}), record(2, "other"), "{broken", "", record(3, "SWIM", score=1.5, edited=9)]
    )
    (folder / "RC_2025-01.zst").write_bytes(zstandard.compress(comments.encode()))
    (folder / "RC_2025-02.jsonl").write_text("\r\n".join(record(n, seven=n % 7) for n in range(100, 200)))
    (folder / "deep" / "RS_2025-02.xz").write_bytes(lzma.compress(record(4, title="&amp;", score="high").encode()))
    (folder / "deep" / "none.gz").write_bytes(gzip.compress(record(5, "other").encode() + b"\n"))
    (folder / "deep" / "cut.gz").write_bytes(CUT)
    (folder / "skip.json").write_text(record(6))
    return folder


def test_build(spark, dumps, tmp_path):
    out = str(tmp_path / "out")
    result = build_topic(spark, str(dumps), out, "swim", ignore=["skip.json"])
    assert (result.files_scanned, result.files_broken) == (5, 1)
    assert (result.lines_total, result.bad_json, result.matched, result.rows_written) == (106 + KEPT, 1, 103, 103)
    df = spark.read.parquet(out)
    assert df.count() == 103
    assert {tuple(r) for r in df.select("_kind", "_month").distinct().collect()} == {
        ("comments", "2025-01"), ("comments", "2025-02"), ("submissions", "2025-02"),
    }
    rows = {r.id: r for r in df.filter("id < 100").collect()}
    assert sorted(rows) == [1, 3, 4]
    assert (rows[1].body, rows[1].created_utc, rows[1].subreddit) == ("a > b", 1, "swim")
    assert (rows[3].score, rows[4].score, rows[4].title) == ("1.5", "high", "&")
    assert rows[1]._source_path == str(dumps / "RC_2025-01.zst")
    assert not {"gone", "edited"} & set(df.columns)

    report = spark.read.json(result.report).collect()
    files = {os.path.basename(r.file): r for r in report if r.event == "file"}
    assert {n: (r.status, r.lines_total, r.matched) for n, r in files.items()} == {
        "RC_2025-01.zst": ("ok", 4, 2), "RC_2025-02.jsonl": ("ok", 100, 100), "RS_2025-02.xz": ("ok", 1, 1),
        "none.gz": ("no_matches", 1, 0), "cut.gz": ("error", KEPT, 0),
    }
    assert files["cut.gz"].error
    finish = next(r for r in report if r.event == "finish")
    assert (finish.status, finish.totals.matched, finish.totals.rows_written) == ("ok", 103, 103)
    assert finish.dropped_fields == ["gone"]
    config = next(r for r in report if r.event == "config")
    assert config.settings.topic == "swim" and config.ts


def test_build_into_a_given_schema(spark, dumps, tmp_path):
    like, out = str(tmp_path / "like"), str(tmp_path / "out")
    spark.sql("select cast(1 as tinyint) id, '' body, 1.0D absent, array(1) l").write.parquet(like)
    result = build_topic(spark, str(dumps), out, "SWIM", schema_from=like)
    df = spark.read.parquet(out)
    assert df.schema == spark.read.parquet(like).schema
    assert result.rows_written == df.count() == 104
    assert df.filter("id is null").count() == 72
    assert df.filter("absent is not null or l is not null").count() == 0


def test_nothing_to_read_or_to_write(spark, dumps, tmp_path):
    with pytest.raises(NoRecords):
        build_topic(spark, str(dumps), str(tmp_path / "out"), "nobody")
    assert not (tmp_path / "out").exists()
    report = spark.read.json(str(tmp_path / "out.report"))
    assert report.filter("event = 'finish'").first().status == "no_matches"
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        build_topic(spark, str(tmp_path / "empty"), str(tmp_path / "out2"), "x")
    assert spark.read.json(str(tmp_path / "out2.report")).first().status == "no_input"


def test_output_below_the_input_is_refused(spark, dumps, tmp_path):
    for paths in ({"out": str(dumps / "out")}, {"out": str(tmp_path / "o"), "report": str(dumps / "deep" / "r")}):
        with pytest.raises(ValueError, match="lies inside"):
            build_topic(spark, str(dumps), topic="swim", **paths)


def test_hidden_dumps_are_refused(spark, dumps, tmp_path):
    for name in ("_more.zst", "deep/.one.gz", "deep/_sub/two.json"):
        (dumps / name).parent.mkdir(exist_ok=True)
        (dumps / name).write_bytes(b"{}")
    with pytest.raises(ValueError, match="3 files .*two.json"):
        build_topic(spark, str(dumps), str(tmp_path / "o"), "swim")
    with pytest.raises(ValueError, match="1 files .*_more.zst"):
        build_topic(spark, str(dumps), str(tmp_path / "o"), "swim", recursive=False)


def test_a_run_that_fails_leaves_a_report(spark, dumps, tmp_path, monkeypatch):
    from corpusmill.plans import build

    def broken(*_, **__):
        raise RuntimeError("disk full")

    monkeypatch.setattr(build, "write_parquet", broken)
    with pytest.raises(RuntimeError):
        build_topic(spark, str(dumps), str(tmp_path / "o"), "swim", ignore=["skip.json"])
    report = spark.read.json(str(tmp_path / "o.report"))
    last = report.filter("event = 'finish'").first()
    assert (last.status, last.error) == ("aborted", "RuntimeError: disk full")
    config = report.filter("event = 'config'").first()
    assert (config.settings["ignore"], config.settings["files"]) == ("skip.json", "5")
    assert report.filter("event = 'file'").agg(F.sum("matched")).first()[0] == 103


def test_matches_are_staged_apart(spark, dumps, tmp_path):
    build_topic(spark, str(dumps), str(tmp_path / "o"), "swim", staged=str(tmp_path / "s"), keep_staged=True)
    assert {p.name for p in (tmp_path / "s").iterdir() if p.is_dir()} == {f"status={s}" for s in ("match", "other", "bad", "broken")}


def test_staged_table_can_be_kept(spark, dumps, tmp_path):
    staged = str(tmp_path / "staged")
    build_topic(spark, str(dumps), str(tmp_path / "out"), "swim", staged=staged, keep_staged=True)
    kept = spark.read.parquet(staged)
    assert kept.filter(F.col("status") == "match").count() == 104
    assert kept.filter("record is not null and status <> 'match'").count() == 0


def session_with(folder, master="yarn"):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)


def test_scratch_folder_is_the_shared_one():
    assert scratch_dir(session_with("hdfs://n/shared/"), "x").startswith("hdfs://n/shared/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session_with(None), "x")
    assert os.path.isabs(scratch_dir(session_with(None, "local[2]"), "x"))
