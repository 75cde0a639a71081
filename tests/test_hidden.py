import pytest

from corpusmill.plans.merge import merge_folder
from corpusmill.sources import files
from corpusmill.sources.files import HiddenFiles, hidden_files, refuse_hidden, walk


@pytest.fixture
def tree(tmp_path):
    names = [
        "a.zst", "_b.zst", ".c.zst", "notes.txt", "_d.txt", "kind=x/e.zst", "_kind=x/f.zst", "_kind=x/_g.zst", ".kind=x/h.zst",
        "deep/er/_i.ZST", "deep/er/j.zst", "_old/k.zst", "_old/deeper/l.zst", ".m/n.zst", "deep/_o/p=1/q.zst", "odd [x]*/_r.zst",
    ]
    for name in names:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x")
    (tmp_path / "empty" / "_empty").mkdir(parents=True)
    return tmp_path


HIDDEN = [
    ".c.zst", ".kind=x/h.zst", ".m/n.zst", "_b.zst", "_kind=x/_g.zst", "_old/deeper/l.zst", "_old/k.zst", "deep/_o/p=1/q.zst",
    "deep/er/_i.ZST", "odd [x]*/_r.zst",
]


def test_hidden_files_at_every_level(spark, tree):
    count, found = hidden_files(spark, str(tree), [".zst"], most=20)
    assert count == 10 and [p.removeprefix(f"{tree}/") for p in found] == HIDDEN
    count, few = hidden_files(spark, f"file://{tree}/", [".zst", ".txt"], most=3)
    assert count == 11 and len(few) == 3
    assert hidden_files(spark, str(tree), [".zst"], recursive=False)[0] == 2


def test_spark_reads_what_is_not_hidden(spark, tree):
    seen = {r["path"].split(f"{tree}/")[1] for r in files.list_files(spark, str(tree), "*.{zst,ZST}").collect()}
    listed = {
        r["path"].removeprefix(f"{tree}/"): r["hidden"]
        for level in walk(spark, str(tree)) for r in level.where("NOT is_folder AND lower(path) LIKE '%.zst'").collect()
    }
    assert seen == {path for path, hidden in listed.items() if not hidden} and len(listed) == len(seen) + len(HIDDEN)


def test_levels_stay_distributed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ENTRY_BATCH", 7)
    for n in range(40):
        (tmp_path / f"f{n}").mkdir()
        for m in range(5):
            (tmp_path / f"f{n}" / f"_{m}.zst").touch()
    assert [level.count() for level in walk(spark, str(tmp_path))] == [40, 200]
    assert hidden_files(spark, str(tmp_path), [".zst"]) == (200, sorted(f"{tmp_path}/f{n}/_{m}.zst" for n in range(40) for m in range(5))[:10])


def test_jobs_refuse_hidden_input(spark, tree, tmp_path):
    with pytest.raises(HiddenFiles, match="10 files below"):
        refuse_hidden(spark, str(tree), [".zst"])
    folder = tmp_path / "parts"
    spark.range(3).write.parquet(str(folder))
    (folder / "_hidden.parquet").write_bytes(b"x")
    with pytest.raises(HiddenFiles, match="_hidden.parquet"):
        merge_folder(spark, str(folder), str(tmp_path / "out"))


def test_no_folder(spark, tmp_path):
    assert hidden_files(spark, str(tmp_path / "none"), [".zst"]) == (0, [])
    (tmp_path / "file.zst").touch()
    refuse_hidden(spark, str(tmp_path / "file.zst"), [".zst"])
