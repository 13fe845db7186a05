"""The decision log and stored files as data sources."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bulletin.operators import decisions as dec
from bulletin.sources import decision_log as logs
from bulletin.sources import issue_files, sinks

ITEMS = "notice_id int, section string, title string, keep boolean, reason string, stage string, url string"


def log_of(spark, n, section="教务通知"):
    rows = [(i, section if i % 3 else None, f"标题 {i}", i % 2 == 0, "publish_recent" if i % 4 else None, "s", None) for i in range(n)]
    return dec.decisions(spark.createDataFrame(rows, ITEMS).repartition(3), F.create_map(F.lit("id"), F.col("notice_id").cast("string"), F.lit("empty"), F.lit(None)), "t")


def ids(df):
    return sorted(int(r.details["id"]) for r in df.collect())


def test_a_run_that_is_repeated_leaves_one_set(spark, tmp_path):
    path = str(tmp_path / "log")
    logs.commit_decisions(log_of(spark, 9), path, "2026-04-20")
    logs.commit_decisions(log_of(spark, 5), path, "2026-04-27")
    logs.commit_decisions(log_of(spark, 7), path, "2026-04-20")
    back = logs.read_decisions(spark, path)
    assert back.columns == [c.split(" ")[0] for c in logs.SCHEMA.split(", ")]
    assert ids(back.where("run_id = '2026-04-20'")) == list(range(7)) and ids(back.where("run_id = '2026-04-27'")) == list(range(5))
    want = {tuple(r) for r in log_of(spark, 7).select("time", "section", "title", "status", "reason", "stage", "date", "url", "source").collect()}
    assert {tuple(r)[1:-1] for r in back.where("run_id = '2026-04-20'").collect()} == want
    assert back.first().details["empty"] is None
    # What the first attempt wrote is gone, and nothing else lies about.
    named = [f for m in Path(path, "runs").iterdir() for f in json.loads(m.read_text())["files"]]
    assert sorted(p.name for p in Path(path, "records").iterdir()) == sorted(named)


def test_a_failed_run_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    logs.commit_decisions(log_of(spark, 6), path, "a")
    boom = F.when(F.col("title") == "标题 5", F.raise_error(F.lit("stop"))).otherwise(F.col("title"))
    with pytest.raises(Exception, match="stop"):
        logs.commit_decisions(log_of(spark, 50).withColumn("title", boom), path, "a")
    with pytest.raises(Exception, match="stop"):
        logs.commit_decisions(log_of(spark, 50).withColumn("title", boom), path, "b")
    assert ids(logs.read_decisions(spark, path)) == list(range(6))


def test_files_without_a_manifest_do_not_count(spark, tmp_path):
    path = str(tmp_path / "log")
    logs.commit_decisions(log_of(spark, 4), path, "a")
    stray = next(Path(path, "records").iterdir())
    (Path(path, "records") / "b-stray.parquet").write_bytes(stray.read_bytes())
    assert ids(logs.read_decisions(spark, path)) == list(range(4))


def test_an_empty_run_and_an_absent_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert logs.read_decisions(spark, path).count() == 0
    logs.commit_decisions(log_of(spark, 0), path, "a")
    assert logs.read_decisions(spark, path).count() == 0
    with pytest.raises(Exception, match="run_id"):
        logs.commit_decisions(log_of(spark, 1), path, "a/b")


def test_a_filter_on_the_run_reads_its_files_only(tmp_path):
    reader = logs.LogReader(str(tmp_path))
    logs.publish_json(f"{tmp_path}/runs/a.json", f"{tmp_path}/pending/a", {"files": ["a1", "a2"]})
    logs.publish_json(f"{tmp_path}/runs/b.json", f"{tmp_path}/pending/b", {"files": ["b1"]})
    assert [p.file for p in reader.partitions()] == ["a1", "a2", "b1"]
    other = logs.EqualTo(("status",), "kept")
    assert list(reader.pushFilters([logs.EqualTo(("run_id",), "b"), other])) == [other]
    assert [p.file for p in reader.partitions()] == ["b1"]


def stored(spark, folder):
    rows = [
        ("x/issue_20260412_2359.md", b"# early"), ("x/issue_20260413_0000_raw.md", "# 教务".encode()), ("y/issue_20260420_0830.md", b"\xff\xfe"),
        ("y/other_20260420_0830.md", b"other"), ("y/issue_20261340_0000.md", b"no such day"), ("z/issue_20260421_0830.md", b""), ("z/note.txt", b"skipped"),
    ]
    sinks.write_named_files(spark.createDataFrame(rows, "name string, data binary"), str(folder))
    return str(folder)


def test_one_row_per_file_and_an_error_for_a_broken_one(spark, tmp_path):
    files = issue_files.read_issue_files(spark, stored(spark, tmp_path / "in"))
    got = {r.doc_path.rsplit("/", 1)[1]: r for r in files.collect()}
    assert len(got) == 6 and got["issue_20260421_0830.md"].text == "" and got["issue_20260421_0830.md"].error is None
    assert got["issue_20260413_0000_raw.md"].text == "# 教务" and got["issue_20260413_0000_raw.md"].issue_ts == dt.datetime(2026, 4, 13)
    broken = got["issue_20260420_0830.md"]
    assert broken.text is None and "UnicodeDecodeError" in broken.error and broken.n_bytes == 2
    assert got["other_20260420_0830.md"].issue_ts is None and got["issue_20261340_0000.md"].issue_ts is None
    assert issue_files.read_issue_files(spark, str(tmp_path / "absent")).count() == 0


def test_a_filter_on_the_time_opens_no_other_file(spark, tmp_path):
    folder = stored(spark, tmp_path / "in")
    files = issue_files.read_issue_files(spark, folder)
    since = files.where(F.col("issue_ts") >= F.lit("2026-04-13").cast("timestamp_ntz"))
    assert sorted(r.issue_ts.day for r in since.collect()) == [13, 20, 21]
    reader = issue_files.IssueFilesReader(folder, "issue", ".md")
    assert not list(reader.pushFilters([issue_files.GreaterThanOrEqual(("issue_ts",), dt.datetime(2026, 4, 13)), issue_files.LessThan(("issue_ts",), dt.datetime(2026, 4, 21))]))
    assert sorted(f[1].day for g in reader.partitions() for f in g.files) == [13, 20]


def test_small_files_share_a_task(monkeypatch):
    monkeypatch.setattr(issue_files, "TASK_BYTES", 10)
    monkeypatch.setattr(issue_files, "TASK_FILES", 3)
    sizes = [4, 5, 2, 50, 1, 1, 1, 1]
    assert [[f[2] for f in g.files] for g in issue_files.in_groups([("p", None, s) for s in sizes])] == [[4, 5], [2], [50], [1, 1, 1], [1]]
