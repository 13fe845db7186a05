"""Calls that are stopped, fail, or are asked twice."""

from pathlib import Path

import pytest

from bulletin.operators import calls

PROMPTS = [(i, f"问题 {i % 17}") for i in range(40)] + [(90, None)]


def requests(spark, rows=PROMPTS):
    return spark.createDataFrame(rows, "notice_id int, prompt string").repartition(3)


def counting(folder):
    """A provider that notes every prompt it is asked in a file of its own."""
    import uuid

    def call(prompts):
        (Path(folder) / uuid.uuid4().hex).write_text("\n".join(prompts))
        return [None if p.endswith(" 5") else f"答 {p}" for p in prompts]

    return call


def asked(folder):
    return sorted(p for f in Path(folder).iterdir() for p in f.read_text().split("\n"))


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "seen").mkdir()
    return str(tmp_path / "seen"), str(tmp_path / "store")


def test_each_prompt_is_asked_once_over_runs(spark, folders):
    seen, store = folders
    first = calls.resumable_call(requests(spark, PROMPTS[:8]), counting(seen), "notice_id", store, attempts=1, tasks=2, batch=3)
    assert {r.notice_id: r.raw for r in first.collect()} == {i: None if i == 5 else f"答 {p}" for i, p in PROMPTS[:8]}
    got = {r.notice_id: (r.raw, r.error, r.asked) for r in calls.resumable_call(requests(spark), counting(seen), "notice_id", store, attempts=1, tasks=2, batch=3).collect()}
    assert got == {i: (None, None, 0) if p is None else (None, "empty reply", 2) if i % 17 == 5 else (f"答 {p}", None, 1) for i, p in PROMPTS}
    assert asked(seen) == sorted([f"问题 {i}" for i in range(17)] + ["问题 5"])


def test_a_run_that_is_stopped_goes_on_where_it_was(spark, folders):
    seen, store = folders
    provider = counting(seen)

    def stops(prompts):
        if any(p.endswith((" 11", " 3")) for p in prompts):
            raise SystemExit("executor lost")
        return provider(prompts)

    with pytest.raises(Exception):
        calls.resumable_call(requests(spark), stops, "notice_id", store, attempts=1, tasks=1, batch=2)
    before = asked(seen)
    got = calls.resumable_call(requests(spark), provider, "notice_id", store, attempts=1, tasks=1, batch=2).collect()
    assert len(got) == len(PROMPTS) and 0 < len(before) < 17
    twice = [p for p in asked(seen) if asked(seen).count(p) > 1]
    assert set(twice) <= {"问题 5"} and set(asked(seen)) == {p for _, p in PROMPTS if p}


def test_failures_keep_their_error_and_become_dead_letters(spark, folders):
    _, store = folders

    def down(prompts):
        raise ConnectionError("offline")

    for n in (1, 2, 2):
        got = calls.resumable_call(requests(spark), down, "notice_id", store, give_up_after=2).where("notice_id < 40").collect()
        assert {(r.raw, r.error, r.asked) for r in got} == {(None, "ConnectionError: offline", n)}
    assert calls.dead_letters(requests(spark), store, give_up_after=2).count() == 40
    other = calls.resumable_call(requests(spark), lambda prompts: ["好"] * len(prompts), "notice_id", store, task="another model")
    assert {r.raw for r in other.where("notice_id < 40").collect()} == {"好"}


def test_a_task_that_runs_again_reads_what_it_had_stored(spark, folders):
    seen, store = folders
    import pyarrow as pa

    rows = pa.RecordBatch.from_pydict({"digest": list("abcde"), "prompt": [f"问题 {c}" for c in "abcde"]})
    calls.stored_replies(spark, store)
    task = calls._asker(counting(seen), store, "run", 1, 2, None)
    first, again = ([b.column("digest").to_pylist() for b in task(iter([rows]))] for _ in range(2))
    assert first == again == [["a", "b"], ["c", "d"], ["e"]] and len(asked(seen)) == 5


def test_the_rate_is_kept(spark, folders):
    import time

    import pyarrow as pa

    _, store = folders
    calls.stored_replies(spark, store)
    task = calls._asker(lambda prompts: ["x"] * len(prompts), store, "run", 1, 2, 20.0)
    started = time.monotonic()
    list(task(iter([pa.RecordBatch.from_pydict({"digest": list("abcd"), "prompt": list("abcd")})])))
    assert time.monotonic() - started >= 0.2
