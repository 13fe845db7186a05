"""Model calls that can be stopped and taken up again.

Replies are kept in a store, a shared folder, under the digest of their request. A task
puts every finished batch there before it goes on, so a run that is stopped has lost one
batch per task at most; the next run asks only what the store lacks. What fails stays a
record with its error and is asked again in later runs, up to a number of times.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulletin.sources.files import open_folder

STORE = "digest string, raw string, error string, run string"
_ARROW = pa.schema([(name, pa.string()) for name in ("digest", "raw", "error", "run")])
Call = Callable[[list[str]], list[str | None]]


def request_digest(prompt: Column, task: str = "") -> Column:
    """Identity of a request: the task (model, settings) and the whole prompt."""
    return F.sha2(F.concat(F.lit(f"{task}\n"), prompt), 256)


def stored_replies(spark: SparkSession, store: str) -> DataFrame:
    """Every reply and failure in the store; a store that does not exist yet is empty."""
    system, folder = open_folder(f"{store}/replies")
    system.create_dir(folder, recursive=True)
    return spark.read.schema(STORE).parquet(f"{store}/replies")


def answers(spark: SparkSession, store: str) -> DataFrame:
    """(digest, raw, error, asked): one row per request that was ever asked."""
    return stored_replies(spark, store).groupBy("digest").agg(
        F.min("raw").alias("raw"), F.when(F.min("raw").isNull(), F.max_by("error", "run")).alias("error"), F.count(F.lit(1)).alias("asked")
    )


def _ask(call: Call, prompts: list[str], attempts: int) -> tuple[list[str | None], list[str | None]]:
    replies: list[str | None] = [None] * len(prompts)
    errors: list[str | None] = ["empty reply"] * len(prompts)
    pending = list(range(len(prompts)))
    for _ in range(attempts):
        if not pending:
            break
        try:
            got = call([prompts[i] for i in pending])
        except Exception as problem:  # a failing provider counts as "no reply"
            for i in pending:
                errors[i] = f"{type(problem).__name__}: {problem}"
            continue
        for i, answer in zip(pending, got, strict=True):
            replies[i], errors[i] = (answer, None) if answer else (None, "empty reply")
        pending = [i for i in pending if replies[i] is None]
    return replies, errors


def _asker(call: Call, store: str, run: str, attempts: int, batch: int, per_second: float | None) -> Callable:
    def flush(digests: list[str], prompts: list[str]) -> pa.RecordBatch:
        system, folder = open_folder(f"{store}/replies")
        # A task that runs again makes the same batches, so it finds what it had stored.
        name = f"{folder}/{run}-{hashlib.sha256(''.join(digests).encode()).hexdigest()[:32]}.parquet"
        try:
            with system.open_input_file(name) as stream:
                return pq.read_table(stream).select(["digest"]).combine_chunks().to_batches()[0]
        except FileNotFoundError:
            pass
        started = time.monotonic()
        replies, errors = _ask(call, prompts, attempts)
        rows = pa.table([pa.array(c, pa.string()) for c in (digests, replies, errors, [run] * len(digests))], schema=_ARROW)
        pending = f"{folder}/.{uuid.uuid4().hex}"
        pq.write_table(rows, pending, filesystem=system)
        system.move(pending, name)
        if per_second:
            time.sleep(max(0.0, len(prompts) / per_second - (time.monotonic() - started)))
        return rows.select(["digest"]).to_batches()[0]

    def run_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests: list[str] = []
        prompts: list[str] = []
        for rows in batches:
            for digest, prompt in zip(rows.column("digest").to_pylist(), rows.column("prompt").to_pylist(), strict=True):
                digests.append(digest)
                prompts.append(prompt)
                if len(digests) == batch:
                    yield flush(digests, prompts)
                    digests, prompts = [], []
        if digests:
            yield flush(digests, prompts)

    return run_task


def resumable_call(
    requests: DataFrame, call: Call, key: str, store: str, task: str = "", attempts: int = 2, give_up_after: int = 3,
    tasks: int = 32, batch: int = 64, per_second: float | None = None,
) -> DataFrame:
    """(key, raw, error, asked) of all ``requests`` (key, prompt); what the store has is not asked again.

    Equal prompts are asked once, whoever sends them. ``tasks`` call at the same time, each
    ``per_second`` prompts at most, in batches of ``batch``. A prompt that got no reply in
    ``give_up_after`` runs is a dead letter: its last error stays, and it is not asked again.
    A null prompt is never asked.
    """
    spark = requests.sparkSession
    asked = requests.where(F.col("prompt").isNotNull()).select(key, "prompt", request_digest(F.col("prompt"), task).alias("digest"))
    settled = answers(spark, store).where(F.col("raw").isNotNull() | (F.col("asked") >= give_up_after)).select("digest")
    due = asked.groupBy("digest").agg(F.first("prompt").alias("prompt")).join(settled, "digest", "left_anti")
    # Sorted by digest, a task's batches are the same whenever it runs.
    placed = due.repartition(tasks, "digest").sortWithinPartitions("digest")
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    placed.mapInArrow(_asker(call, store.rstrip("/"), run, attempts, batch, per_second), "digest string").write.format("noop").mode("overwrite").save()
    told = answers(spark, store)
    keyed = requests.select(key, request_digest(F.col("prompt"), task).alias("digest"))
    return keyed.join(told, "digest", "left").select(key, "raw", "error", F.coalesce("asked", F.lit(0).cast("bigint")).alias("asked"))


def dead_letters(requests: DataFrame, store: str, task: str = "", give_up_after: int = 3) -> DataFrame:
    """Requests that are not asked any more, with their last error."""
    told = answers(requests.sparkSession, store).where(F.col("raw").isNull() & (F.col("asked") >= give_up_after))
    return requests.withColumn("digest", request_digest(F.col("prompt"), task)).join(told, "digest")
