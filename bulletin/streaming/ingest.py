"""Incremental ingest of account articles: every run reads only the files that are new.

Files of article rows land in a folder; a stream keeps the first copy of every article
within a week, and each micro-batch goes through the same batch operators as a full run.
The stream's progress and the keys it remembers lie in its checkpoint folder, so a run
that was stopped goes on where it was, and a micro-batch that is repeated replaces its own
output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from bulletin import rules
from bulletin.functions.dates import Clock
from bulletin.operators.decisions import decisions
from bulletin.operators.dedup import article_key
from bulletin.plans.issue import judged_articles

JUDGED = "judged"


def landed(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """The files of a folder as a stream, oldest first, at most ``files_per_batch`` in one micro-batch."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(path)


def seen_at(fetched: str = "fetched_at") -> Column:
    """An article's time: when it was published, else fetched, and never after it was fetched.

    A feed that dates an article years ahead thus cannot push the watermark past all others.
    """
    published = F.timestamp_seconds(F.nullif(F.col("publish_ts"), F.lit(0)))
    return F.least(F.coalesce(published, F.col(fetched)), F.col(fetched))


def first_copies(articles: DataFrame, fetched: str = "fetched_at", days: int = rules.ISSUE_DAYS) -> DataFrame:
    """The first copy to arrive of every article (dedupe key), among those of the last ``days`` days.

    State is one key per article of that span, spread by key. What arrives after the
    watermark, a copy or not, is older than any issue looks back and is left out. Copies that
    arrive in one micro-batch are told apart by nothing, so any one of them stays; articles
    without a key go, as in a full run.
    """
    keyed = articles.withColumns({"dedupe_key": article_key(), "event_time": seen_at(fetched)})
    timed = keyed.where(F.col("dedupe_key").isNotNull() & F.col("event_time").isNotNull())
    return timed.withWatermark("event_time", f"{days} days").dropDuplicatesWithinWatermark(["dedupe_key"])


def _write_batch(target: str, clock: Clock) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        judged = judged_articles(batch.drop("event_time"), clock).withColumn("batch_id", F.lit(batch_id))
        judged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{target}/{JUDGED}")

    return write


def ingest(articles: DataFrame, target: str, checkpoint: str, clock: Clock, fetched: str = "fetched_at") -> StreamingQuery:
    """Judge all articles that have landed since the last call, then stop.

    ``articles`` is a stream; ``target`` and ``checkpoint`` are shared folders that belong
    together. Every article is written once, with the decision that ended its way.
    """
    copies = first_copies(articles, fetched)
    started = copies.writeStream.foreachBatch(_write_batch(target, clock)).option("checkpointLocation", checkpoint)
    return started.outputMode("append").trigger(availableNow=True).start()


def ingested(spark: SparkSession, target: str) -> DataFrame:
    """All articles judged so far."""
    return spark.read.parquet(f"{target}/{JUDGED}")


def ingested_items(spark: SparkSession, target: str) -> DataFrame:
    return ingested(spark, target).where("keep").drop("keep", "reason", "stage", "batch_id")


def ingested_decisions(spark: SparkSession, target: str, time: str = "") -> DataFrame:
    """The decision log of the same rows, so that items and log cannot disagree."""
    return decisions(ingested(spark, target).withColumnRenamed("account", "source"), time=time)
