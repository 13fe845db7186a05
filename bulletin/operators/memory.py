"""What earlier issues printed: a history of titles, partitioned by run date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulletin.functions.text import title_key

HISTORY = "title_key string, section string, title string, run_date date"
#: How many days back an issue remembers.
MEMORY_DAYS = 28


def remember(items: DataFrame, path: str, run_date: str) -> None:
    """Add the printed items of a run; writing a run date again replaces that date alone."""
    rows = items.select(title_key(F.col("title")).alias("title_key"), "section", "title", F.lit(run_date).cast("date").alias("run_date"))
    rows.where(F.col("title_key") != "").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)


def history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY).parquet(path)


def remembered(titles: DataFrame, issues: DataFrame, days: int = MEMORY_DAYS) -> DataFrame:
    """(issue_date, title_key) of what the runs of the last ``days`` days before each issue printed.

    The history is joined on its partition column, so the issues' dates prune its folders
    before any file is opened, and work does not grow with the age of the history.
    """
    back = F.sequence(F.date_sub("issue_date", F.lit(days)), F.date_sub("issue_date", F.lit(1)))
    runs = issues.select("issue_date", F.explode(back).alias("run_date")).where(F.col("run_date") < F.col("issue_date"))
    return titles.join(runs, "run_date").select("issue_date", "title_key").distinct()


def drop_remembered(items: DataFrame, seen: DataFrame) -> DataFrame:
    """Items (with ``issue_date``) whose title no earlier issue printed; adds ``title_key``."""
    return items.withColumn("title_key", title_key(F.col("title"))).join(seen, ["issue_date", "title_key"], "left_anti")
