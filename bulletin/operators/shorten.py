"""Summaries and bodies within the digest's budget."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bulletin.functions.text import compress_body, item_summary, summary_repeats


def shorten(df: DataFrame) -> DataFrame:
    """Add ``summary``, shorten ``content``, and say whether the summary is worth showing."""
    staged = df if "summary" in df.columns else df.withColumn("summary", item_summary(F.col("content")))
    body = compress_body(F.col("content"), F.col("summary"), F.col("section"))
    return staged.withColumn("content", body).withColumn(
        "show_summary",
        (F.col("summary") != "") & ~summary_repeats(F.col("summary"), F.col("content")),
    )
