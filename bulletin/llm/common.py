"""Shared folder, settled tables, exact distributed numbering and small column helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    Only a local session, whose executors are this process, gets a temporary one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage is cut and its size is known."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and hand it to `use`."""
    return F.element_at(F.transform(F.array(value), use), 1)


def int_array(values: list[int]) -> Column:
    """A constant array, folded once by the optimizer rather than built from one expression per value."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def running(df: DataFrame, keys: list[Column], size: Column, name: str, part_rows: int = 1 << 18) -> DataFrame:
    """Add `before`, the exact sum of `size` over all rows that precede in the order of `keys`, without a one-task sort.

    Rows are range-partitioned into about one range per `part_rows` rows and settled; the
    totals of the ranges become offsets. Ties within `keys` are taken in any order, so keys
    that tell rows apart make the result a function of the data.
    """
    parts = max(1, -(-df.count() // part_rows))
    laid = df.withColumn("_size", size.cast("long")).repartitionByRange(parts, *keys)
    laid = settle(laid.withColumn("_part", F.spark_partition_id()), name)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = laid.groupBy("_part").agg(F.sum("_size").alias("_sum")).select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return (
        laid.withColumn("_in", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
        .join(offsets, "_part")
        .withColumn("before", (F.col("_offset") + F.col("_in")).cast("long"))
        .drop("_part", "_in", "_offset", "_size")
    )


def numbered(df: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """Add `ordinal`, the exact 0-based position in the order of `keys`."""
    return running(df, keys, F.lit(1), name).withColumnRenamed("before", "ordinal")
