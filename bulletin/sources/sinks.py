"""Writers. Output is partitioned files, never a driver-side log."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bulletin.sources.files import write_bytes


def write_decisions(log: DataFrame, path: str, run_date: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """Append-only decision log, one folder per run date; rerunning a date replaces that date."""
    stamped = log.withColumn("run_date", F.lit(run_date))
    (
        stamped.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .format(fmt)
        .save(path)
    )


def write_items(items: DataFrame, path: str, mode: str = "overwrite") -> None:
    items.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_document(blocks: DataFrame, path: str, order: list[str], text: str = "text", mode: str = "overwrite") -> None:
    """Blocks of a rendered document as ordered text files: read in name order they are the document."""
    blocks.repartitionByRange(*order).sortWithinPartitions(*order).select(text).write.mode(mode).option(
        "lineSep", "\n\n"
    ).text(path)


def write_named_files(files: DataFrame, folder: str) -> None:
    """One file per row of (name, data binary) below a shared folder; a row that is written twice is the same file."""

    def run(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name, data in zip(batch.column("name").to_pylist(), batch.column("data").to_pylist(), strict=True):
                    write_bytes(f"{folder}/{name}", data or b"")
                yield batch.select(["name"])

        return write

    files.select("name", "data").mapInArrow(run(folder.rstrip("/")), "name string").write.format("noop").mode("overwrite").save()
