"""The decision log as a transactional data source.

Every task writes its records to a file of its own and reports the name; the driver then
publishes one manifest per run, which names the files that count. So a task that fails or
runs twice adds nothing, a run that is repeated replaces what it wrote before, and a
reader never sees half a run. Manifests are found by run, so a filter on the run reads
those files only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from bulletin.sources.files import list_files, open_folder, publish_json, read_bytes

FORMAT = "bulletin_decision_log"
SCHEMA = (
    "run_id string, time string, section string, title string, status string, reason string, stage string, "
    "date string, url string, source string, details map<string,string>"
)
RECORDS, RUNS, PENDING = "records", "runs", "pending"


@dataclass
class Written(WriterCommitMessage):
    file: str
    records: int


class LogWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run: str):
        self.path, self.run = path.rstrip("/"), run

    def _manifest(self) -> str:
        return f"{self.path}/{RUNS}/{self.run}.json"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = open_folder(f"{self.path}/{RECORDS}")
        system.create_dir(folder, recursive=True)
        name, records, out = f"{self.run}-{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if batch.num_rows:
                    out = out or pq.ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=system)
                    out.write_batch(batch)
                    records += batch.num_rows
        finally:
            if out:
                out.close()
        return Written(name if records else "", records)

    def commit(self, messages: list[Written | None]) -> None:
        before = _files_of(self._manifest())
        files = sorted(m.file for m in messages if m and m.file)
        value = {"run_id": self.run, "files": files, "records": sum(m.records for m in messages if m)}
        publish_json(self._manifest(), f"{self.path}/{PENDING}/{self.run}-{uuid.uuid4().hex}.json", value)
        self._remove(before)

    def abort(self, messages: list[Written | None]) -> None:
        self._remove([m.file for m in messages if m and m.file])

    def _remove(self, files: list[str]) -> None:
        """Files that no manifest names; one that is already gone is no error."""
        system, folder = open_folder(f"{self.path}/{RECORDS}")
        for name in files:
            try:
                system.delete_file(f"{folder}/{name}")
            except FileNotFoundError:
                continue


def _files_of(manifest: str) -> list[str]:
    try:
        return json.loads(read_bytes(manifest))["files"]
    except FileNotFoundError:
        return []


@dataclass
class LogFile(InputPartition):
    file: str


class LogReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.wanted = path.rstrip("/"), None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            runs = {EqualTo: lambda f=f: {f.value}, In: lambda f=f: set(f.value)}.get(type(f))
            if runs and f.attribute == ("run_id",):
                self.wanted = runs() if self.wanted is None else self.wanted & runs()
            else:
                yield f

    def partitions(self) -> list[LogFile]:
        names = [f.path for f in list_files(f"{self.path}/{RUNS}") if f.path.endswith(".json")]
        runs = [n for n in names if self.wanted is None or n.rsplit("/", 1)[-1].removesuffix(".json") in self.wanted]
        system, folder = open_folder(f"{self.path}/{RUNS}")
        found = []
        for run in runs:
            with system.open_input_stream(run) as stream:
                found += [LogFile(name) for name in json.loads(stream.read())["files"]]
        return found

    def read(self, partition: LogFile) -> Iterator[pa.RecordBatch]:
        if partition is None or not partition.file:
            return
        system, folder = open_folder(f"{self.path}/{RECORDS}")
        with system.open_input_file(f"{folder}/{partition.file}") as stream:
            yield from pq.ParquetFile(stream).iter_batches(columns=[c.split(" ")[0] for c in SCHEMA.split(", ")])


class DecisionLog(DataSource):
    """Options: ``path``, a shared folder; ``run_id``, needed to write."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogReader:
        return LogReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> LogWriter:
        run = self.options.get("run_id", "")
        if not run or "/" in run:
            raise ValueError("a decision log is written under the option run_id, a name without slashes")
        return LogWriter(self.options["path"], run)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DecisionLog)


def commit_decisions(log: DataFrame, path: str, run_id: str) -> None:
    """Write the records of one run; writing the same run again replaces them."""
    register(log.sparkSession)
    rows = log.withColumn("run_id", F.lit(run_id)).select(*[c.split(" ")[0] for c in SCHEMA.split(", ")])
    rows.write.format(FORMAT).option("path", path).option("run_id", run_id).mode("append").save()


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """The records of all committed runs."""
    register(spark)
    return spark.read.format(FORMAT).option("path", path).load()
