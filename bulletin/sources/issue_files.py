"""Digest and feed files as a data source: one row per file, with the time its name tells.

Files are listed once, on the driver; tasks open them. A filter on the issue time is
decided by the name, so other files are not opened. A file that cannot be read as text is
a row too, with its error in place of the text, and does not end the run.
"""

from __future__ import annotations

import datetime as dt
import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from bulletin.sources.files import list_files, open_folder

FORMAT = "bulletin_issue_files"
SCHEMA = "doc_path string, issue_ts timestamp_ntz, n_bytes bigint, text string, error string"
ARROW = pa.schema(
    [("doc_path", pa.string()), ("issue_ts", pa.timestamp("us")), ("n_bytes", pa.int64()), ("text", pa.string()), ("error", pa.string())]
)
COMPARE = {
    EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le,
}
#: Small files share a task up to this many bytes; a larger one has its own.
TASK_BYTES, TASK_FILES = 32 << 20, 1024


@dataclass
class FileGroup(InputPartition):
    files: list[tuple[str, dt.datetime | None, int]] = field(default_factory=list)


def time_of(path: str, prefix: str) -> dt.datetime | None:
    """The time in ``<prefix>_yyyymmdd_hhmm[_raw].md``, else None."""
    found = re.fullmatch(rf"{re.escape(prefix)}_(\d{{8}}_\d{{4}})(?:_raw)?\.md", path.rsplit("/", 1)[-1], re.ASCII)
    try:
        return dt.datetime.strptime(found[1], "%Y%m%d_%H%M") if found else None
    except ValueError:
        return None


def in_groups(files: list[tuple[str, dt.datetime | None, int]]) -> list[FileGroup]:
    groups, size = [FileGroup()], 0
    for f in files:
        own = groups[-1].files
        if own and (size + f[2] > TASK_BYTES or len(own) == TASK_FILES):
            groups.append(FileGroup())
            own, size = groups[-1].files, 0
        own.append(f)
        size += f[2]
    return [g for g in groups if g.files]


class IssueFilesReader(DataSourceReader):
    def __init__(self, path: str, prefix: str, suffix: str):
        self.path, self.prefix, self.suffix, self.tests = path, prefix, suffix, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if type(f) in COMPARE and f.attribute == ("issue_ts",):
                self.tests.append((COMPARE[type(f)], f.value.replace(tzinfo=None)))
            else:
                yield f

    def partitions(self) -> list[FileGroup]:
        dated = [(f.path, time_of(f.path, self.prefix), f.size) for f in list_files(self.path) if f.path.endswith(self.suffix)]
        wanted = [f for f in dated if all(f[1] is not None and test(f[1], value) for test, value in self.tests)]
        return in_groups(wanted) or [FileGroup()]

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(self.path)
        for path, at, size in partition.files:
            text, error = None, None
            try:
                with system.open_input_stream(path) as stream:
                    text = stream.read().decode("utf-8")
            except (OSError, UnicodeDecodeError) as e:
                error = f"{type(e).__name__}: {e}"
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((path, at, size, text, error), ARROW.types)], schema=ARROW)


class IssueFiles(DataSource):
    """Options: ``path``, a shared folder; ``prefix`` of names that tell a time; ``suffix`` of the files to read."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> IssueFilesReader:
        return IssueFilesReader(self.options["path"], self.options.get("prefix", "issue"), self.options.get("suffix", ".md"))


def read_issue_files(spark: SparkSession, path: str, prefix: str = "issue", suffix: str = ".md") -> DataFrame:
    """documents(doc_path, issue_ts, n_bytes, text, error) of all files below a folder."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(IssueFiles)
    return spark.read.format(FORMAT).option("path", path).option("prefix", prefix).option("suffix", suffix).load()
