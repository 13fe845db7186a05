"""Deterministic sharded WARC writing, and reading back.

Records are put in the order of (page id, payload digest) and cut into shards of about
`shard_bytes` of payload at exact running totals, so that shard bounds depend on the data
alone, not on samples or partitions. One task writes a shard: it streams its sorted
records into gzip members, rolls to a new file at `roll_bytes` compressed, regenerates all
headers and digests, writes under a temporary name and moves the finished file to its
final name. The rows that the tasks return are the manifest, which Spark commits; a reader
opens listed files only, so files of failed or doubled attempts do no harm, and a repeated
attempt writes the same bytes.

Of records with equal payloads (equal SHA-1 and length, of `min_bytes` at least) the one
with the largest page id is the response and the others revisit it. Which they are comes
from a narrow pass over digests and is merged into the sorted stream, so a payload is
shuffled once. Paths are opened by `pyarrow.fs`, on executors and driver alike.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulletin.llm.common import fresh_path, running, settle

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard long, records long, bytes long, sha256 string"
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, warc_file string"
)


def sort_key(page_id: Column, sha1: Column) -> Column:
    """A string whose order is that of (page id, digest); null ids come first."""
    shifted = (page_id.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string")
    return F.concat(F.coalesce(F.lpad(shifted, 20, F.lit("0")), F.lit("-" * 20)), sha1)


def shard_bounds(narrow: DataFrame, shard_bytes: int) -> list[str]:
    """The first key of every shard but the first. Their number is total bytes over `shard_bytes`."""
    keys = settle(narrow.groupBy("key").agg(F.sum("size").alias("size")), "warc-keys")
    total = running(keys, [F.col("key")], F.col("size"), "warc-order")
    shards = total.groupBy(F.floor(F.col("before") / shard_bytes).alias("shard")).agg(F.min("key").alias("key"))
    return sorted({r["key"] for r in shards.filter("shard > 0").collect()})


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def header_value(text: str) -> str:
    """One line: control characters and spaces are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_id(page_id: int | None, digest: str, nth: int) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}:{nth}>"


def render(page_id: int | None, url: str | None, payload: bytes, nth: int, revisit: bool, refers_to: int | None, date: str) -> bytes:
    digest = base32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest, nth)}",
        f"WARC-Date: {date}",
        # A page without an address is recorded without one.
        *([] if url is None else [f"WARC-Target-URI: {header_value(url)}"]),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest, 0)}"] if revisit else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member without a time stamp."""
    out = io.BytesIO()
    with gzip.GzipFile("", "wb", 6, out, mtime=0) as z:
        z.write(data)
    return out.getvalue()


class ShardFiles:
    """The files of one shard, written under a temporary name each and moved when finished."""

    def __init__(self, folder: str, shard: int, roll_bytes: int) -> None:
        self.store, self.path = fs.FileSystem.from_uri(folder)
        self.shard, self.roll, self.made, self.out = shard, roll_bytes, 0, None

    def add(self, data: bytes) -> dict | None:
        """The manifest row of the file that `data` filled."""
        if self.out is None:
            self.temporary = f"{self.path}/_temporary-{uuid.uuid4().hex}"
            self.out, self.records, self.size, self.sha = self.store.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
        self.out.write(data)
        self.sha.update(data)
        self.records += 1
        self.size += len(data)
        return self.close() if self.size >= self.roll else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        name = f"part-{self.shard:06d}-{self.made:04d}.warc.gz"
        self.made += 1
        self.store.move(self.temporary, f"{self.path}/{name}")
        return {"file": name, "shard": self.shard, "records": self.records, "bytes": self.size, "sha256": self.sha.hexdigest()}


def _write(folder: str, roll_bytes: int, date: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, key, nth, role = None, None, 0, None
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                if files is None or files.shard != row.shard:
                    rows.append(files.close() if files else None)
                    files = ShardFiles(folder, row.shard, roll_bytes)
                if row.key != key:
                    key, nth, role = row.key, 0, None
                ident = None if pd.isna(row.page_id) else int(row.page_id)
                if row.kind == 0:
                    role = (ident,)
                    continue
                # A role row names the response of the equal payloads; without one the payload is alone.
                revisit = role is not None and (nth > 0 or role[0] != ident)
                data = render(ident, row.url, (row.html or "").encode("utf-8"), nth, revisit, role[0] if revisit else None, date)
                rows.append(files.add(member(data)))
                nth += 1
            yield pd.DataFrame([r for r in rows if r], columns=["file", "shard", "records", "bytes", "sha256"])
        if files and (row := files.close()):
            yield pd.DataFrame([row])

    return run


@dataclass
class Archive:
    """A written archive: its folder and the folder of the committed manifest."""

    folder: str
    manifest: str

    def files(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(MANIFEST).parquet(self.manifest)


def write_warc(
    pages: DataFrame, folder: str | None = None, shard_bytes: int = 32 << 20, roll_bytes: int = 8 << 20, min_bytes: int = 0,
    date: str = "2026-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> Archive:
    """Write one record per row and commit the manifest. Null payloads are empty.

    Rows of one id and payload are told apart by their position among themselves; the first
    of the response's id is the response. An empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    payload = F.coalesce(F.col(html_col), F.lit(""))
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("html"))
    narrow = base.select("page_id", F.sha1(F.col("html").cast("binary")).alias("sha1"), F.octet_length("html").cast("long").alias("size"))
    narrow = settle(narrow.withColumn("key", sort_key(F.col("page_id"), F.col("sha1"))), "warc-digests")
    groups = narrow.groupBy("sha1", "size").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    groups = settle(groups.filter((F.col("n") > 1) & (F.col("size") >= min_bytes)), "warc-groups")
    roles = narrow.join(groups, ["sha1", "size"]).select("key", F.col("first").alias("page_id")).distinct()
    bounds = shard_bounds(narrow, shard_bytes)
    shared = spark.sparkContext.broadcast(bounds)

    @F.pandas_udf("long")
    def shard_of(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: bisect.bisect_right(shared.value, k)).astype("int64")

    text = F.lit(None).cast("string")
    rows = roles.select("key", F.lit(0).alias("kind"), "page_id", text.alias("url"), text.alias("html")).unionByName(
        base.select(sort_key(F.col("page_id"), F.sha1(F.col("html").cast("binary"))).alias("key"), F.lit(1).alias("kind"), "page_id", "url", "html")
    )
    rows = rows.withColumn("shard", shard_of("key"))
    # By number rather than by hash: every shard is a task of its own.
    laid = rows.repartitionById(len(bounds) + 1, F.col("shard").cast("int")).sortWithinPartitions("shard", "key", "kind", "url")
    manifest = f"{folder}/manifest"
    laid.mapInPandas(_write(folder, roll_bytes, date), MANIFEST).write.parquet(manifest)
    return Archive(folder, manifest)


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record."""
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("a record ends early")
        yield headers, block


def parse(headers: dict[str, str], block: bytes, name: str) -> tuple:
    """A row of RECORD; digests of the block and of a response's payload are checked."""
    if headers["warc-block-digest"] != f"sha1:{base32(hashlib.sha1(block).digest())}":
        raise ValueError(f"block digest differs in {name}: {headers['warc-record-id']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    kind = headers["warc-type"]
    if kind == "response" and (len(payload) != size or base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"payload digest differs in {name}: {headers['warc-record-id']}")
    number = lambda urn: int(urn.split(":")[2]) if urn and urn.split(":")[2] else None
    return (number(headers["warc-record-id"]), headers.get("warc-target-uri"), size, digest, kind, number(headers.get("warc-refers-to")), name)


def read_warc(spark: SparkSession, archive: Archive) -> DataFrame:
    """The records of an archive's listed files, RECORD; one task streams whole files."""
    folder = archive.folder

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = fs.FileSystem.from_uri(folder)
        names = [c.split()[0] for c in RECORD.split(", ")]
        kinds = {"page_id": "Int64", "refers_to": "Int64"}
        for batch in batches:
            for name in batch["file"]:
                rows = []
                with store.open_input_stream(f"{path}/{name}", compression=None) as source:
                    for headers, block in records(io.BufferedReader(gzip.GzipFile(fileobj=source), 1 << 16)):
                        rows.append(parse(headers, block, name))
                        if len(rows) == 10_000:
                            yield pd.DataFrame(rows, columns=names).astype(kinds)
                            rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names).astype(kinds)

    files = archive.files(spark).select("file")
    # Small rows that name large files: dealt out one by one.
    n = max(1, files.count())
    return files.repartition(min(n, 10_000)).mapInPandas(run, RECORD)
