"""Exact deduplication over an extendible-hash index on shared files.

Every text gets a hash; the leading bits of the hash are a slot of a directory. A bucket
that holds more than `capacity` distinct hashes splits on its next bit and the directory
doubles when that bit is new. The directory is built from a histogram of at most
2^max_depth counts, whatever the corpus size. Buckets are key ranges: the index is written
in ranges of (bucket, hash), so that one task owns a range. Texts whose hashes collide
chain under one hash and are told apart by their bytes: the combine step groups on the
text itself, before and after the shuffle, so a text that fills a third of all rows
leaves each task once.

Null ids are the smallest and null texts are empty; tied rows keep exactly one. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin.llm.common import int_array, settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Null as empty, A-Z lower-cased, all other characters untouched."""
    text = F.coalesce(text, F.lit(""))
    # lower() equals the translation on plain ASCII and is much faster there.
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def directory(counts: dict[int, int], max_depth: int, capacity: int) -> tuple[int, list[int], dict[int, int]]:
    """Extendible hashing over `counts` by `max_depth`-bit prefix: (global depth, slot -> bucket, bucket -> local depth).

    A bucket is named by its first prefix at full depth. At `max_depth` bits a bucket may
    stay over its capacity; it then simply holds longer chains.
    """
    total = [0] * (2**max_depth + 1)
    for prefix in range(2**max_depth):
        total[prefix + 1] = total[prefix] + counts.get(prefix, 0)
    depth, buckets, waiting = 0, {}, [(0, 0)]
    while waiting:
        first, local = waiting.pop()
        width = 2 ** (max_depth - local)
        if total[first + width] - total[first] > capacity and local < max_depth:
            waiting += [(first, local + 1), (first + width // 2, local + 1)]
            depth = max(depth, local + 1)
        else:
            buckets[first] = local
    slots: list[int] = []
    for first in sorted(buckets):
        slots += [first] * 2 ** (depth - buckets[first])
    return depth, slots, buckets


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 250_000,
    max_depth: int = 16,
    hash_bits: int = 64,
) -> DataFrame:
    """One row per input row: `doc_id, keep_id, group_size, kept, text_sha256, bucket, local_depth, chain_length`.

    Texts are equal when their bytes are, after lower-casing A-Z. The row with the largest
    id stays; among rows that tie on it, the one read first. `chain_length` counts the
    distinct texts that share the row's hash (1 unless hashes collide). `hash_bits` shortens
    the hash, which lengthens chains and changes no other column.
    """
    norm = ascii_lower(F.col(text_col))
    keyed = docs.select(F.col(id_col).alias("doc_id"), norm.alias("_text")).select(
        "doc_id", "_text", F.shiftrightunsigned(F.xxhash64("_text"), 64 - hash_bits).alias("_hash")
    )
    entries = settle(
        keyed.select("doc_id", "_hash", F.sha2("_text", 256).alias("text_sha256"), (-F.monotonically_increasing_id()).alias("_row")),
        "exact-entries",
    )
    bits = min(max_depth, hash_bits)

    def prefix(depth: int) -> Column:
        # A shift by 64 would be a shift by 0.
        return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned("_hash", hash_bits - depth)

    histogram = entries.select(prefix(bits).alias("slot"), "_hash").distinct().groupBy("slot").count()
    depth, slots, buckets = directory({r[0]: r[1] for r in histogram.collect()}, bits, capacity)

    # Bytes decide: rows meet under their hash, and each distinct text of a chain is one row.
    chains = keyed.groupBy("_hash", "_text").agg(F.count("*").alias("group_size"))
    chains = chains.select("_hash", F.sha2("_text", 256).alias("text_sha256"), "group_size")
    chains = chains.groupBy("_hash", "text_sha256").agg(F.sum("group_size").alias("group_size"), F.count("*").alias("_texts"))
    one = F.when(F.col("_texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share hash and digest")))
    keepers = entries.groupBy("_hash", "text_sha256").agg(F.max(F.struct("doc_id", "_row")).alias("_keep"))
    index = (
        chains.withColumn("group_size", one.cast("long"))
        .join(keepers, ["_hash", "text_sha256"])
        .withColumn("bucket", F.element_at(int_array(slots), (prefix(depth) + 1).cast("int")))
        .select("bucket", "_hash", "text_sha256", "group_size", "_keep")
    )
    parts = max(1, min(len(buckets), 4096))
    index = settle(index.repartitionByRange(parts, "bucket", "_hash").sortWithinPartitions("bucket", "_hash", "text_sha256"), "exact-index")
    lengths = index.groupBy("_hash").agg(F.count("*").alias("chain_length")).filter("chain_length > 1")
    # Chains longer than one text are rare; their side is small and settled sizes let Spark choose.
    index = index.join(settle(lengths, "exact-chains"), "_hash", "left")
    local = int_array([buckets[s] for s in slots])
    return entries.join(index, ["_hash", "text_sha256"]).select(
        "doc_id",
        F.col("_keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_keep._row")).alias("kept"),
        "text_sha256",
        "bucket",
        F.element_at(local, (prefix(depth) + 1).cast("int")).cast("int").alias("local_depth"),
        F.coalesce("chain_length", F.lit(1)).cast("long").alias("chain_length"),
    )
