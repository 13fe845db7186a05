"""Sharding by extendible hashing.

A row's key is a 60-bit hash; a shard is a hash prefix. The root shard splits on another
bit wherever it is over the byte limit, and only there, until every shard fits. Prefix
histograms are summed in rounds of `step` bits: each round sums the bytes of the prefixes
still over the limit, and of all their ancestors within the round, so that one aggregate
does the work of `step` splits. The directory stays a table at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from bulletin.llm.common import running, settle

HASH_BITS = 60


def shard_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """First 60 bits of the MD5 of the id; rows without an id are keyed by their text."""
    ident = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    return F.conv(F.substring(F.md5(ident), 1, 15), 16, 10).cast("long")



def shard_directory(keyed: DataFrame, max_bytes: int, step: int = 12) -> DataFrame:
    """Leaves of the directory: `depth, prefix, shard_bytes, shard_docs`.

    `keyed` has `_key` and `_bytes`. A prefix is a leaf when it fits the limit or holds a
    single key, and no ancestor is a leaf. Rows that share one key cannot be told apart by
    more bits: such a leaf may be over the limit, see `paged`.
    """
    sizes = settle(keyed.groupBy("_key").agg(F.sum("_bytes").alias("_bytes"), F.count("*").alias("_docs")), "shard-keys")
    leaves, waiting, base = None, sizes, 0
    while base < HASH_BITS:
        end = min(base + step, HASH_BITS)
        fine = waiting.groupBy(F.expr(f"shiftright(_key, {HASH_BITS - end})").alias("_fine")).agg(
            F.sum("_bytes").alias("_bytes"), F.sum("_docs").alias("_docs"), F.min("_key").alias("_lo"), F.max("_key").alias("_hi")
        )
        nodes = (
            fine.select("*", F.explode(F.sequence(F.lit(base), F.lit(end))).alias("depth"))
            .groupBy("depth", F.expr(f"shiftright(_fine, {end} - depth)").alias("prefix"))
            .agg(
                F.sum("_bytes").alias("shard_bytes"),
                F.sum("_docs").alias("shard_docs"),
                F.min("_lo").alias("_lo"),
                F.max("_hi").alias("_hi"),
            )
            .withColumn("_leaf", (F.col("shard_bytes") <= max_bytes) | (F.col("_lo") == F.col("_hi")) | (F.col("depth") == HASH_BITS))
        )
        nodes = settle(nodes, "shard-nodes")
        parents = nodes.select((F.col("depth") + 1).alias("depth"), "prefix", F.col("_leaf").alias("_done"))
        # Below the round's first depth a node is a leaf only under a parent that is not.
        made = nodes.alias("n").join(
            parents.alias("p"),
            (F.col("n.depth") == F.col("p.depth")) & (F.expr("shiftright(n.prefix, 1)") == F.col("p.prefix")),
            "left",
        )
        made = made.filter(F.col("n._leaf") & ~F.coalesce(F.col("p._done"), F.lit(False))).select("n.*")
        leaves = made if leaves is None else leaves.unionByName(made)
        over = nodes.filter((F.col("depth") == end) & ~F.col("_leaf")).select(F.col("prefix").alias("_over"))
        if over.isEmpty():
            break
        waiting = waiting.join(over, F.expr(f"shiftright(_key, {HASH_BITS - end})") == F.col("_over"), "left_semi")
        base = end
    return leaves.select("depth", "prefix", "shard_bytes", "shard_docs")


def paged(rows: DataFrame, max_bytes: int, hashed: list[str]) -> DataFrame:
    """Cut every over-full leaf (`_depth, _prefix`) into pages: adds `_page`, and the pages' own `shard_bytes, shard_docs`.

    Rows of at most half the limit are laid end to end, in the order of a hash over the
    columns `hashed`, and cut at each half of the limit, so that a page stays within the
    limit; each longer row is a page of its own. Neither a retry nor another partitioning
    moves a row, unless its hash ties with that of another; ties are told apart by their place
    in a settled table.
    """
    rows = rows.drop("shard_bytes", "shard_docs").withColumns({"_print": F.xxhash64(*hashed), "_at": F.monotonically_increasing_id()})
    half = max(max_bytes // 2, 1)
    rows = settle(rows.withColumn("_long", F.col("_bytes") > half), "shard-paged")
    leaf = ["_depth", "_prefix", "_long"]
    weight = F.when(F.col("_long"), F.lit(1)).otherwise(F.col("_bytes"))
    laid = settle(running(rows, [F.col(c) for c in (*leaf, "_print", "_at")], weight, "shard-running"), "shard-laid")
    first = laid.groupBy(*leaf).agg(F.min("before").alias("_first"))
    unit = F.when(F.col("_long"), F.lit(1)).otherwise(F.lit(half))
    laid = laid.join(first, leaf).withColumn("_nth", F.floor((F.col("before") - F.col("_first")) / unit))
    laid = laid.withColumn("_page", F.concat(F.when(F.col("_long"), "+long").otherwise("+"), F.col("_nth").cast("string")))
    sizes = laid.groupBy("_depth", "_prefix", "_page").agg(F.sum("_bytes").alias("shard_bytes"), F.count("*").alias("shard_docs"))
    return laid.join(sizes, ["_depth", "_prefix", "_page"])


def shard(docs: DataFrame, max_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text", step: int = 12) -> DataFrame:
    """Add `shard` (the hash prefix in bits, with `+page` where one key fills several), `shard_bytes`, `shard_docs`.

    Sizes are UTF-8 bytes of the text (null: 0), those of a page are its own. A row longer
    than the limit gets a shard of its own. An empty table gives no rows. Columns of these
    names in `docs` are replaced; all others are kept, whatever their names and types.
    """
    docs = docs.drop("shard", "shard_bytes", "shard_docs")
    # A caller's columns travel in one struct, so that no name of theirs meets one used here.
    keyed = docs.select(F.struct(*[docs[n] for n in docs.columns]).alias("_row"), shard_key(id_col, text_col).alias("_key"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("_bytes"))
    leaves = settle(shard_directory(keyed.select("_key", "_bytes"), max_bytes, step), "shard-directory")
    # A slot of the directory is a prefix at the global depth; the range of a leaf covers 2^(global - local) of them.
    deepest = leaves.agg(F.max("depth")).head()[0] or 0
    slot_depth = min(deepest, 20)
    coarse = F.greatest(F.col("depth") - slot_depth, F.lit(0))
    slots = leaves.withColumn("_first", F.when(coarse > 0, F.expr(f"shiftright(prefix, depth - {slot_depth})")).otherwise(F.expr(f"shiftleft(prefix, {slot_depth} - depth)")))
    slots = slots.withColumn("_last", F.when(coarse > 0, F.col("_first")).otherwise(F.col("_first") + F.expr(f"shiftleft(1L, {slot_depth} - depth)") - 1))
    slots = settle(slots.select("*", F.explode(F.sequence("_first", "_last")).alias("_slot")).drop("_first", "_last"), "shard-slots")
    slots = slots.withColumnsRenamed({"depth": "_depth", "prefix": "_prefix"})
    rows = keyed.withColumn("_slot", F.expr(f"shiftright(_key, {HASH_BITS - slot_depth})"))
    found = rows.join(slots, (rows["_slot"] == slots["_slot"]) & (F.expr(f"shiftright(_key, cast({HASH_BITS} - _depth as int))") == slots["_prefix"]))
    found = found.drop("_slot", "_key")
    many = (F.col("shard_bytes") > max_bytes) & (F.col("shard_docs") > 1)
    if not leaves.filter(many).isEmpty():
        simple = [f"_row.`{f.name}`" for f in docs.schema if isinstance(f.dataType, AtomicType)]
        found = found.filter(~many).withColumn("_page", F.lit("")).unionByName(
            paged(found.filter(many), max_bytes, simple).select(*found.columns, "_page")
        )
    else:
        found = found.withColumn("_page", F.lit(""))
    bits = F.when(F.col("_depth") == 0, F.lit("")).otherwise(F.lpad(F.bin("_prefix"), F.col("_depth"), F.lit("0")))
    return found.select("_row.*", F.concat(bits, "_page").alias("shard"), "shard_bytes", "shard_docs")
