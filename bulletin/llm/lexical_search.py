"""Ranked lexical search over sparse ball trees, exact to the last document.

A document is a sparse vector of integers: one component per query term it holds, the
term's weight times its saturated frequency. A query is the 0/1 vector of its terms, so a
score is an inner product of integers. Every task packs its documents into trees of
balls: a node has a centroid c and a radius R over its documents, and none of them scores
more than <q, c> + |q| R. The bound is computed in doubles and rounded up by more than the
arithmetic can lose. A query takes the leaves best-first, from the one with the highest bound,
scores them by exact integer sums, and stops at the first bound below its k-th best score
(not at an equal one, which may hide a tie with a smaller id). The queries of a block go
through a tree in step, so that a leaf is scored once for all that have come to it; each
takes one leaf, one more, then two, four and so on before its k-th best score is renewed.

Queries come in blocks with a bounded vocabulary, each block against all documents. A task
hands on k rows a query at most, and two rounds of top-k merge them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulletin.llm.common import settle
from bulletin.operators.order import top_k

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The same in UTF-8: what a byte becomes, a space if no term has it. All bytes of non-ASCII characters stay.
_FOLDED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).translate(bytes.maketrans(_UPPER.encode(), _LOWER.encode()))
#: Bytes of texts that are cut into terms at a time, about.
PIECE = 1 << 22
#: Relative and absolute room above what sums of up to 2^20 products lose in doubles.
ROOM, LEAST_ROOM = 1 + 1e-9, 1.0
#: Entries of one tree, about.
TREE_ENTRIES = 1 << 20
#: Queries that go through a tree together, and numbers of a leaf that are laid out at a time.
TOGETHER, PRODUCTS = 256, 1 << 20


def terms(text: Column) -> Column:
    """Distinct terms of a text, A-Z in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(TERM), F.lit(0)))


def query_blocks(items: DataFrame, block_terms: int, item_col: str, text_col: str) -> Iterator[list[tuple[int | None, list[str]]]]:
    """Items with their terms, in blocks of about `block_terms` terms; the driver holds one block."""
    rows = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.explode(terms(F.coalesce(text_col, F.lit("")))).alias("term"))
    listed = settle(rows.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms")), "search-items")
    block, size = [], 0
    for row in listed.orderBy("item_id").toLocalIterator():
        if block and size + len(row.terms) > block_terms:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.terms))
        size += len(row.terms)
    if block:
        yield block


def _folded(texts: pa.Array) -> Iterator[tuple[list[int], list[bytes]]]:
    """The texts in UTF-8 with one case and spaces for separators, about PIECE bytes at a time: rows and their texts, a long one in pieces between terms."""
    rows, pieces, size = [], [], 0
    for row, text in enumerate(texts):
        data, rest = memoryview(text.as_buffer() if text.is_valid else b""), b""
        for lo in range(0, len(data), PIECE):
            piece = rest + data[lo : lo + PIECE].tobytes().translate(_FOLDED)
            end = piece.rfind(b" ") + 1 if lo + PIECE < len(data) else len(piece)
            rows.append(row)
            pieces.append(piece[:end])
            rest, size = piece[end:], size + end
            if size >= PIECE:
                yield rows, pieces
                rows, pieces, size = [], [], 0
    yield rows, pieces


def _counted(vocabulary: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`doc_id, n, term, tf`: the length of every document with a term, and its query terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.string())
        for batch in batches:
            lengths, keys, times = np.zeros(len(batch), np.int64), [], []
            for rows, pieces in _folded(batch.column("text")):
                words = pc.ascii_split_whitespace(pa.array(pieces, pa.binary()).cast(pa.string(), safe=False))
                row, word = np.array(rows, np.int64)[pc.list_parent_indices(words).to_numpy()], words.flatten()
                # What is left of a separator at either end is empty.
                lengths += np.bincount(row[pc.not_equal(word, "").to_numpy(zero_copy_only=False)], minlength=len(batch))
                number = pc.index_in(word, value_set=known)
                held = row[number.is_valid().to_numpy(zero_copy_only=False)] * len(known) + number.drop_null().to_numpy()
                key, n = np.unique(held, return_counts=True)
                keys.append(key)
                times.append(n)
            key, where = np.unique(np.concatenate(keys), return_inverse=True)
            times = np.bincount(where, np.concatenate(times), len(key)).astype(np.int64)
            full = np.flatnonzero(lengths)
            sizes = np.bincount(key // len(known), minlength=len(batch))[full]
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            columns = [
                batch.column("doc_id").take(pa.array(full)), pa.array(lengths[full]),
                pa.ListArray.from_arrays(offsets, pa.array(key % len(known), pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(times)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "term", "tf"])

    return run


class Sparse:
    """Rows of integers: columns `at` and `values` between `ptr[i]` and `ptr[i + 1]`."""

    def __init__(self, ptr: np.ndarray, at: np.ndarray, values: np.ndarray):
        self.ptr, self.at, self.values = ptr, at, values

    def __len__(self) -> int:
        return len(self.ptr) - 1

    def take(self, rows: np.ndarray) -> Sparse:
        sizes = self.ptr[rows + 1] - self.ptr[rows]
        ptr = np.concatenate([[0], np.cumsum(sizes)])
        source = np.arange(ptr[-1]) + np.repeat(self.ptr[rows] - ptr[:-1], sizes)
        return Sparse(ptr, self.at[source], self.values[source])

    def sums(self, numbers: np.ndarray) -> np.ndarray:
        """Sum per row of one number per entry; every row is added up by itself."""
        out = np.zeros(len(self), numbers.dtype)
        held = np.flatnonzero(np.diff(self.ptr))
        if len(held):
            out[held] = np.add.reduceat(numbers, self.ptr[held])
        return out

    def products(self, queries: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Rows x `some` of the queries (columns of 0/1), for rows without negative numbers: in doubles if those hold every sum exactly, else in integers."""
        kind = np.float64 if self.sums(self.values).max(initial=0) < 1 << 53 else np.int64
        held, at = np.unique(self.at, return_inverse=True)
        row, width = np.repeat(np.arange(len(self)), np.diff(self.ptr)), max(PRODUCTS // max(len(self), 1), 1)
        out = np.zeros((len(self), len(some)), np.int64)
        for lo in range(0, len(held), width):
            own = slice(None) if len(held) <= width else (at >= lo) & (at < lo + width)
            dense = np.zeros((len(self), min(width, len(held) - lo)), kind)
            dense[row[own], at[own] - lo] = self.values[own]
            out += (dense @ queries[np.ix_(held[lo : lo + width], some)].astype(kind)).astype(np.int64)
        return out

    def squared_distances(self, point: np.ndarray) -> np.ndarray:
        """To a dense point, in doubles, never negative."""
        v, p = self.values.astype(float), point[self.at]
        return np.maximum(self.sums((v - p) ** 2 - p * p) + point @ point, 0.0)


class BallTree:
    """Balls over sparse integer rows; node 0 is the root, a node's children follow it."""

    def __init__(self, rows: Sparse, width: int, leaf: int):
        self.width, self.centroids, self.radii, self.children, self.leaves = width, [], [], [], []
        self._grow(rows, np.arange(len(rows)), leaf)
        self.centers = np.array(self.centroids)
        self.radii = np.array(self.radii)
        self.centroids = None

    def _grow(self, rows: Sparse, own: np.ndarray, leaf: int) -> int:
        node = len(self.radii)
        center = np.bincount(rows.at, rows.values, self.width) / max(len(rows), 1)
        apart = rows.squared_distances(center)
        # The cancellation inside squared_distances is relative to the squared lengths.
        room = 1e-9 * (center @ center + (rows.sums(rows.values.astype(float) ** 2).max() if len(rows) else 0.0))
        self.centroids.append(center)
        self.radii.append(np.sqrt((apart.max() if len(apart) else 0.0) + room))
        self.children.append(())
        self.leaves.append(None)
        sides = self._sides(rows, apart, leaf)
        if sides is None:
            self.leaves[node] = (own, rows)
        else:
            self.children[node] = tuple(self._grow(rows.take(np.flatnonzero(s)), own[s], leaf) for s in (sides, ~sides))
        return node

    def _sides(self, rows: Sparse, apart: np.ndarray, leaf: int) -> np.ndarray | None:
        """Nearer to the row farthest from the centre, or to the row farthest from that one; None for a leaf.

        The smaller side gets an eighth of the rows at least, which bounds the depth.
        Rows that no distance tells apart are a leaf.
        """
        if len(rows) <= leaf:
            return None
        to_first = rows.squared_distances(self._dense(rows, int(apart.argmax())))
        if to_first.max() == 0.0:
            return None
        lean = to_first - rows.squared_distances(self._dense(rows, int(to_first.argmax())))
        order = np.argsort(lean, kind="stable")
        least = max(len(rows) // 8, 1)
        cut = min(max(int((lean <= 0).sum()), least), len(rows) - least)
        near = np.zeros(len(rows), bool)
        near[order[:cut]] = True
        return near

    def _dense(self, rows: Sparse, i: int) -> np.ndarray:
        out = np.zeros(self.width)
        out[rows.at[rows.ptr[i] : rows.ptr[i + 1]]] = rows.values[rows.ptr[i] : rows.ptr[i + 1]]
        return out

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Per node and query (columns of 0/1), a number that no document of the node exceeds."""
        reach = np.sqrt(queries.sum(0))
        bound = (self.centers @ queries + self.radii[:, None] * reach) * ROOM + LEAST_ROOM
        for node, below in enumerate(self.children):
            for child in below:
                bound[child] = np.minimum(bound[child], bound[node])
        return bound


class Best:
    """The k best documents of a query so far: score descending, rows without an id last, id ascending."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.null = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.least = 1

    def offer(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        good = scores >= self.least
        if not good.any():
            return
        scores, ids, null = (np.concatenate([a, b[good]]) for a, b in ((self.scores, scores), (self.ids, ids), (self.null, null)))
        order = np.lexsort((ids, null, -scores))[: self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])


def descend(tree: BallTree, bound: np.ndarray, mask: np.ndarray, ids: np.ndarray, null: np.ndarray, best: Best) -> int:
    """Search one tree best-first for one query; returns the number of documents scored."""
    return int(descend_together(tree, bound[:, None], mask[:, None], ids, null, [best])[0])


def descend_together(tree: BallTree, bound: np.ndarray, queries: np.ndarray, ids: np.ndarray, null: np.ndarray, best: list[Best]) -> np.ndarray:
    """Search one tree best-first for queries (columns of 0/1, as those of `bound`); returns the number of documents scored for each."""
    leaves = np.flatnonzero([leaf is not None for leaf in tree.leaves])
    order = np.argsort(-bound[leaves], axis=0, kind="stable")
    bound = np.take_along_axis(bound[leaves], order, 0)
    scored = np.zeros(len(best), np.int64)
    at = 0
    while at < len(leaves):
        ahead = slice(at, max(2 * at, 1))
        going = bound[ahead] >= np.array([b.least for b in best])
        if not going.any():
            break
        scores = np.zeros((len(best), len(ids)), np.int64)
        turn, query = np.nonzero(going)
        leaf = order[ahead][turn, query]
        for i in np.unique(leaf):
            own, rows = tree.leaves[leaves[i]]
            here = query[leaf == i]
            scored[here] += len(own)
            scores[here[:, None], own] = rows.products(queries, here).T
        for q in np.flatnonzero(going.any(0)):
            # Documents of leaves that were not scored have 0, which no query takes.
            good = np.flatnonzero(scores[q] >= best[q].least)
            best[q].offer(scores[q, good], ids[good], null[good])
        at = ahead.stop
    return scored


def _cuts(sizes: np.ndarray, tree_docs: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most `tree_docs` rows and about TREE_ENTRIES entries, one row at least."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        full = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + TREE_ENTRIES, "right"))
        hi = max(min(lo + tree_docs, full), lo + 1)
        yield lo, hi
        lo = hi


def _searched(
    block: list[tuple[int | None, list[int]]], weights: list[int], n_docs: int, n_terms: int, k: int, tree_docs: int, leaf: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task's k best `item, doc_id, score` of every item, with `scored`, the documents looked at."""

    def vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, Sparse]:
        ids = batch.column("doc_id")
        null = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        # m per document in Python integers, which no product overflows.
        m = np.array([50 + (50 * n * n_docs) // n_terms for n in batch.column("n").to_pylist()], np.int64)
        lists = batch.column("term")
        ptr = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())]).astype(np.int64)
        at = lists.flatten().to_numpy().astype(np.int64)
        tf = batch.column("tf").flatten().to_numpy().astype(np.int64)
        values = np.array(weights, np.int64)[at] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, np.diff(ptr))))
        return ids, null, Sparse(ptr, at, values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, scored = [Best(k) for _ in block], np.zeros(len(block), np.int64)
        masks = np.zeros((len(block), len(weights)), bool)
        for i, (_, held) in enumerate(block):
            masks[i, held] = True
        for batch in batches:
            for lo, hi in _cuts(batch.column("term").value_lengths().fill_null(0).to_numpy(), tree_docs):
                ids, null, rows = vectors(batch.slice(lo, hi - lo))
                used, at = np.unique(rows.at, return_inverse=True)
                tree = BallTree(Sparse(rows.ptr, at, rows.values), len(used), leaf)
                own = masks[:, used]
                for some in (slice(i, i + TOGETHER) for i in range(0, len(block), TOGETHER)):
                    queries = np.ascontiguousarray(own[some].T)
                    scored[some] += descend_together(tree, tree.bounds(queries.astype(float)), queries, ids, null, best[some])
        sizes = [len(b.scores) for b in best]
        if sum(sizes):
            columns = [
                pa.array(np.repeat(np.arange(len(block)), sizes), pa.int32()),
                pa.array(np.concatenate([b.ids for b in best]), pa.int64(), mask=np.concatenate([b.null for b in best])),
                pa.array(np.concatenate([b.scores for b in best]), pa.int64()),
                pa.array(np.repeat(scored, sizes), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score", "scored"])

    return run


def _search_block(
    spark: SparkSession, docs: DataFrame, block: list[tuple[int | None, list[str]]], k: int, tree_docs: int, leaf: int
) -> DataFrame:
    vocabulary = sorted({t for _, held in block for t in held})
    number = {t: i for i, t in enumerate(vocabulary)}
    counted = settle(docs.mapInArrow(_counted(vocabulary), "doc_id bigint, n bigint, term array<int>, tf array<bigint>"), "search-vectors")
    n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).head()
    df = counted.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.ln((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
    weights = [0] * len(vocabulary)
    for row in df.select("term", weight.cast("bigint").alias("w")).collect():
        weights[row.term] = row.w
    asked = [(item, [number[t] for t in held]) for item, held in block]
    found = counted.select("doc_id", "n", "term", "tf").mapInArrow(
        _searched(asked, weights, n_docs, n_terms, k, tree_docs, leaf), "item int, doc_id bigint, score bigint, scored bigint"
    )
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # The salt splits an item's candidates, k a task, before they meet.
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    ranked = top_k(top_k(salted, ["item", "_salt"], order, k).drop("_salt"), ["item"], order, k, "rank")
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(asked)], "item int, item_id bigint")
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", tree_docs: int = 2048, leaf: int = 32, block_terms: int = 1 << 14,
) -> DataFrame:
    """`item_id, rank, doc_id, score`: the `k` documents with the highest positive score of every item.

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. Null
    and empty texts have no terms: such documents do not count and such items return nothing.
    Rows of items with one id (a null id too) are one item of all their terms. Rows of
    documents count one by one, repeated ones too; equal scores go by id, null ids last. An
    empty table on either side gives no rows. Other columns are not read.

    A block of items has about `block_terms` terms, or one item; a tree has `tree_docs`
    documents and 2^20 entries at most, or one document, and a centroid as many numbers as
    the tree has terms. A leaf has `leaf` documents at most, or equal ones.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for block in query_blocks(items, block_terms, item_col, item_text_col):
        found = settle(_search_block(spark, rows, block, k, tree_docs, leaf), "search-found")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint") if out is None else out
