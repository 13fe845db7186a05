"""Terms counted batch by batch, and queries that go through a tree together."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from bulletin.llm import lexical_search

from .test_retrieval import bag, random_rows, texts


@pytest.mark.parametrize("piece", [7, 300, 1 << 22])
def test_terms_are_counted_whatever_the_pieces(monkeypatch, piece):
    monkeypatch.setattr(lexical_search, "PIECE", piece)
    docs = texts(random.Random(3), 80) + [(None, "zü w"), (7, None), (8, ""), (9, "... !"), (5, "MoTA" * 50 + " w"), (6, " \x1f w\x00W-zü ")]
    known = sorted(bag(" ".join(t for _, t in docs[:9])) | {"w": 1, "never": 1})
    batch = pa.record_batch({"doc_id": pa.array([i for i, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs])})
    (out,) = lexical_search._counted(known)(iter([batch]))
    got = [(r["doc_id"], r["n"], {known[t]: c for t, c in zip(r["term"], r["tf"], strict=True)}) for r in out.to_pylist()]
    bags = [(i, bag(t)) for i, t in docs]
    assert got == [(i, b.total(), {t: c for t, c in b.items() if t in known}) for i, b in bags if b]


@pytest.mark.parametrize("width", [1, 32, 1 << 20])
@pytest.mark.parametrize("most", [1000, 1 << 54])
def test_products_are_exact(monkeypatch, width, most):
    monkeypatch.setattr(lexical_search, "PRODUCTS", width)
    rng = np.random.default_rng(4)
    rows = random_rows(rng, 30, 20)
    rows.values = rng.integers(most // 2, most, len(rows.values))
    queries, some = rng.random((20, 9)) < 0.5, np.array([1, 4, 8])
    dense = np.zeros((30, 20), np.int64)
    dense[np.repeat(np.arange(30), np.diff(rows.ptr)), rows.at] = rows.values
    assert (rows.products(queries, some) == dense @ queries[:, some].astype(np.int64)).all()


def test_queries_share_the_leaves_of_a_tree(monkeypatch):
    rng = np.random.default_rng(5)
    rows, queries, taken, products = random_rows(rng, 300, 30), rng.random((30, 40)) < 0.3, Counter(), lexical_search.Sparse.products
    monkeypatch.setattr(lexical_search.Sparse, "products", lambda leaf, *a: (taken.update([id(leaf)]), products(leaf, *a))[1])
    tree, ids, best = lexical_search.BallTree(rows, 30, 8), np.arange(300), [lexical_search.Best(6) for _ in range(40)]
    scored = lexical_search.descend_together(tree, tree.bounds(queries.astype(float)), queries, ids, ids < 0, best)
    # Any order of the leaves takes one more, or twice as many, at a time.
    assert taken.total() < 8 * sum(leaf is not None for leaf in tree.leaves) and scored.max() <= 300
    monkeypatch.undo()
    exact = rows.products(queries, np.arange(40))
    for q, b in enumerate(best):
        assert b.ids.tolist() == np.lexsort((ids, -exact[:, q]))[:6].tolist()
