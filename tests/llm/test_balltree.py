from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from texts import prose, table

from reviewloom.llm import balltree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(documents, items, k=20):
    held = [(i, Counter(terms(t))) for i, t in documents]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def got(spark, documents, items, k=20):
    docs = table(spark, [(i, t, None, None) for i, t in documents]) if not hasattr(documents, "columns") else documents
    wanted = spark.createDataFrame([(*r, "clash", 1, 2) for r in items], "item_id long, text string, doc_id string, rank int, score int")
    return sorted(map(tuple, balltree.ranked_search(docs, wanted, k).collect()), key=repr)


ITEMS = [
    (1, "manter ionper the the STAND été."), (2, None), (3, ""), (4, "no such words at-all"), (5, "the"), (5, "the"), (None, "derful"),
    (6, "日本語 one ONE o-n-e"), (7, " ".join(str(i) for i in range(500)) + " the manman"),
]


def test_awkward_rows_against_plain(spark, awkward, awkward_rows):
    rng = random.Random(1)
    items = [*ITEMS, *[(10 + i, prose(rng, 30)) for i in range(10)]]
    documents = [(i, t) for i, t, _, _ in awkward_rows]
    assert got(spark, awkward, items) == plain(documents, items)


@pytest.mark.parametrize(("items", "chunk", "leaf"), [(2, 7, 2), (512, 50, 8)])
def test_blocks_and_chunks(spark, monkeypatch, items, chunk, leaf):
    monkeypatch.setattr(balltree, "ITEMS", items)
    rng = random.Random(2)
    documents = [(i, prose(rng, rng.choice([5, 40, 90]), 900)) for i in range(200)] + [(900 + i, "the same text again") for i in range(60)]
    asked = [(i, prose(rng, 12, 900)) for i in range(6)] + [(50, "same again"), (51, documents[3][1])]
    assert got(spark, documents, asked, 5) == plain(documents, asked, 5)


def test_empty_tables(spark, nothing):
    assert got(spark, nothing, ITEMS) == []
    assert got(spark, [(1, "a text")], []) == []
    assert got(spark, [(1, None), (2, "?!")], ITEMS) == []


def test_bounds_hold_and_prune():
    """No row scores above the bound of a node that holds it, and most leaves are never scored."""
    rng = np.random.default_rng(4)
    topics = [rng.choice(3000, 60, replace=False) for _ in range(40)]
    docs = []
    for i in range(1500):
        own = np.unique(np.concatenate([rng.choice(topics[i % 40], 25), rng.choice(3000, 5)]))
        docs.append((own, rng.integers(1, 900_000, len(own))))
    items = []
    for topic in topics:
        own, count = np.unique(rng.choice(topic, 15), return_counts=True)
        items.append((own, count))
    weights = rng.integers(100, 9000, 3000)
    search = balltree.Search(items, weights, 5)
    search.add(list(range(len(docs))), docs)
    dense = np.zeros((len(docs), 3000), np.int64)
    for i, (t, v) in enumerate(docs):
        dense[i, t] = v
    for number, (t, n) in enumerate(items):
        scores = dense[:, t] @ (n * weights[t])
        best = sorted(((-s, i) for i, s in enumerate(scores.tolist()) if s > 0))[:5]
        assert sorted(((-s, -d) for s, d in search.best[number])) == best
    assert search.scored < 0.3 * search.leaves
    tree = balltree.build_tree(dense.astype(np.float32))
    rows = dense[tree.order].astype(float)
    for node in range(len(tree.low)):
        part = rows[tree.low[node] : tree.high[node]]
        assert (np.sqrt(np.square(part - tree.centroid[node]).sum(axis=1)) <= tree.radius[node]).all()
        assert (part <= (tree.centroid[node] + tree.spread[node]) * balltree.ROUND).all()
