from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.functions import text
from reviewloom.operators import clusters, embedding, projection, spectra


def table(spark, vectors):
    rows = [(f"c{i:04d}", [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "category string, vector array<double>").repartition(4)


def roll(n=260, seed=2):
    """A sheet rolled up in space."""
    rng = np.random.default_rng(seed)
    turn = 1.5 * math.pi * (1 + 2 * rng.random(n))
    return np.stack([turn * np.cos(turn), 12 * rng.random(n), turn * np.sin(turn)], axis=1)


def nearest(vectors, k):
    gap = ((vectors[:, None] - vectors[None]) ** 2).sum(-1) + np.diag([np.inf] * len(vectors))
    return gap.argsort(axis=1)[:, :k]


def kept(before, after, k=10):
    one, two = nearest(before, k), nearest(after, k)
    return np.mean([len(set(a) & set(b)) / k for a, b in zip(one, two)])


def matrix_of(df):
    return np.array([r.vector for r in df.orderBy("category").collect()])


@pytest.fixture(scope="module")
def graph(spark):
    points = table(spark, roll()).withColumnRenamed("category", "key")
    return projection.neighbor_graph(points, projection.Layout(neighbors=8, metric="euclidean"))


def test_most_neighbors_are_found(graph):
    found = {(r.a, r.b) for r in graph.collect()}
    want = {(f"c{i:04d}", f"c{j:04d}") for i, near in enumerate(nearest(roll(), 8)) for j in near}
    assert len(found) == len(want) and len(found & want) > 0.95 * len(want)


def test_weights(graph):
    rows = graph.collect()
    near: dict = {}
    for r in rows:
        near.setdefault(r.a, []).append((r.distance, r.b))
    own = {}
    for a, links in near.items():
        weights = projection._fade(np.array([d for d, _ in sorted(links)]))
        assert weights.max() == 1 and weights.sum() == pytest.approx(math.log2(len(links)), abs=0.01)
        own.update({(a, b): w for (_, b), w in zip(sorted(links), weights)})
    got = {(r.a, r.b): r.weight for r in projection.fuzzy_graph(graph).collect()}
    want = {}
    for a, b in own:
        p, q = own[a, b], own.get((b, a), 0.0)
        want[a, b] = want[b, a] = p + q - p * q
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x]) for x in want)


def coil(n=160, waves=6):
    """A closed curve that winds through many dimensions; the last wave is the largest."""
    turn = np.random.default_rng(3).permutation(n) * 2 * math.pi / n
    return np.stack([(1 + 0.1 * k) * f(k * turn) for k in range(1, waves + 1) for f in (np.cos, np.sin)], axis=1)


def test_a_coiled_curve_keeps_its_neighbors_unlike_by_leading_components(spark):
    vectors = coil()
    how = projection.Layout(neighbors=8, dims=2, metric="euclidean", epochs=2, filters=3, degree=4)
    flat = matrix_of(projection.project(table(spark, vectors), how))
    linear = matrix_of(clusters.reduce_dims(table(spark, vectors), 2))
    assert flat.shape == (len(vectors), 2) and np.isfinite(flat).all()
    assert kept(vectors, flat) > 0.7 > 2 * kept(vectors, linear)


def test_few_points(spark):
    for vectors in ([[1.0, 2.0]], [[1.0, 0.0], [0.0, 1.0]], [[1.0, 1.0]] * 5):
        out = matrix_of(projection.project(table(spark, vectors), projection.Layout(epochs=1, filters=1, degree=2, rounds=1)))
        assert out.shape == (len(vectors), 3) and np.isfinite(out).all()


def test_curve():
    a, b = projection.curve(0.1)
    assert (a, b) == (pytest.approx(1.577, abs=0.01), pytest.approx(0.895, abs=0.01))


def test_eigenvectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 4))
    full = base @ np.diag([9, -7, 5, 3]) @ base.T + 0.1 * np.diag(rng.random(40))
    rows = [(f"w{i:02d}", f"w{j:02d}", float(full[i, j])) for i in range(40) for j in range(40)]
    vectors, values = spectra.leading_eigenvectors(spark.createDataFrame(rows, "a string, b string, weight double"), 4)
    size, turn = np.linalg.eigh(full)
    order = np.argsort(-np.abs(size))[:4]
    assert values == pytest.approx(size[order], rel=1e-6)
    got = np.array([[r[c] for c in ("x0", "x1", "x2", "x3")] for r in vectors.orderBy("key").collect()])
    least = np.linalg.norm(full - turn[:, order] @ np.diag(size[order]) @ turn[:, order].T)
    assert np.linalg.norm(full - got @ np.diag(values) @ got.T) <= 1.01 * least + 1e-6


REVIEWS = [
    ("fruit", "ripe apple and sweet pear with juice"), ("fruit", "sweet apple juice, ripe pear"), ("fruit", "a pear and an apple make juice"),
    ("tools", "steel hammer and long nail for wood"), ("tools", "hammer the steel nail in wood"), ("tools", "wood nail, steel hammer"),
    ("none", None), ("none", "!!!"), (None, "apple nail"),
]


def test_pairs_and_information(spark):
    reviews = spark.createDataFrame(REVIEWS, "category string, text string")
    counts: dict = {}
    for _, text in REVIEWS:
        tokens = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        for i, a in enumerate(tokens):
            for j, b in enumerate(tokens):
                if i != j and abs(i - j) <= 3:
                    counts[a, b] = counts.get((a, b), 0) + 1
    pairs = embedding.pair_counts(reviews, window=3)
    assert {(r.a, r.b): r.n for r in pairs.collect()} == counts
    total: dict = {}
    for (a, _), n in counts.items():
        total[a] = total.get(a, 0) + n
    often = {w for w, n in total.items() if n >= 6}
    kept_ = {x: n for x, n in counts.items() if set(x) <= often}
    single: dict = {}
    for (a, _), n in kept_.items():
        single[a] = single.get(a, 0) + n
    every = sum(single.values())
    want = {(a, b): math.log2(n * every / (single[a] * single[b])) for (a, b), n in kept_.items()}
    got = {(r.a, r.b): r.weight for r in embedding.mutual_information(pairs, 6).collect()}
    want = {x: w for x, w in want.items() if w > 0}
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x]) for x in want)


def test_categories_lie_by_their_words(spark):
    reviews = spark.createDataFrame(REVIEWS, "category string, text string")
    more = spark.createDataFrame([("orchard", "sweet pear juice apple"), ("workshop", "steel nail wood hammer")], "category string, text string")
    out = {r.category: r.vector for r in embedding.category_word_vectors(reviews.unionByName(more), dims=3, window=4, min_count=4).collect()}
    cosine = lambda x, y: np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y)
    assert set(out) == {"fruit", "tools", "none", None, "orchard", "workshop"} and out["none"] is None
    assert cosine(out["orchard"], out["fruit"]) > 0.8 > 0.4 > cosine(out["orchard"], out["tools"])
    assert cosine(out["workshop"], out["tools"]) > 0.8


def test_coded_pairs_keep_only_frequent_words(spark):
    texts = ["red car red bike", "red car http://x.y <b>Red</b> a@b.c car", None, "", "solo", "rare red"] * 3
    reviews = spark.createDataFrame([(t,) for t in texts], "text string")
    every = {(r.a, r.b): r.n for r in embedding.pair_counts(reviews, window=2).collect()}
    total = {a: sum(n for (x, _), n in every.items() if x == a) for a, _ in every}
    often = {a for a, n in total.items() if n >= 9}
    assert "rare" not in often and "solo" not in total
    pairs, names = embedding.coded_pair_counts(reviews, window=2, min_count=9)
    assert {r.word for r in names.collect()} == often and pairs.dtypes[0] == ("a", "bigint")
    kept = {(r.a, r.b): r.n for r in embedding.named(pairs, names).collect()}
    assert kept == {(a, b): n for (a, b), n in every.items() if a in often and b in often}


def test_normalized_words_are_those_of_the_normal_text(spark):
    texts = ["A <b>b</b> C", "see httpx y www.z q", "m@n o p@", "<i", "Ärger Café Iİ", "  ", "", None, "a<b>http://c d@e</b>f", "x y\x1cz"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = df.select(text.words(text.normalize_text("text")).alias("x"), text.normalized_words(F.col("text")).alias("y")).collect()
    assert [r.x for r in rows] == [r.y for r in rows]
    assert rows[0].y == ["a", "b", "c"] and rows[1].y == ["see", "y", "q"] and rows[-2].y == ["a", "f"]
