"""The density tree against a plain version that works on all pairs in one process."""

from __future__ import annotations

import math

import numpy as np
import pytest

from reviewloom.operators import hierarchy as hi, validity
from reviewloom.operators.projection import Layout
from reviewloom.plans.clustering import cluster_by_tree


def table(spark, vectors):
    rows = [(f"c{i:04d}", [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "category string, vector array<double>").repartition(4)


def mutual(vectors, k, alpha):
    d = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(-1))
    core = np.sort(d + np.where(np.eye(len(d)) > 0, np.inf, 0), axis=1)[:, k - 1]
    reach = np.maximum(np.maximum(core[:, None], core[None]), d / alpha)
    np.fill_diagonal(reach, 0)
    return reach


def split(reach, points, below):
    """Parts of a point set that are linked by steps shorter than ``below``."""
    left, out = set(points), []
    while left:
        part, todo = set(), [min(left)]
        while todo:
            p = todo.pop()
            if p not in part:
                part.add(p)
                todo += [q for q in points if q not in part and reach[p, q] < below]
        out.append(sorted(part))
        left -= part
    return out


def longest(reach, points):
    """Longest edge of the spanning tree of a point set (Prim)."""
    inside, best, most = {points[0]}, {p: reach[points[0], p] for p in points[1:]}, 0.0
    while best:
        p = min(best, key=best.get)
        most = max(most, best.pop(p))
        for q in best:
            best[q] = min(best[q], reach[p, q])
    return most


def plain_tree(reach, m):
    """Clusters from the top: dicts with members, birth, children, leaving distances."""

    def grow(points, born):
        node = {"points": list(points), "born": born, "left": {}, "children": [], "created": None}
        while True:
            d = longest(reach, points)
            parts = split(reach, points, d) if d > 0 else [[p] for p in points]
            big = [p for p in parts if len(p) >= m]
            for part in parts:
                if len(part) < m or len(big) != 1:
                    for p in part:
                        node["left"][p] = d
            if len(big) == 1:
                points = big[0]
                continue
            node["created"] = d
            node["children"] = [grow(b, d) for b in big]
            for child in node["children"]:
                for p in child["points"]:
                    node["left"].pop(p, None)
            out = 0 if math.isinf(born) else 1 / max(born, hi.TINY)
            gone = sum(1 / max(x, hi.TINY) - out for x in node["left"].values())
            node["mass"] = gone + sum(len(c["points"]) for c in node["children"]) * (1 / max(d, hi.TINY) - out)
            return node

    return grow(list(range(len(reach))), math.inf)


def plain_choice(root, epsilon):
    def best(node):
        inner = [best(c) for c in node["children"]]
        total = sum(v for v, _ in inner)
        return (node["mass"], [node]) if node["mass"] >= total else (total, [x for _, xs in inner for x in xs])

    parent = {}

    def walk(node):
        for c in node["children"]:
            parent[id(c)] = node
            walk(c)

    walk(root)
    chosen = [x for c in root["children"] for x in best(c)[1]]
    out = []
    for node in chosen:
        if node["born"] < epsilon:
            while parent[id(node)] is not root:
                node = parent[id(node)]
                if node["born"] > epsilon:
                    break
        out.append(node)
    return {id(n): n for n in out}


def plain_labels(vectors, m, k, alpha, epsilon):
    reach = mutual(vectors, k, alpha)
    root = plain_tree(reach, m)
    chosen = plain_choice(root, epsilon)
    owner, gone = {}, {}

    def walk(node, above):
        mine = id(node) if id(node) in chosen else above
        for p, d in node["left"].items():
            owner[p], gone[p] = mine, d
        for c in node["children"]:
            walk(c, mine)

    walk(root, None)
    first = {}
    for p in sorted(owner):
        first.setdefault(owner[p], len([x for x in first if x is not None]) if owner[p] is not None else -1)
    label = [first[owner[p]] for p in range(len(vectors))]
    prob = []
    for p in range(len(vectors)):
        if owner[p] is None:
            prob.append(0.0)
        else:
            made = chosen[owner[p]]["created"]
            prob.append(1.0 if gone[p] == 0 else made / max(gone[p], made))
    return label, prob, reach


def blobs(seed, n, dims, spots=6, crowd=0.4):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(spots, dims)) * 2
    which = np.where(rng.random(n) < crowd, 0, rng.integers(0, spots, n))
    return at[which] + rng.normal(scale=0.1, size=(n, dims)) * rng.uniform(0.3, 2, size=(n, 1))


@pytest.mark.parametrize(
    ("n", "dims", "m", "k", "alpha", "epsilon", "rows", "level"),
    [
        (33, 3, 2, 1, 0.5, 0.5, 2048, 10**6),
        (300, 3, 5, 3, 1.0, 0.0, 2048, 10**6),
        (300, 3, 5, 3, 1.0, 0.0, 60, 1500),
        (90, 5, 2, 2, 1.5, 0.2, 2048, 30),
    ],
)
def test_labels_against_the_plain_tree(spark, n, dims, m, k, alpha, epsilon, rows, level):
    vectors = blobs(n + dims, n, dims)
    found = hi.density_hierarchy(table(spark, vectors), m, k, epsilon, alpha, tile_rows=rows, level=level)
    label, prob, reach = plain_labels(vectors, m, k, alpha, epsilon)
    out = found.labels.orderBy("category").collect()
    assert [r.cluster for r in out] == label
    assert [r.probability for r in out] == pytest.approx(prob)
    edges = found.edges.collect()
    assert len(edges) == n - 1
    total = 0.0
    inside, best = {0}, dict(enumerate(reach[0]))
    best.pop(0)
    while best:
        p = min(best, key=best.get)
        total += best.pop(p)
        for q in best:
            best[q] = min(best[q], reach[p, q])
    assert sum(e.weight for e in edges) == pytest.approx(total)


def test_copies_and_ties(spark):
    vectors = np.array([[0, 0]] * 4 + [[5, 5]] * 3 + [[0, 1], [0, 2], [5, 6], [50, 50], [50, 51], [50, 52], [90, 0]], float)
    found = hi.density_hierarchy(table(spark, vectors), 2, 2, 0.0, 1.0)
    label, prob, _ = plain_labels(vectors, 2, 2, 1.0, 0.0)
    out = found.labels.orderBy("category").collect()
    assert [r.cluster for r in out] == label
    assert [r.probability for r in out] == pytest.approx(prob)
    assert found.edges.count() == len(vectors) - 1


def test_few_points_are_noise(spark):
    for vectors in ([], [[1.0]], [[1.0], [2.0]]):
        out = hi.density_hierarchy(table(spark, vectors), 2, 1, 0.5, 1.0).labels.collect()
        assert [(r.cluster, r.probability) for r in out] == [(-1, 0.0)] * len(vectors)


def plain_validity(labels, edges):
    ids = sorted(set(labels) - {-1})
    inside, apart = dict.fromkeys(ids, 0.0), dict.fromkeys(ids, math.inf)
    longest_edge, outlier = 0.0, math.inf
    for a, b, w in edges:
        x, y = labels[a], labels[b]
        longest_edge = max(longest_edge, w)
        if x == y == -1:
            continue
        if -1 in (x, y):
            outlier = min(outlier, w)
        elif x == y:
            inside[x] = max(inside[x], w)
        else:
            apart[x], apart[y] = min(apart[x], w), min(apart[y], w)
    outlier = longest_edge if math.isinf(outlier) else outlier
    spare = 2 * (longest_edge if len(ids) > 1 else outlier)
    apart = {c: spare if math.isinf(v) else v for c, v in apart.items()}
    return sum(labels.count(c) / len(labels) * (apart[c] - inside[c]) / max(apart[c], inside[c]) for c in ids)


def test_relative_validity(spark):
    found = hi.density_hierarchy(table(spark, blobs(7, 80, 3)), 4, 2, 0.0, 1.0)
    score = hi.relative_validity(found.labels, found.edges).first()[0]
    labels = [r.cluster for r in found.labels.orderBy("category").collect()]
    edges = [(int(e.a[1:]), int(e.b[1:]), e.weight) for e in found.edges.collect()]
    assert score == pytest.approx(plain_validity(labels, edges))
    nothing = hi.density_hierarchy(table(spark, [[1.0], [2.0]]), 2, 1, 0.0, 1.0)
    assert hi.relative_validity(nothing.labels, nothing.edges).first()[0] is None


def test_the_clustering_job_by_tree(spark):
    vectors = table(spark, blobs(11, 24, 6, spots=3, crowd=0.1))
    reviews = vectors.select("category", "category").toDF("category", "text")
    how = Layout(filters=1, degree=2, epochs=1, rounds=1)
    run = cluster_by_tree(reviews, vectors, how, min_size=3, min_samples=2, epsilon=0.0, alpha=1.0)
    assert run.points.count() == run.reviews.count() == 24 and run.reducer is None
    metrics = run.metrics.first()
    assert (metrics.stability_score is None) == (metrics.n_clusters == 0)
    tree = run.tree.collect()
    assert [t.size for t in tree if t.parent is None] == [24] and all(t.born >= t.created for t in tree)


def test_centroid_silhouettes(spark):
    vectors = blobs(5, 60, 3)
    labels = [i % 4 for i in range(59)] + [9]
    rows = [(f"c{i:04d}", [float(x) for x in v], c) for i, (v, c) in enumerate(zip(vectors, labels))]
    points = spark.createDataFrame(rows, "category string, vector array<double>, cluster int")
    centre = {c: vectors[[i for i, x in enumerate(labels) if x == c]].mean(axis=0) for c in set(labels)}
    want = []
    for v, c in zip(vectors, labels):
        a = np.linalg.norm(v - centre[c])
        b = min(np.linalg.norm(v - m) for other, m in centre.items() if other != c)
        want.append(0.0 if labels.count(c) == 1 else (b - a) / max(a, b))
    for tile in (7, 2048):
        out = validity.centroid_silhouettes(points, tile_rows=tile).orderBy("category").collect()
        assert [r.silhouette for r in out] == pytest.approx(want)
    alone = validity.centroid_silhouettes(points.where("cluster = 1")).collect()
    assert {r.silhouette for r in alone} == {0.0}
