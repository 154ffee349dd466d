"""Core distances and spanning forests by bounded searches, against all pairs; and how much is searched."""

from __future__ import annotations

import math

import numpy as np
import pytest

from reviewloom.operators import clusters, hierarchy, reachability, tiles


def table(spark, vectors):
    rows = [(f"c{i:05d}", 1, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "key string, n bigint, vector array<double>").repartition(4)


def cloud(seed, n):
    """A crowded middle, thin surroundings, and a few points far away."""
    rng = np.random.default_rng(seed)
    thin = rng.normal(size=(n // 10, 3)) * 8
    return np.concatenate([rng.normal(size=(n - len(thin) - 3, 3)), thin, [[900, 0, 0], [0, -4000, 0], [900, 1, 0]]])


def plain(vectors, k, alpha):
    d = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    core = np.sort(d, axis=1)[:, k - 1]
    return core, np.maximum(np.maximum(core[:, None], core[None]), d / alpha)


def plain_forest(reach, farthest):
    i, j = np.triu_indices(len(reach), 1)
    weight = reach[i, j]
    near = weight <= farthest
    order = np.argsort(weight[near], kind="stable")
    up, out = list(range(len(reach))), []

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b, w in zip(i[near][order], j[near][order], weight[near][order]):
        a, b = find(a), find(b)
        if a != b:
            up[a] = b
            out.append(w)
    return out


@pytest.mark.parametrize(("k", "alpha", "farthest"), [(1, 1.0, math.inf), (4, 0.5, math.inf), (2, 1.5, 0.9)])
def test_core_and_forest_against_all_pairs(spark, k, alpha, farthest):
    vectors = cloud(k, 400)
    core, reach = plain(vectors, k, alpha)
    cored = reachability.core_distances(table(spark, vectors), k, 40, farthest).where(f"core <= {farthest}" if farthest < math.inf else "true")
    cored = cored.localCheckpoint()
    found = {r.key: r.core for r in cored.collect()}
    assert found == pytest.approx({f"c{i:05d}": c for i, c in enumerate(core) if c <= farthest})
    edges = reachability.tree_edges(cored, alpha, 40, farthest).collect()
    at = lambda key: int(key[1:])
    assert all(e.weight == pytest.approx(reach[at(e.a), at(e.b)]) and e.weight <= farthest for e in edges)
    chosen = reachability.forest(
        np.array([at(e.a) for e in edges]), np.array([at(e.b) for e in edges]), np.array([e.weight for e in edges]), len(vectors)
    )
    assert sorted(edges[i].weight for i in chosen) == pytest.approx(plain_forest(reach, farthest))


@pytest.fixture
def compared(monkeypatch):
    """Sizes of all blocks of two tiles that any step of the density operators compares."""
    seen = []

    def watch(left, right, *given):
        out = real(left, right, *given)
        both = left.groupBy("_lt", "_rt").count().join(right.groupBy("_lt", "_rt").count().withColumnRenamed("count", "other"), ["_lt", "_rt"])
        seen.append(both.selectExpr("coalesce(sum(count * other), 0)").first()[0])
        return out

    real = tiles._cogroup
    monkeypatch.setattr(tiles, "_cogroup", watch)
    return seen


def test_far_points_do_not_make_all_tiles_meet(spark, compared):
    vectors, rows = cloud(5, 3000), 50
    points = table(spark, vectors).drop("n").selectExpr("key", "vector", "0D as core")
    edges = hierarchy.tree_edges(points, 1.0, rows)
    assert edges.count() >= len(vectors) - 1
    assert sum(compared) < len(vectors) ** 2


def test_a_wide_reach_does_not_compare_a_crowd(spark, compared):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(3000, 3)) * 0.1
    out = clusters.density_labels(table(spark, vectors).withColumnRenamed("key", "category"), eps=0.4, alpha=1.0, tile_rows=50)
    assert {r.cluster for r in out.select("cluster").distinct().collect()} == {0}
    assert sum(compared) < len(vectors) ** 2


def test_vectors_without_a_place_are_near_their_copies_only(spark):
    rows = [("a", [None, None]), ("b", [None, None]), ("c", [0.0, 0.0]), ("d", [0.1, 0.0]), ("e", [float("nan"), 1.0])]
    points = spark.createDataFrame(rows, "category string, vector array<double>")
    out = clusters.density_labels(points, eps=0.5, alpha=1.0).orderBy("category").collect()
    assert [r.cluster for r in out] == [0, 0, 1, 1, -1]
