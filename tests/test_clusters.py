from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.operators import clusters, report, stats, tiles, validity
from reviewloom.operators.ranking import cluster_top_categories, silhouette_profile
from reviewloom.plans.clustering import cluster_categories


def table(spark, vectors, labels=None):
    labels = [0] * len(vectors) if labels is None else labels
    rows = [(f"c{i:04d}", [float(x) for x in v], int(c)) for i, (v, c) in enumerate(zip(vectors, labels))]
    return spark.createDataFrame(rows, "category string, vector array<double>, cluster int")


def plain_labels(vectors, min_size, min_samples, eps, alpha):
    """Brute force over all pairs."""
    n = len(vectors)
    d = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(-1))
    off = d + np.where(np.eye(n) > 0, np.inf, 0)
    core = np.sort(off, axis=1)[:, min_samples - 1]
    reach = np.maximum(np.maximum(core[:, None], core[None]), off / alpha)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if reach[i, j] <= eps:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    roots = [find(i) for i in range(n)]
    kept = sorted({r for r in roots if roots.count(r) >= min_size})
    label = [kept.index(r) if r in kept else -1 for r in roots]
    best = reach.min(1)
    prob = [0.0 if c < 0 else min(best[j] for j in range(n) if label[j] == c) / best[i] if best[i] else 1.0 for i, c in enumerate(label)]
    return label, prob


def blobs(seed=1, n=120, dims=3, crowd=0.5):
    """Half of the points crowd one place."""
    rng = np.random.default_rng(seed)
    spots = rng.normal(size=(6, dims))
    which = np.where(rng.random(n) < crowd, 0, rng.integers(0, 6, n))
    return spots[which] + rng.normal(scale=0.08, size=(n, dims))


@pytest.mark.parametrize(
    ("dims", "min_samples", "alpha", "eps", "rows"),
    [(3, 1, 0.5, 0.2, 16), (3, 2, 1.0, 0.12, 16), (5, 1, 1.5, 0.15, 40), (1, 1, 1.0, 0.01, 30)],
)
def test_density_labels_against_all_pairs(spark, dims, min_samples, alpha, eps, rows):
    vectors = blobs(dims=dims)
    df = table(spark, vectors)
    out = clusters.density_labels(df, 2, min_samples, eps, alpha, tile_rows=rows).orderBy("category").collect()
    label, prob = plain_labels(vectors, 2, min_samples, eps, alpha)
    assert [r.cluster for r in out] == label
    assert [r.probability for r in out] == pytest.approx(prob)


def test_equal_points_and_singletons(spark):
    out = clusters.density_labels(table(spark, [[0, 0], [0, 0], [9, 9], [0.3, 0]]), eps=0.5, alpha=1.0).orderBy("category").collect()
    assert [(r.cluster, r.probability) for r in out] == [(0, 1.0), (0, 1.0), (-1, 0.0), (0, 0.0)]


@pytest.mark.parametrize("min_samples", [1, 3])
def test_a_third_of_the_points_are_copies(spark, min_samples):
    vectors = np.concatenate([np.tile([5.0, 5.0, 5.0], (30, 1)), np.tile([-3.0, 0.0, 0.0], (2, 1)), blobs(seed=9, n=60)])
    out = clusters.density_labels(table(spark, vectors), 2, min_samples, 0.2, 1.0, tile_rows=8).orderBy("category").collect()
    label, prob = plain_labels(vectors, 2, min_samples, 0.2, 1.0)
    assert [r.cluster for r in out] == label
    assert [r.probability for r in out] == pytest.approx(prob)


def test_nothing_but_noise(spark):
    out = clusters.density_labels(table(spark, [[0.0], [10.0], [20.0]]), eps=0.5).collect()
    assert [(r.cluster, r.probability) for r in out] == [(-1, 0.0)] * 3


def test_connected_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 80)]
    loose = [(rng.randrange(2000, 2050), rng.randrange(2000, 2050)) for _ in range(40)]
    edges = chain + star + loose
    out = {r.node: r.root for r in clusters.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    expected = {}
    for a, b in edges:
        expected.setdefault(a, {a}), expected.setdefault(b, {b})
        union = expected[a] | expected[b]
        for x in union:
            expected[x] = union
    assert out == {x: min(group) for x, group in expected.items() if len(group) > 1}


def plain_silhouettes(vectors, labels):
    d = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(-1))
    labels, out = np.array(labels), []
    for i, c in enumerate(labels):
        if (labels == c).sum() == 1:
            out.append(0.0)
            continue
        a = d[i][labels == c].sum() / ((labels == c).sum() - 1)
        b = min(d[i][labels == o].mean() for o in set(labels) - {c})
        out.append((b - a) / max(a, b))
    return out


@pytest.mark.parametrize("rows", [10, 2048])
def test_silhouettes_with_small_tiles(spark, rows):
    vectors = blobs(seed=4, n=90)
    labels = [0] * 40 + [i % 5 - 1 for i in range(49)] + [77]
    df = table(spark, vectors, labels)
    out = validity.silhouette_samples(df, tile_rows=rows).orderBy("category").collect()
    assert [r.silhouette for r in out] == pytest.approx(plain_silhouettes(vectors, labels))
    keep = [i for i, c in enumerate(labels) if c != -1]
    score = validity.silhouette_score(df, tile_rows=rows).first()[0]
    assert score == pytest.approx(np.mean(plain_silhouettes(vectors[keep], [labels[i] for i in keep])))


def test_davies_bouldin_and_calinski(spark):
    vectors, labels = [[0, 0], [0, 2], [10, 0], [10, 2], [99, 99]], [0, 0, 1, 1, -1]
    df = table(spark, vectors, labels)
    assert validity.davies_bouldin(df).first()[0] == pytest.approx((1 + 1) / 10)
    assert validity.davies_bouldin(df, tile_rows=1).first()[0] == pytest.approx(0.2)
    assert validity.calinski_harabasz(df).first()[0] == pytest.approx((4 * 25 / 1) / (4 / 2))


def test_one_cluster_has_no_measures(spark):
    df = table(spark, [[0, 0], [0, 1]], [0, 0])
    row = validity.silhouette_score(df).first(), validity.calinski_harabasz(df).first(), validity.davies_bouldin(df).first()
    assert [r[0] for r in row] == [None] * 3


def test_thirty_three_categories_end_to_end(spark, tmp_path):
    rng = np.random.default_rng(0)
    spots = rng.normal(size=(4, 16))
    vectors = [spots[i % 4] + rng.normal(scale=0.05, size=16) for i in range(33)]
    points = table(spark, vectors).drop("cluster")
    reviews = points.select("category", F.explode(F.sequence(F.lit(1), F.lit(9))).alias("n")).withColumn(
        "asin", F.concat("category", (F.col("n") % 3).cast("string"))
    )
    assert tuple(stats.corpus_profile(reviews).first()) == (297, 99, 33)
    run = cluster_categories(reviews, points, eps=0.5, alpha=1.0)
    labels = run.labels.collect()
    assert len(labels) == 33 and {r.cluster for r in labels} == {0, 1, 2, 3}
    assert run.points.first().vector.__len__() == 3
    metrics = run.metrics.first()
    assert metrics.n_clusters == 4 and metrics.noise_ratio == 0 and 0.5 < metrics.silhouette <= 1
    assert metrics.calinski_harabasz > 0 and metrics.davies_bouldin > 0 and metrics.stability_score is None
    assert run.reviews.where("meta_category is null").count() == 0
    path = str(tmp_path / "model")
    clusters.save_clustering(run.reducer, run.labels, path)
    again = {r.category: r.cluster for r in clusters.apply_saved_model(points, path, eps=0.5, alpha=1.0).collect()}
    assert again == {r.category: r.cluster for r in labels}


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [("a", 0, 1.0), ("b", 0, 0.5), ("c", 0, 0.9), ("d", 1, 1.0), ("e", 1, 1.0), ("f", -1, 0.0), ("g", 7, 0.4)]
    return spark.createDataFrame(rows, "category string, cluster int, probability double")


def test_cluster_statistics(labelled):
    sizes = {r.cluster: (r.n_categories, r.share) for r in stats.cluster_sizes(labelled).collect()}
    assert sizes == {0: (3, 3 / 7), 1: (2, 2 / 7), 7: (1, 1 / 7)}
    assert tuple(stats.noise_report(labelled).first()) == (3, 1, 1 / 7, None)
    assert [r.category for r in stats.noise_categories(labelled).collect()] == ["f"]
    low = {r.cluster: (r.avg_probability, r.min_probability) for r in stats.cluster_probability(labelled).collect()}
    assert low[0] == (pytest.approx(0.8), 0.5)
    mean, std = stats.probability_moments(labelled).first()
    values = [1.0, 0.5, 0.9, 1.0, 1.0, 0.0, 0.4]
    assert (mean, std) == (pytest.approx(np.mean(values)), pytest.approx(np.std(values)))
    first = {r.cluster: r.top_categories for r in cluster_top_categories(labelled, 2).collect()}
    assert first == {0: "a, b", 1: "d, e", 7: "g"}


def test_report_tables(labelled):
    rollup = {(r.meta_name, r.category): r.n_categories for r in stats.category_rollup(labelled).collect()}
    assert rollup[(None, None)] == 6 and rollup[("Entertainment & General Retail", None)] == 3 and rollup[("cluster 7", "g")] == 1
    graph = report.category_graph(labelled).collect()
    assert sum(r.kind == "edge" for r in graph) == 5
    assert {r["size"] for r in graph if r.node_type == "meta"} == {2000} and sum(r.node_type == "meta" for r in graph) == 5
    tree = {(r.meta_name, r.category): r.probability for r in report.treemap_rows(labelled).collect()}
    assert tree[(None, None)] == pytest.approx(4.4)
    contents = report.cluster_contents(labelled).collect()
    assert sum(r.category is None for r in contents) == 3 and len(contents) == 8
    bars = {r.metric: r.value for r in report.metric_bars(stats.noise_report(labelled)).collect()}
    assert bars == {"n_clusters": 3.0, "n_noise": 1.0, "noise_ratio": 1 / 7}


def test_probability_density(labelled):
    out = stats.probability_density(labelled).collect()
    assert {r.cluster for r in out} == {0} and len(out) == 200  # no spread, no curve
    values = np.array([1.0, 0.5, 0.9])
    h = values.std(ddof=1) * 3 ** (-1 / 5)
    for r in (out[0], out[100]):
        density = np.exp(-(((r.x - values) / h) ** 2) / 2).sum() / (3 * h * math.sqrt(2 * math.pi))
        assert r.density == pytest.approx(density)


def test_silhouette_profile(spark):
    rows = [("a", 0, 0.5), ("b", 0, -0.2), ("c", 1, 0.1), ("n", -1, 0.9)]
    df = spark.createDataFrame(rows, "category string, cluster int, silhouette double")
    out = {r.category: (r["rank"], r.y) for r in silhouette_profile(df).collect()}
    assert out == {"b": (1, 10), "a": (2, 11), "c": (1, 22)}


def test_tiles_stay_bounded(spark):
    df = table(spark, np.zeros((100, 3)), [0] * 80 + [1] * 15 + [2] * 5)
    tiled, n = tiles.cluster_tiles(df, "cluster", "category", 20)
    sizes = [r["count"] for r in tiled.where("not _whole").groupBy("_tile").count().collect()]
    assert sum(sizes) == 80 and len(sizes) >= 3 and max(r._tile for r in tiled.collect()) < n
    placed, pairs = tiles.near_tiles(df, "vector", "category", 0.1, 20)
    assert placed.select("_tile").distinct().count() >= 4
    assert pairs.count() == 25  # five tiles of one crowded cell against each other


def test_one_far_point_does_not_widen_the_grid(spark):
    from reviewloom.operators.tiles import near_tiles

    def met(far: bool) -> int:
        rows = [(f"p{i:05d}", [(i * 37 % 1000) / 100, (i * 91 % 1000) / 100]) for i in range(4000)]
        rows += [("far", [1e6, 1e6])] if far else []
        tiled, pairs = near_tiles(spark.createDataFrame(rows, "key string, vector array<double>"), "vector", "key", 0.05, 64)
        sizes = tiled.groupBy("_tile").count()
        left, right = sizes.toDF("_lt", "x"), sizes.toDF("_rt", "y")
        return pairs.join(left, "_lt").join(right, "_rt").agg(F.sum(F.col("x") * F.col("y"))).first()[0]

    alone, with_far = met(False), met(True)
    assert abs(with_far - alone) <= 0.1 * alone and alone < 0.2 * 4000**2


def test_least_linked_follows_chains():

    from reviewloom.operators.clusters import _least_linked

    n = 300
    link = np.zeros((n, n), bool)
    order = np.random.default_rng(1).permutation(n)
    for x, y in zip(order[:150], order[1:150]):  # one long chain; the other half stays alone
        link[x, y] = True
    root = _least_linked(link, np.arange(n), np.arange(n), n)
    assert set(root[order[:150]]) == {order[:150].min()} and (root[order[150:]] == order[150:]).all()


def test_distances_by_product_keep_near_points_and_edges():
    rng = np.random.default_rng(3)
    left = rng.normal(size=(300, 20)) + 1e4
    right = np.concatenate([left[:40], left[40:80] + 1e-7, rng.normal(size=(200, 20)) + 1e4])
    want = np.sqrt(((left[:, None] - right[None]) ** 2).sum(-1))
    got = tiles.distances(left, right)
    assert (got[np.arange(40), np.arange(40)] == 0).all()
    assert np.allclose(got, want, rtol=1e-9, atol=0)
    gap = left[100] - right[200]
    edge = np.sqrt(np.einsum("i,i", gap, gap))
    assert tiles.distances(left, right, edge)[100, 200] == edge
    left[0, 0] = np.nan
    odd = np.isnan(tiles.distances(left, right))
    assert odd[0].all() and not odd[1:].any()


def test_two_tiles_meet_once(spark):
    import pandas as pd

    rows = spark.createDataFrame([(i, i % 5) for i in range(50)], "key long, _tile int")

    def block(left, right):
        return pd.DataFrame({"a": [left["_lt"].iloc[0]], "b": [right["_rt"].iloc[0]], "n": [len(left) * len(right)]})

    out = tiles.tiles_once(rows, 5, block, "a int, b int, n long").collect()
    assert sorted((r.a, r.b) for r in out) == [(a, b) for a in range(5) for b in range(a, 5)] and {r.n for r in out} == {100}


@pytest.mark.parametrize("min_samples", [1, 3])
def test_many_coordinates_against_all_pairs(spark, min_samples):
    vectors = blobs(seed=6, n=90, dims=12)
    out = clusters.density_labels(table(spark, vectors), 2, min_samples, 0.4, 1.0, tile_rows=32).orderBy("category").collect()
    label, prob = plain_labels(vectors, 2, min_samples, 0.4, 1.0)
    assert [r.cluster for r in out] == label
    assert [r.probability for r in out] == pytest.approx(prob)
