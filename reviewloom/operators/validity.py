"""Cluster validity measures (Euclidean, exact)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.contracts import NOISE
from reviewloom.operators.tiles import (
    SPREAD,
    TILE_ROWS,
    WIDE_TILE,
    cluster_tiles,
    distance_slices,
    distances,
    even_tiles,
    matrix,
    tile_against_tile,
    tiles_once,
)
from reviewloom.staging import settle

MANY = 64  # clusters of a tile whose sums over another tile are held at once


def _square_gap(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x)


class _Sums:
    """Distance sums of the points of one tile to the clusters of another, as they are finished.

    A cluster that lies wholly in the other tile is finished here: only the nearest of
    those is kept, and the own cluster's sum. A spread cluster's part is kept as it is.
    """

    def __init__(self, other: pd.DataFrame):
        """``other`` is sorted by ``code``, the number of its cluster in the tile."""
        first = other.drop_duplicates("code")
        self.clusters, self.whole = first["cluster"].to_numpy(), first["_whole"].to_numpy().astype(bool)
        self.sizes = other.groupby("code").size().to_numpy()
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.out: list[pd.DataFrame] = []

    def _emit(self, keys: np.ndarray, sums: np.ndarray, row: np.ndarray, col: np.ndarray) -> None:
        self.out.append(
            pd.DataFrame({"key": keys[row], "other": self.clusters[col], "total": sums[row, col], "n": self.sizes[col].astype("int64")})
        )

    def add(self, keys: np.ndarray, own_cluster: np.ndarray, sums: np.ndarray) -> None:
        own = own_cluster[:, None] == self.clusters[None, :]
        self._emit(keys, sums, *np.nonzero(own | ~self.whole[None, :]))
        rivals = np.where(self.whole[None, :] & ~own, sums / self.sizes, np.inf)
        nearest = rivals.argmin(axis=1)
        row = np.nonzero(np.isfinite(rivals[np.arange(len(keys)), nearest]))[0]
        self._emit(keys, sums, row, nearest[row])


def _sorted(tile: pd.DataFrame) -> pd.DataFrame:
    code = np.unique(tile["cluster"].to_numpy(), return_inverse=True)[1]
    return tile.assign(code=code).sort_values("code", kind="stable", ignore_index=True)


def _silhouette_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Distance sums of the points of two tiles to each other's clusters; distances are taken once,
    unless the left tile holds so many clusters that their sums would not fit."""
    itself = left["_lt"].iloc[0] == left["_rt"].iloc[0]
    left, right = _sorted(left), _sorted(right)
    back = not itself and left["code"].iloc[-1] < MANY
    found = _one_way(left, right, back)
    if not itself and not back:
        found += _one_way(right, left, False)
    return pd.concat(found, ignore_index=True)


def _one_way(left: pd.DataFrame, right: pd.DataFrame, back: bool) -> list[pd.DataFrame]:
    """Sums of the left points and, with ``back``, those of the right points to the left tile."""
    there, here = _Sums(right), _Sums(left)
    keys, clusters, code = left["key"].to_numpy(), left["cluster"].to_numpy(), left["code"].to_numpy()
    returned = np.zeros((len(right), len(here.sizes))) if back else None
    for cut, gap in distance_slices(matrix(left["vector"]), matrix(right["vector"])):
        there.add(keys[cut], clusters[cut], np.add.reduceat(gap, there.starts, axis=1))
        if back:
            member = np.zeros((len(gap), len(here.sizes)))
            member[np.arange(len(gap)), code[cut]] = 1.0
            returned += gap.T @ member
    if back:
        here.add(right["key"].to_numpy(), right["cluster"].to_numpy(), returned)
    return there.out + here.out


def silhouette_samples(
    points: DataFrame, key: str = "category", vector: str = "vector", tile_rows: int = WIDE_TILE
) -> DataFrame:
    """Silhouette of every point; noise counts as one more cluster.

    A lone point of a cluster has silhouette 0.
    """
    types = dict(points.dtypes)
    base = settle(
        points.select(
            F.col(key).alias("key"),
            F.col("cluster"),
            F.col(vector).cast("array<double>").alias("vector"),
        ),
        "points",
    )
    rows = min(tile_rows, max(TILE_ROWS, math.ceil(base.count() / SPREAD)))
    tiled, n_tiles = cluster_tiles(base, "cluster", "key", rows)
    schema = f"key {types[key]}, other {types['cluster']}, total double, n bigint"
    sums = tiles_once(tiled, n_tiles, _silhouette_block, schema)
    means = sums.groupBy("key", "other").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    own = F.col("other") == F.col("cluster")
    inner = F.max(F.when(own, F.try_divide(F.col("total"), F.col("n") - 1)))
    alone = F.max(F.when(own, F.col("n"))) == 1
    outer = F.min(F.when(~own, F.col("total") / F.col("n")))
    joined = means.join(base.select("key", "cluster"), "key")
    scored = joined.groupBy("key", "cluster").agg(inner.alias("a"), outer.alias("b"), alone.alias("alone"))
    value = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    return scored.select(
        F.col("key").alias(key), "cluster", F.when(F.col("alone"), 0.0).otherwise(value).alias("silhouette")
    )


def _centroid_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Distance of each point to its own centroid, if it is here, and to the nearest other one."""
    gap = distances(matrix(left["vector"]), matrix(right["centroid"]))
    own = left["cluster"].to_numpy()[:, None] == right["cluster"].to_numpy()[None, :]
    inner, outer = np.where(own, gap, np.inf).min(axis=1), np.where(own, np.inf, gap).min(axis=1)
    size = np.where(own, right["n"].to_numpy()[None, :], 0).max(axis=1)
    return pd.DataFrame({"key": left["key"], "a": inner, "b": outer, "n": size})


def centroid_silhouettes(
    points: DataFrame, key: str = "category", vector: str = "vector", tile_rows: int = TILE_ROWS
) -> DataFrame:
    """Simplified silhouette of every point, from distances to centroids instead of to all points.

    The work grows with points times clusters. Noise counts as one more cluster; a lone point of a
    cluster, and every point of the only cluster, has 0.
    """
    kind = dict(points.dtypes)[key]
    base = points.select(F.col(key).alias("key"), "cluster", F.col(vector).cast("array<double>").alias("vector"))
    base = settle(base, "points")
    left, n_left = even_tiles(base, "key", tile_rows)
    right, n_right = even_tiles(_centroids(base, "vector"), "cluster", tile_rows)
    near = tile_against_tile(left, n_left, right, n_right, _centroid_block, f"key {kind}, a double, b double, n bigint")
    least = near.groupBy("key").agg(F.min("a").alias("a"), F.min("b").alias("b"), F.max("n").alias("n"))
    value = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    real = (F.col("n") > 1) & (F.col("b") < float("inf"))
    scored = least.select("key", F.when(real, value).otherwise(0.0).alias("silhouette"))
    return base.select("key", "cluster").join(scored, "key").select(F.col("key").alias(key), "cluster", "silhouette")


def _several(df: DataFrame) -> DataFrame:
    """Points that are not noise."""
    return df.where(F.col("cluster") != NOISE)


def silhouette_score(points: DataFrame, **params) -> DataFrame:
    """Mean silhouette without noise; null unless there are two clusters."""
    samples = silhouette_samples(_several(points), **params)
    sums = samples.groupBy("cluster").agg(F.sum("silhouette").alias("s"), F.count("*").alias("n"))
    score = F.try_divide(F.sum("s"), F.sum("n"))
    return sums.agg(F.when(F.count("*") > 1, score).alias("silhouette"))


def _centroids(points: DataFrame, vector: str) -> DataFrame:
    mean = Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))
    table = points.groupBy("cluster").agg(vector_to_array(mean).alias("centroid"), F.count("*").alias("n"))
    return settle(table, "centroids")


def calinski_harabasz(points: DataFrame, vector: str = "vector") -> DataFrame:
    """Between-cluster over within-cluster dispersion; null unless two clusters."""
    real = _several(points)
    centroids = _centroids(real, vector)
    weighted = centroids.select(F.posexplode("centroid").alias("dim", "x"), "n", "cluster")
    centre = weighted.groupBy("dim").agg((F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("c"))
    off = F.col("n") * (F.col("x") - F.col("c")) * (F.col("x") - F.col("c"))
    between = weighted.join(centre, "dim").agg(F.sum(off).alias("between"))
    spread = real.select("cluster", F.col(vector).cast("array<double>").alias("v")).join(centroids, "cluster")
    within = spread.agg(F.sum(_square_gap(F.col("v"), F.col("centroid"))).alias("within"))
    size = centroids.agg(F.count("*").alias("k"), F.sum("n").alias("n"))
    k, n = F.col("k"), F.col("n")
    parts = size.select(
        "k", "n", between.scalar().alias("between"), within.scalar().alias("within")
    )
    ratio = F.try_divide(F.col("between") / (k - 1), F.col("within") / (n - k))
    return parts.select(F.when(k > 1, F.coalesce(ratio, F.lit(1.0))).alias("calinski_harabasz"))


def _worst_rival_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    gap = distances(matrix(left["centroid"]), matrix(right["centroid"]))
    gap[gap == 0] = np.inf
    both = left["scatter"].to_numpy()[:, None] + right["scatter"].to_numpy()[None, :]
    worst = (both / gap).max(axis=1) if gap.shape[1] else np.zeros(len(left))
    return pd.DataFrame({"cluster": left["cluster"], "worst": worst})


def davies_bouldin(points: DataFrame, vector: str = "vector", tile_rows: int = TILE_ROWS) -> DataFrame:
    """Mean over clusters of the worst similarity to another; null unless two clusters."""
    real = _several(points)
    centroids = _centroids(real, vector)
    gaps = real.select("cluster", F.col(vector).cast("array<double>").alias("v")).join(centroids, "cluster")
    scatter = gaps.groupBy("cluster").agg(F.avg(F.sqrt(_square_gap(F.col("v"), F.col("centroid")))).alias("scatter"))
    table = settle(centroids.select("cluster", "centroid").join(scatter, "cluster"), "scatter")
    tiled, n = even_tiles(table, "cluster", tile_rows)
    kind = dict(points.dtypes)["cluster"]
    blocks = tile_against_tile(tiled, n, tiled, n, _worst_rival_block, f"cluster {kind}, worst double")
    worst = blocks.groupBy("cluster").agg(F.max("worst").alias("worst"))
    return worst.agg(F.when(F.count("*") > 1, F.avg("worst")).alias("davies_bouldin"))


def validity_metrics(points: DataFrame, **params) -> DataFrame:
    """All measures of a clustering in one row."""
    from reviewloom.operators.stats import noise_report, probability_moments

    report = noise_report(points)
    moments = probability_moments(points)
    columns = [
        silhouette_score(points, **params).scalar().alias("silhouette"),
        calinski_harabasz(points).scalar().alias("calinski_harabasz"),
        davies_bouldin(points).scalar().alias("davies_bouldin"),
        moments.select("mean_probability").scalar().alias("mean_probability"),
    ]
    return report.select("n_clusters", "noise_ratio", *columns, "stability_score")
