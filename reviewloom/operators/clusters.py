"""Category vectors, projection, density clusters and membership."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from reviewloom.contracts import NOISE
from reviewloom.functions.text import normalize_text, words
from reviewloom.operators.components import connected_components, joined
from reviewloom.operators.ranks import range_positions
from reviewloom.operators.reachability import TREE_TILE, core_distances, tree_edges
from reviewloom.operators.tiles import FEW_DIMS, SPREAD, TILE_ROWS, WIDE_TILE, distance_slices, matrix, near_blocks, near_tiles
from reviewloom.staging import settle


def category_vectors(df: DataFrame, group: str = "category", vector: str = "vector") -> DataFrame:
    """Mean vector of each category, combined on the map side."""
    mean = Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))
    return df.groupBy(group).agg(vector_to_array(mean).alias(vector))


def category_text_vectors(
    reviews: DataFrame, text: str = "text", group: str = "category", dims: int = 256
) -> DataFrame:
    """A vector per category from the words of its reviews (hashed tf-idf, averaged)."""
    tokens = reviews.select(group, words(normalize_text(F.col(text))).alias("_words"))
    hashed = HashingTF(numFeatures=dims, inputCol="_words", outputCol="_tf").transform(tokens)
    hashed = settle(hashed.select(group, "_tf"), "hashed")  # one pass over the texts
    weighted = IDF(inputCol="_tf", outputCol="_tfidf").fit(hashed).transform(hashed)
    unit = Normalizer(inputCol="_tfidf", outputCol="_unit").transform(weighted)
    return unit.groupBy(group).agg(vector_to_array(Summarizer.mean(F.col("_unit"))).alias("vector"))


def fit_reducer(vectors: DataFrame, k: int = 3, vector: str = "vector") -> PipelineModel:
    """Unit length (so that angles count), then the ``k`` leading components."""
    ready = vectors.withColumn("_raw", array_to_vector(F.col(vector).cast("array<double>")))
    steps = [
        Normalizer(inputCol="_raw", outputCol="_unit"),
        PCA(k=k, inputCol="_unit", outputCol="_pca"),
    ]
    return Pipeline(stages=steps).fit(ready)


def reduce_with(model: PipelineModel, vectors: DataFrame, vector: str = "vector") -> DataFrame:
    """Replace the vectors by their projection."""
    ready = vectors.withColumn("_raw", array_to_vector(F.col(vector).cast("array<double>")))
    out = model.transform(ready).withColumn(vector, vector_to_array("_pca"))
    return out.drop("_raw", "_unit", "_pca")


def reduce_dims(vectors: DataFrame, k: int = 3, vector: str = "vector") -> DataFrame:
    return reduce_with(fit_reducer(vectors, k, vector), vectors, vector)


# ------------------------------------------------------------- density clusters


def _itself(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray | None:
    """Place of each left point among the right ones if both are the same tile."""
    if left["_lt"].iloc[0] != left["_rt"].iloc[0]:
        return None
    place = pd.Series(np.arange(len(right)), index=right["key"].to_numpy())
    return place[left["key"].to_numpy()].to_numpy()


def _core_block(k: int, radius: float):
    """Up to ``k`` nearest points within ``radius`` of each point of two tiles in the other one."""

    def nearest(gap: np.ndarray, few: int) -> np.ndarray:
        return gap.argmin(axis=0)[None, :] if few == 1 else np.argpartition(gap, few - 1, axis=0)[:few]

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        same, out = _itself(left, right), []
        a, b = left["key"].to_numpy(), right["key"].to_numpy()
        copies_a, copies_b = left["n"].to_numpy(), right["n"].to_numpy()
        least, n = np.empty((0, len(right))), np.empty((0, len(right)), dtype="int64")  # nearest left points of each right one

        def emit(keys: np.ndarray, gap: np.ndarray, copies: np.ndarray) -> None:
            row, col = np.nonzero(gap <= radius)
            out.append(pd.DataFrame({"key": keys[col], "distance": gap[row, col], "n": copies[row, col]}))

        for cut, gap in distance_slices(matrix(left["vector"]), matrix(right["vector"]), radius):
            if same is not None:
                gap[np.arange(len(gap)), same[cut]] = np.inf
            near = nearest(gap.T, min(k, len(b)))
            emit(a[cut], np.take_along_axis(gap.T, near, axis=0), copies_b[near])
            if same is None:
                near = nearest(gap, min(k, len(gap)))
                least = np.concatenate([least, np.take_along_axis(gap, near, axis=0)])
                n = np.concatenate([n, copies_a[cut][near]])
                if len(least) > k:
                    near = nearest(least, k)
                    least, n = np.take_along_axis(least, near, axis=0), np.take_along_axis(n, near, axis=0)
        emit(b, least, n)
        return pd.concat(out, ignore_index=True)

    return block


def _least_linked(link: np.ndarray, rows: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
    """Least number linked to each of ``n`` numbers, directly or not; ``link`` holds rows against columns.

    Every round hands the least number on along all links at once and then follows it to
    the end, so chains shrink by more than half.
    """
    root = np.arange(n)
    while link.size:
        new = root.copy()
        low = np.minimum(root[columns], np.where(link, root[rows][:, None], n).min(axis=0))
        np.minimum.at(new, root[columns], low)
        np.minimum.at(new, columns, low)
        low = np.minimum(root[rows], np.where(link, new[columns][None, :], n).min(axis=1))
        np.minimum.at(new, root[rows], low)
        np.minimum.at(new, rows, low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _link_block(eps: float, alpha: float):
    """Mutual reachability between two tiles, reduced to their components.

    Returns one row per point with its smallest mutual reachability (``root``
    null), and one row per member of a component with the component's smallest key.
    """

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        same = _itself(left, right)
        a, b = left["key"].to_numpy(), right["key"].to_numpy()
        core_a, core_b = left["core"].to_numpy(), right["core"].to_numpy()
        every, code = np.unique(np.concatenate([a, b]), return_inverse=True)
        code_a, code_b = code[: len(a)], code[len(a) :]
        best_a, best_b = np.empty(len(a)), np.full(len(b), np.inf)
        one, two = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for cut, reach in distance_slices(matrix(left["vector"]), matrix(right["vector"]), eps * alpha):
            reach /= alpha
            np.maximum(reach, core_a[cut][:, None], out=reach)
            np.maximum(reach, core_b[None, :], out=reach)
            if same is not None:
                reach[np.arange(len(reach)), same[cut]] = np.inf
            best_a[cut] = reach.min(axis=1)
            np.minimum(best_b, reach.min(axis=0), out=best_b)
            link = reach <= eps
            if np.count_nonzero(link) <= 4 * sum(link.shape):
                i, j = np.nonzero(link)
                one.append(code_a[cut][i]), two.append(code_b[j])
            else:  # a slice's links are too many: keep who belongs together
                member, other = link.any(axis=1), link.any(axis=0)
                involved = np.concatenate([code_a[cut][member], code_b[other]])
                root = _least_linked(link[member], code_a[cut][member], code_b, len(every))
                one.append(involved), two.append(root[involved])
        one, two = np.concatenate(one), np.concatenate(two)
        found = np.unique(np.concatenate([one, two]))
        root = joined(one, two, len(every))
        keys, best = (a, best_a) if same is not None else (np.concatenate([a, b]), np.concatenate([best_a, best_b]))
        kept = best <= eps
        return pd.DataFrame(
            {
                "key": np.concatenate([keys[kept], every[found].astype(keys.dtype)]),
                "root": np.concatenate([np.full(kept.sum(), None, dtype=object), every[root[found]].astype(object)]),
                "reach": np.concatenate([best[kept], np.full(len(found), np.nan)]),
            }
        )

    return block


def _few_links(point: DataFrame, min_samples: int, eps: float, alpha: float, rows: int) -> tuple[DataFrame, DataFrame]:
    """Core distances within ``eps`` (``key, core``) and the spanning forest up to ``eps``, from both ends: ``a, b, reach``.

    The shortest edge of the forest at a point is its smallest mutual reachability.
    """
    cored = settle(core_distances(point.select("key", "n", "vector"), min_samples, rows, eps).where(F.col("core") <= eps), "core")
    edges = settle(tree_edges(cored, alpha, rows, eps).withColumnRenamed("weight", "reach"), "edges")
    return cored.select("key", "core"), edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "reach"))


def _wide_links(
    point: DataFrame, n: int, min_samples: int, eps: float, alpha: float, tile_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Like :func:`_few_links` for many coordinates. ``b`` is a member of the same component with null ``reach``,
    or null beside the smallest mutual reachability of ``a``."""
    key_type, radius = dict(point.dtypes)["key"], eps * max(1.0, alpha)
    # cells do not tell many coordinates apart: there fewer tiles move less
    widest = max(TILE_ROWS, math.ceil(n / SPREAD))
    tiled, pairs = near_tiles(point, "vector", "key", radius, min(tile_rows, widest))
    pairs = settle(pairs.where("_lt <= _rt"), "pairs")
    tiled = settle(tiled, "tiled")
    near = near_blocks(
        tiled, tiled, pairs, _core_block(min_samples, radius), f"key {key_type}, distance double, n bigint"
    )
    copies = point.where("n > 1").select("key", F.lit(0.0).alias("distance"), (F.col("n") - 1).alias("n"))
    core = settle(_core_distance(near.unionByName(copies), min_samples).where(F.col("core") <= eps), "core")
    dense = tiled.join(core, "key")
    links = settle(
        near_blocks(dense, dense, pairs, _link_block(eps, alpha), f"key {key_type}, root {key_type}, reach double"),
        "links",
    )
    return core, links.select(F.col("key").alias("a"), F.col("root").alias("b"), "reach")


def density_labels(
    points: DataFrame,
    min_size: int = 2,
    min_samples: int = 1,
    eps: float = 0.5,
    alpha: float = 0.5,
    key: str = "category",
    vector: str = "vector",
    tile_rows: int = WIDE_TILE,
) -> DataFrame:
    """Cluster id and membership probability of every point.

    Core distance is the distance to the ``min_samples``-th other point; mutual
    reachability of two points is the largest of their core distances and their
    distance divided by ``alpha``. Clusters are the components linked at ``eps`` or
    less with at least ``min_size`` points, numbered by their smallest key; all other
    points are noise (-1). Probability is the cluster's smallest reachability over
    the point's own, 0 for noise.
    """
    base = points.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    # equal vectors share one point, so that many copies of one do not face each other
    point = base.groupBy("vector").agg(F.min("key").alias("key"), F.count("*").alias("n"))
    point = settle(point, "points")
    shape = point.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dims")).first()
    if (shape["dims"] or 0) <= FEW_DIMS:
        core, edges = _few_links(point, min_samples, eps, alpha, min(tile_rows, TREE_TILE))
    else:
        core, edges = _wide_links(point, shape["n"], min_samples, eps, alpha, tile_rows)
    linked = connected_components(edges.where("b is not null").select("a", "b"))
    reach = edges.groupBy(F.col("a").alias("key")).agg(F.min("reach").alias("reach"))
    # a copy reaches its own copies at its core distance
    own = point.join(core, "key").select("key", "n", F.when(F.col("n") > 1, F.col("core")).alias("own"))
    members = (
        own.join(linked.withColumnRenamed("node", "key"), "key", "left")
        .join(reach, "key", "left")
        .select("key", "n", F.coalesce("root", "key").alias("root"), F.least("reach", "own").alias("reach"))
    )
    sizes = members.groupBy("root").agg(F.sum("n").alias("size"), F.min("reach").alias("best"))
    numbered = range_positions(sizes.where(F.col("size") >= min_size), [], ["root"], "_id")
    share = F.when(F.col("reach") == 0, 1.0).otherwise(F.col("best") / F.col("reach"))
    scored = members.join(numbered, "root").select(
        "key", (F.col("_id") - 1).cast("int").alias("cluster"), share.alias("probability")
    )
    result = point.join(scored, "key", "left").select(
        "vector",
        F.coalesce("cluster", F.lit(NOISE)).alias("cluster"),
        F.coalesce("probability", F.lit(0.0)).alias("probability"),
    )
    return base.join(result, "vector").select(F.col("key").alias(key), "cluster", "probability")


def _core_distance(near: DataFrame, k: int) -> DataFrame:
    """Distance to the ``k``-th neighbour; ``n`` neighbours may share a row."""
    if k == 1:
        return near.groupBy("key").agg(F.min("distance").alias("core"))
    running = W.partitionBy("key").orderBy("distance").rowsBetween(W.unboundedPreceding, 0)
    enough = near.withColumn("_seen", F.sum("n").over(running)).where(F.col("_seen") >= k)
    return enough.groupBy("key").agg(F.min("distance").alias("core"))


def density_cluster(points: DataFrame, **params) -> DataFrame:
    """Cluster ids only; see :func:`density_labels`."""
    key = params.get("key", "category")
    return density_labels(points, **params).select(key, "cluster")


def membership_probability(points: DataFrame, **params) -> DataFrame:
    """Membership probabilities only; see :func:`density_labels`."""
    key = params.get("key", "category")
    return density_labels(points, **params).select(key, "probability")


# ---------------------------------------------------------------- saved models


def save_clustering(model: PipelineModel, labels: DataFrame, path: str) -> None:
    """Store the projection and the label table of a clustering run."""
    model.write().overwrite().save(f"{path}/reducer")
    labels.write.mode("overwrite").parquet(f"{path}/labels")


def load_clustering(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/reducer"), spark.read.parquet(f"{path}/labels")


def apply_saved_model(vectors: DataFrame, path: str, **params) -> DataFrame:
    """Project with the stored reducer and cluster the projection again."""
    model, _ = load_clustering(vectors.sparkSession, path)
    return density_labels(reduce_with(model, vectors), **params)
