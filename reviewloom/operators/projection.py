"""Non-linear projection: neighbour graph, fuzzy weights, spectral layout, refined by forces.

- **Neighbours** by NN-descent: a node's neighbours, and nodes that have it as theirs, are likely
  neighbours of each other. Every round hands each node a bounded list of those with their
  vectors; a task compares the lists' members and keeps what is nearer than before. The start, and a
  little of every round, are random groups of bounded size.
- **Weights**: the nearest neighbour has full weight, farther ones fade so that a node's weights sum to
  the logarithm of their number; both directions of a link are joined.
- **Layout**: leading eigenvectors of the normalised graph by power iteration, filtered by
  Chebyshev polynomials. A step is one join and one sum per node; only the few numbers of
  the small Gram matrices reach the driver.
- **Forces**: links pull, members of random groups push, for a few steps of falling size.

Everything grows with nodes times neighbours; no list is longer than a parameter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from reviewloom.operators.spectra import column_names, eigenpairs, mixed, orthonormal, product
from reviewloom.staging import settle


@dataclass(frozen=True)
class Layout:
    """Parameters: neighbours of a node, coordinates, closeness of linked points, angles or distances, seed."""

    neighbors: int = 5
    dims: int = 3
    min_dist: float = 0.01
    metric: str = "cosine"
    seed: int = 42
    rounds: int = 8  # of NN-descent, at most
    settled: float = 0.001  # share of changed links at which NN-descent ends
    filters: int = 4  # Chebyshev filters
    degree: int = 5  # steps of a filter
    spare: int = 4  # further eigenvectors that are carried along
    epochs: int = 8  # steps of the forces


# ------------------------------------------------------------------ neighbours


def _nearest_of_lists(k: int, metric: str):
    """Compare the members of every list; keep each member's ``k`` nearest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            node, other, gaps = [], [], []
            for members in batch["members"]:
                keys = np.array([m["key"] for m in members], dtype=object)
                if len(keys) < 2:
                    continue
                points = np.array([m["vector"] for m in members], dtype=np.float64)
                gap = _gaps(points, metric)
                np.fill_diagonal(gap, np.inf)
                few = min(k, len(keys) - 1)
                near = np.argpartition(gap, few - 1, axis=1)[:, :few]
                node.append(np.repeat(keys, few)), other.append(keys[near.reshape(-1)])
                gaps.append(np.take_along_axis(gap, near, axis=1).reshape(-1))
            flat = lambda parts, kind: np.concatenate([np.empty(0, kind), *parts])
            yield pd.DataFrame({"a": flat(node, object), "b": flat(other, object), "distance": flat(gaps, float)})

    return run


def _gaps(points: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        length = np.sqrt(np.square(points).sum(axis=1))
        unit = points / np.where(length > 0, length, 1)[:, None]
        return np.maximum(0.0, 1.0 - unit @ unit.T)
    gap = points[:, None, :] - points[None, :, :]
    return np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))


def _keep_nearest(links: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest different nodes of each node."""
    once = links.groupBy("a", "b").agg(F.min("distance").alias("distance"))
    order = W.partitionBy("a").orderBy("distance", "b")
    return once.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= k).drop("_k")


def _groups(points: DataFrame, size: int, seed: str) -> DataFrame:
    """Random lists of about ``size`` members."""
    count = max(1, points.count() // size)
    group = F.pmod(F.xxhash64(F.lit(seed), F.col("key")), F.lit(count))
    lists = points.groupBy(group.alias("_group")).agg(F.collect_list(F.struct("key", "vector")).alias("members"))
    return lists.select("members")


def neighbor_graph(points: DataFrame, how: Layout = Layout()) -> DataFrame:
    """``a, b, distance``: about the ``neighbors`` nearest others of every node.

    ``points`` has ``key, vector`` with unique keys. Approximate: a list takes at most as many
    neighbours as there are in each direction, drawn anew in every round.
    """
    k, key_type = how.neighbors, dict(points.dtypes)["key"]
    schema = f"a {key_type}, b {key_type}, distance double"
    points = settle(points.select("key", F.col("vector").cast("array<double>").alias("vector")), "points")
    compare = _nearest_of_lists(k, how.metric)
    start = _groups(points, 4 * k, f"{how.seed}:start").mapInPandas(compare, schema)
    graph = settle(_keep_nearest(start, k), "neighbors")
    wanted = points.count() * k
    for number in range(how.rounds):
        draw = F.xxhash64(F.lit(f"{how.seed}:{number}"), "a", "b")
        ahead = graph.select(F.col("a").alias("node"), F.col("b").alias("key"), draw.alias("_draw"), F.lit(0).alias("_way"))
        back = graph.select(F.col("b").alias("node"), F.col("a").alias("key"), draw.alias("_draw"), F.lit(1).alias("_way"))
        both = ahead.unionByName(back)
        some = both.withColumn("_k", F.row_number().over(W.partitionBy("node", "_way").orderBy("_draw"))).where(F.col("_k") <= k)
        named = some.select("node", "key").unionByName(points.select(F.col("key").alias("node"), "key")).distinct()
        lists = named.join(points, "key").groupBy("node").agg(F.collect_list(F.struct("key", "vector")).alias("members")).select("members")
        found = lists.unionByName(_groups(points, 4 * k, f"{how.seed}:{number}")).mapInPandas(compare, schema)
        new = settle(_keep_nearest(graph.unionByName(found), k), "neighbors")
        changed = new.join(graph, ["a", "b"], "left_anti").count()
        graph = new
        if changed <= how.settled * wanted:
            break
    return graph


# --------------------------------------------------------------------- weights


def _fade(distances: np.ndarray) -> np.ndarray:
    """Weights of sorted distances: 1 up to the nearest positive one, then fading; they sum to log2 of their number."""
    positive = distances[distances > 0]
    nearest = positive.min() if len(positive) else 0.0
    beyond, target = np.maximum(distances - nearest, 0.0), math.log2(max(2, len(distances)))
    low, high = 0.0, math.inf
    width = 1.0
    for _ in range(64):
        total = np.exp(-beyond / width).sum()
        if abs(total - target) < 1e-5:
            break
        if total > target:
            high, width = width, (low + width) / 2
        else:
            low, width = width, width * 2 if math.isinf(high) else (width + high) / 2
    width = max(width, 1e-3 * float(distances.mean()), 1e-12)
    return np.exp(-beyond / width)


def _faded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(a, m["b"], w) for a, near in zip(batch["a"], batch["near"]) for m, w in zip(near, _fade(np.array([m["distance"] for m in near])))]
        yield pd.DataFrame(rows, columns=["a", "b", "weight"])


def fuzzy_graph(graph: DataFrame) -> DataFrame:
    """``a, b, weight`` in both directions: a link holds if either node holds it."""
    key_type = dict(graph.dtypes)["a"]
    lists = graph.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("distance", "b"))).alias("near"))
    own = settle(lists.mapInPandas(_faded, f"a {key_type}, b {key_type}, weight double"), "weights")
    other = own.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight")
    sums = own.unionByName(other).groupBy("a", "b").agg(F.sum("weight").alias("s"), F.product("weight").alias("p"), F.count("*").alias("n"))
    return settle(sums.select("a", "b", F.when(F.col("n") > 1, F.col("s") - F.col("p")).otherwise(F.col("s")).alias("weight")), "fuzzy")


# ---------------------------------------------------------------------- layout


def spectral_layout(graph: DataFrame, points: DataFrame, how: Layout = Layout()) -> DataFrame:
    """``key`` and ``x0..``: the leading non-trivial eigenvectors of the normalised graph.

    Each filter is a Chebyshev polynomial that damps what lies below the least eigenvalue
    carried; then the columns are made orthogonal through their Gram matrix.
    """
    wide = how.dims + 1 + how.spare
    names = column_names("x", wide)
    degree = graph.groupBy(F.col("a").alias("key")).agg(F.sum("weight").alias("degree"))
    nodes = settle(points.select("key").join(degree, "key", "left").withColumn("degree", F.coalesce("degree", F.lit(0.0))), "degrees")
    scale = nodes.where("degree > 0").select("key", F.sqrt("degree").alias("root"))
    edges = graph.join(scale.select(F.col("key").alias("a"), F.col("root").alias("ra")), "a").join(scale.select(F.col("key").alias("b"), F.col("root").alias("rb")), "b")
    edges = settle(edges.select("a", "b", (F.col("weight") / F.col("ra") / F.col("rb")).alias("weight")), "normalised")
    spread = lambda i: F.xxhash64(F.lit(f"{how.seed}:{i}"), "key") / F.lit(float(1 << 63))
    # the trivial eigenvector is known: the roots of the degrees
    now = settle(nodes.select("key", F.sqrt("degree").alias("x0"), *[spread(i).alias(f"x{i}") for i in range(1, wide)]), "layout")
    floor = 0.0
    for _ in range(how.filters):
        before, current = None, now
        middle, half = (floor - 1) / 2, (floor + 1) / 2
        for step in range(how.degree):
            image = product(edges, current, names).select("key", *[F.col(c).alias(f"i_{c}") for c in names])
            rows = current.join(image, "key", "left")
            if before is not None:
                rows = rows.join(before.select("key", *[F.col(c).alias(f"p_{c}") for c in names]), "key")
            factor = 1.0 if step == 0 else 2.0
            value = lambda c: ((F.coalesce(f"i_{c}", F.lit(0.0)) - middle * F.col(c)) * (factor / half) - (F.lit(0.0) if step == 0 else F.col(f"p_{c}")))  # noqa: E731, B023
            before, current = current, settle(rows.select("key", *[value(c).alias(c) for c in names]), "filtered")
        current = settle(orthonormal(current, names), "orthonormal")
        values, turn = eigenpairs(edges, current, names)
        floor = float(np.clip(values[0], -0.5, 0.95))
        now = settle(current.select("key", *mixed(names, turn[:, np.argsort(-values)])), "layout")
    spans = now.agg(*[F.max(F.abs(c)) for c in names[1 : how.dims + 1]]).first()
    scaled = [(F.col(c) * (10.0 / (span or 1.0))).alias(f"x{i}") for i, (c, span) in enumerate(zip(names[1:], spans))]
    return now.select("key", *scaled)


def curve(min_dist: float, spread: float = 1.0) -> tuple[float, float]:
    """a and b for which 1 / (1 + a d^2b) is nearest to full weight up to ``min_dist``, then fading."""
    d = np.linspace(0, 3 * spread, 300)[1:]
    target = np.where(d < min_dist, 1.0, np.exp(-(d - min_dist) / spread))
    at = np.array([1.0, 1.0])
    for _ in range(100):  # Gauss-Newton
        p = d ** (2 * at[1])
        value = 1 / (1 + at[0] * p)
        slope = np.stack([-(value**2) * p, -(value**2) * at[0] * p * 2 * np.log(d)], axis=1)
        step = np.linalg.lstsq(slope, target - value, rcond=None)[0]
        at = np.maximum(at + 0.5 * step, 1e-3)
    return float(at[0]), float(at[1])


def refine_layout(layout: DataFrame, graph: DataFrame, how: Layout = Layout()) -> DataFrame:
    """Let links pull and members of random groups push; positions move by bounded steps."""
    a, b = curve(how.min_dist)
    names = column_names("x", how.dims)
    count = layout.count()
    size = min(8, count)
    groups = max(1, count // max(1, size))
    for epoch in range(how.epochs):
        rate = 1.0 - epoch / how.epochs
        one = layout.select(F.col("key").alias("a"), *[F.col(c).alias(f"a_{c}") for c in names])
        two = layout.select(F.col("key").alias("b"), *[F.col(c).alias(f"b_{c}") for c in names])
        gap = sum((F.pow(F.col(f"a_{c}") - F.col(f"b_{c}"), 2) for c in names), F.lit(0.0))
        pull = F.when(F.col("_d") > 0, -2.0 * a * b * F.pow("_d", b - 1) / (1 + a * F.pow("_d", b))).otherwise(0.0) * F.col("weight")
        pulled = graph.join(one, "a").join(two, "b").withColumn("_d", gap).withColumn("_f", pull)
        push = 2.0 * b / ((0.001 + F.col("_d")) * (1 + a * F.pow("_d", b)))
        random = F.pmod(F.xxhash64(F.lit(f"{how.seed}:{epoch}"), "key"), F.lit(groups))
        members = layout.groupBy(random.alias("_group")).agg(F.collect_list(F.struct("key", *names)).alias("m"))
        pairs = members.select(F.explode("m").alias("p"), "m").select("p", F.explode("m").alias("q")).where("p.key <> q.key")
        pushed = pairs.select(
            F.col("p.key").alias("a"), *[F.col(f"p.{c}").alias(f"a_{c}") for c in names], *[F.col(f"q.{c}").alias(f"b_{c}") for c in names]
        ).withColumn("_d", gap).withColumn("_f", push)
        move = lambda c: (F.greatest(F.lit(-4.0), F.least(F.lit(4.0), F.col("_f") * (F.col(f"a_{c}") - F.col(f"b_{c}"))))).alias(c)
        moves = pulled.select("a", *map(move, names)).unionByName(pushed.select("a", *map(move, names)))
        moves = moves.groupBy(F.col("a").alias("key")).agg(*[F.sum(c).alias(f"m_{c}") for c in names])
        bounded = lambda c: F.greatest(F.lit(-4.0), F.least(F.lit(4.0), F.coalesce(f"m_{c}", F.lit(0.0))))
        layout = layout.join(moves, "key", "left").select("key", *[(F.col(c) + 0.25 * rate * bounded(c)).alias(c) for c in names])
        layout = settle(layout, "layout")
    return layout


def project(points: DataFrame, how: Layout = Layout(), key: str = "category", vector: str = "vector") -> DataFrame:
    """``key`` and the projected ``vector``; rows without a vector are left out.

    Keys must be unique. With no more points than coordinates the layout is all but
    degenerate; a single point lies at the origin.
    """
    rows = settle(points.select(F.col(key).alias("key"), F.col(vector).alias("vector")).where(F.col("vector").isNotNull()), "projected")
    graph = fuzzy_graph(neighbor_graph(rows, how))
    layout = refine_layout(spectral_layout(graph, rows, how), graph, how)
    return layout.select(F.col("key").alias(key), F.array(*column_names("x", how.dims)).alias(vector))
