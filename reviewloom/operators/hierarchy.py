"""Density clusters from the whole tree of densities: spanning tree, condensed tree, choice.

The mutual reachability of two points is the largest of their core distances and their
distance. Its minimum spanning tree, read by rising edges, is the tree of all density
clusters. The condensed tree keeps what has at least ``min_size`` points: a cluster is born where it
parts from another one, loses points on the way down, and ends where it splits. Chosen are
the clusters of most excess of mass, no one inside another.

- Candidates for the spanning tree come from :mod:`reviewloom.operators.reachability`: all short edges by
  forests of tiles with their surroundings, longer ones by searches from what is not yet linked.
- The tree is built from the edges in levels of bounded size by rising weight. A level works
  on what the ones below have joined to single nodes, part by part; its choices are handed down in
  the opposite order.

Edges of equal weight are joined at once, so that the result depends on no order.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from reviewloom.contracts import NOISE
from reviewloom.operators.components import connected_components
from reviewloom.operators.ranks import range_positions
from reviewloom.operators.reachability import TREE_TILE, core_distances, tree_edges
from reviewloom.staging import settle

LEVEL = 200_000  # edges of a level
TINY = 1e-9  # distances below count as this much where density is their reciprocal


# --------------------------------------------------------------- condensed tree

# What a level tells, by ``kind``: an edge of the spanning tree (a, b), a point or node that leaves
# a cluster (fall), a finished cluster (close), a node that becomes part of another (move), and
# what a joined node amounts to (node).
_TOLD = (
    "kind string, a {0}, b {0}, distance double, size bigint, cluster string, parent string, created double, "
    "mass double, inner double, part bigint"
)
_NODE = ["size", "cluster", "created", "mass", "inner"]


def _density(distance: float) -> float:
    return 1.0 / max(distance, TINY)


def _agglomerate(min_size: int, last: bool):
    """Join the nodes of one part of a level by rising edges.

    A node is small, or an open cluster with the mass it has gathered (the density at which each
    point left, summed) and the mass of the chosen clusters inside it.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        told: list[dict] = []
        state: dict = {}
        for r in rows[rows["kind"] == "node"].itertuples():
            named = r.cluster if isinstance(r.cluster, str) else None
            state[r.a] = {"size": int(r.size), "cluster": named, "created": r.created, "mass": r.mass, "inner": r.inner, "inside": [r.a]}
        up = {node: node for node in state}

        def find(node):
            while up[node] != node:
                up[node] = up[up[node]]
                node = up[node]
            return node

        def close(node: dict, parent: str | None, distance: float) -> float:
            mass = node["mass"] - node["size"] * (0.0 if math.isinf(distance) else _density(distance))
            told.append(
                {"kind": "close", "cluster": node["cluster"], "parent": parent, "distance": distance, "size": node["size"],
                 "created": node["created"], "mass": mass, "inner": node["inner"]}
            )
            return max(mass, node["inner"])

        def join(root, parts: list, distance: float) -> None:
            nodes = [state.pop(p) for p in parts]
            size = sum(n["size"] for n in nodes)
            if size < min_size:
                state[root] = {"size": size, "cluster": None, "created": None, "mass": 0.0, "inner": 0.0, "inside": sum((n["inside"] for n in nodes), [])}
                return
            big = [n for n in nodes if n["cluster"]]
            if len(big) == 1:
                whole = big[0]
                whole["mass"] += (size - whole["size"]) * _density(distance)
            else:
                name = f"{root}@{distance!r}"
                inner = sum(close(n, name, distance) for n in big)
                whole = {"cluster": name, "created": distance, "mass": size * _density(distance), "inner": inner, "inside": []}
            for n in nodes:
                if not n["cluster"]:
                    told.extend({"kind": "fall", "a": p, "cluster": whole["cluster"], "distance": distance} for p in n["inside"])
            whole["size"] = size
            state[root] = whole

        everything = list(state)
        edges = rows[rows["kind"] == "edge"].sort_values("distance", kind="stable")
        steps = zip(edges["distance"].tolist(), edges["a"].tolist(), edges["b"].tolist(), edges["from"].tolist(), edges["to"].tolist())
        for distance, group in groupby(steps, key=lambda step: step[0]):
            joined: dict = {}
            for _, a, b, one, other in group:
                a, b = find(a), find(b)
                if a != b:
                    told.append({"kind": "edge", "a": one, "b": other, "distance": distance})
                    low, high = min(a, b), max(a, b)
                    up[high] = low
                    joined[low] = joined.pop(low, [low]) + joined.pop(high, [high])
            for root, parts in joined.items():
                join(root, parts, distance)
        for node in everything:
            if find(node) != node:
                told.append({"kind": "move", "a": node, "b": find(node)})
                continue
            if last and state[node]["cluster"]:
                close(state[node], None, math.inf)
            told.append({"kind": "node", "a": node, **{c: state[node][c] for c in _NODE}})
        out = pd.DataFrame(told, columns=["kind", "a", "b", "distance", "size", "cluster", "parent", "created", "mass", "inner"])
        texts = {c: out[c].astype(object).where(out[c].notna(), None) for c in ("kind", "a", "b", "cluster", "parent")}
        return out.assign(**texts, part=rows["part"].iloc[0]).astype({"size": "Int64"})

    return run


@dataclass
class Tree:
    """Condensed tree: clusters by level (lowest first), the cluster that each point leaves and
    at which distance, and the edges of the spanning tree."""

    clusters: list[DataFrame]
    members: DataFrame
    edges: DataFrame


def condensed_tree(points: DataFrame, edges: DataFrame, min_size: int = 2, level: int = LEVEL) -> Tree:
    """Build the tree of ``points`` (``key, n, core``) from ``edges`` (``a, b, weight``).

    Copies of a point part at its core distance.
    """
    key_type = dict(points.dtypes)["key"]
    points = points.where(F.col("core") < math.inf)
    own = F.concat_ws("@", F.col("key").cast("string"), F.col("core").cast("string"))
    crowd = F.col("n") >= min_size
    nodes = points.select(
        F.col("key").alias("a"), F.col("n").alias("size"), F.when(crowd, own).alias("cluster"), F.when(crowd, F.col("core")).alias("created"),
        F.when(crowd, F.col("n") / F.greatest("core", F.lit(TINY))).otherwise(0.0).alias("mass"), F.lit(0.0).alias("inner"),
    )
    nodes = settle(nodes, "nodes")
    members = points.where(crowd).select("key", own.alias("cluster"), F.col("core").alias("distance"))
    places, clusters, kept = None, [], None  # the node that each point is in; at first its own
    count = edges.count()
    cuts = []
    if count > level:
        shares = [i / -(-count // level) for i in range(1, -(-count // level))]
        cuts = sorted(set(edges.agg(F.percentile_approx("weight", F.array(*map(F.lit, shares)), 100_000)).first()[0]))
    for low, high in zip([-math.inf, *cuts], [*cuts, math.inf]):
        last = math.isinf(high)
        own_edges = edges.where((F.col("weight") > low) & (F.col("weight") <= high))
        if places is None:
            ends = own_edges.select("a", "b", F.col("a").alias("from"), F.col("b").alias("to"), "weight")
        else:
            ends = own_edges.select(F.col("a").alias("from"), F.col("b").alias("to"), "weight")
            ends = ends.join(places.select(F.col("key").alias("from"), F.col("node").alias("a")), "from")
            ends = ends.join(places.select(F.col("key").alias("to"), F.col("node").alias("b")), "to").where("a <> b")
        if last:
            parts = nodes.select("a", F.lit(0).cast("bigint").alias("part"))
        else:
            ends = settle(ends, "ends")
            roots = connected_components(ends.select("a", "b"))
            parts = settle(roots.select(F.col("node").alias("a"), F.xxhash64("root").alias("part")), "parts")
        rows = ends.join(parts, "a").select(F.lit("edge").alias("kind"), "a", "b", "from", "to", F.col("weight").alias("distance"), "part")
        held = nodes.join(parts, "a").select(F.lit("node").alias("kind"), "a", *_NODE, "part")
        rows = rows.unionByName(held, allowMissingColumns=True)
        told = settle(rows.groupBy("part").applyInPandas(_agglomerate(min_size, last), _TOLD.format(key_type)), "told")
        tell = lambda kind: told.where(F.col("kind") == kind)  # noqa: E731, B023
        falls = tell("fall").select(F.col("a").alias("node"), "cluster", "distance")
        fallen = falls.withColumnRenamed("node", "key") if places is None else places.join(falls, "node")
        members = members.unionByName(fallen.select("key", "cluster", "distance"))
        clusters.append(tell("close").select("cluster", "parent", "distance", "size", "created", "mass", "inner", "part"))
        tree_edges_ = tell("edge").select("a", "b", F.col("distance").alias("weight"))
        kept = tree_edges_ if kept is None else kept.unionByName(tree_edges_)
        if not last:
            moved = tell("move").select(F.col("a").alias("node"), F.col("b").alias("__to"))
            places = points.select("key", F.col("key").alias("node")) if places is None else places
            places = places.join(moved, "node", "left").select("key", F.coalesce("__to", "node").alias("node"))
            places = settle(places, "places")
            nodes = settle(nodes.join(parts, "a", "left_anti").unionByName(tell("node").select("a", *_NODE)), "nodes")
    return Tree(clusters, settle(members, "members"), kept)


# ----------------------------------------------------------------------- choice


def _hand_down(topmost: bool):
    """The marked cluster that each cluster lies in: the first from the top, or the nearest."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        mark: dict = {}
        rows = rows.sort_values("distance", ascending=False, kind="stable")
        for r in rows.itertuples():
            above = r.given if isinstance(r.given, str) else mark.get(r.parent)
            own = r.cluster if r.flag else None
            mark[r.cluster] = (above or own) if topmost else (own or above)
        return pd.DataFrame({"cluster": list(mark), "mark": np.array(list(mark.values()), dtype=object)})

    return run


def descend(levels: list[DataFrame], flag: Callable[[DataFrame], DataFrame], topmost: bool) -> DataFrame:
    """``cluster, mark`` of all clusters, from the highest level to the lowest.

    ``flag`` adds a column of that name; a cluster's mark is a flagged cluster that it is or lies in.
    """
    done = None
    for rows in reversed(levels):
        rows = flag(rows)
        if done is None:
            rows = rows.withColumn("given", F.lit(None).cast("string"))
        else:
            rows = rows.join(done.select(F.col("cluster").alias("parent"), F.col("mark").alias("given")), "parent", "left")
        rows = rows.select("cluster", "parent", "distance", "flag", "given", "part")
        found = settle(rows.groupBy("part").applyInPandas(_hand_down(topmost), "cluster string, mark string"), "marks")
        done = found if done is None else done.unionByName(found)
    return done


def choose_clusters(levels: list[DataFrame], epsilon: float = 0.0) -> DataFrame:
    """``cluster, mark``: the chosen cluster that every cluster of the tree lies in, or null.

    Without a choice above, a cluster is chosen if its own mass is at least that of the best
    clusters inside it. The root is never chosen. A chosen cluster that is born below ``epsilon``
    gives way to the first cluster around it that is born above, or else to the
    outermost one below the root.
    """
    roots = levels[-1].where("parent is null").select(F.col("cluster").alias("parent"))

    def best(rows: DataFrame) -> DataFrame:
        return rows.withColumn("flag", F.col("parent").isNotNull() & (F.col("mass") >= F.col("inner")))

    def reached(rows: DataFrame) -> DataFrame:
        outermost = rows.join(roots.withColumn("outer", F.lit(True)), "parent", "left")
        return outermost.withColumn("flag", F.coalesce("outer", F.lit(False)) | (F.col("parent").isNotNull() & (F.col("distance") > epsilon)))

    chosen = descend(levels, best, topmost=True).where("cluster = mark").select("cluster")
    if epsilon > 0:
        births = levels[0]
        for more in levels[1:]:
            births = births.unionByName(more)
        wider = descend(levels, reached, topmost=False)
        chosen = chosen.join(births.select("cluster", "distance"), "cluster").join(wider, "cluster")
        chosen = chosen.select(F.when(F.col("distance") < epsilon, F.col("mark")).otherwise(F.col("cluster")).alias("cluster"))
    chosen = settle(chosen.distinct(), "chosen")

    def final(rows: DataFrame) -> DataFrame:
        return rows.join(chosen.withColumn("flag", F.lit(True)), "cluster", "left").withColumn("flag", F.coalesce("flag", F.lit(False)))

    return descend(levels, final, topmost=False)


# ----------------------------------------------------------------------- labels


@dataclass
class Hierarchy:
    """Labels (key, cluster, probability), the condensed tree's clusters, and the tree's edges."""

    labels: DataFrame
    clusters: DataFrame
    edges: DataFrame


def density_hierarchy(
    points: DataFrame,
    min_size: int = 2,
    min_samples: int = 1,
    epsilon: float = 0.5,
    alpha: float = 0.5,
    key: str = "category",
    vector: str = "vector",
    tile_rows: int = TREE_TILE,
    level: int = LEVEL,
) -> Hierarchy:
    """Cluster every point by the whole density tree.

    Core distance is the distance to the ``min_samples``-th other point; the mutual reachability of
    two points is the largest of their core distances and their distance divided by
    ``alpha``. Clusters are numbered by their smallest key, noise is -1. The probability of
    a point is the distance at which its cluster is densest over the distance at which the point leaves it;
    0 for noise. Equal vectors are one point with copies; keys must be unique. Rows
    without a vector are left out; a table with too few points is all noise.
    """
    base = points.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector")).where(F.col("vector").isNotNull())
    point = settle(base.groupBy("vector").agg(F.min("key").alias("key"), F.count("*").alias("n")), "points")
    cored = settle(core_distances(point.select("key", "n", "vector"), min_samples, tile_rows), "core")
    edges = tree_edges(cored.select("key", "vector", "core"), alpha, tile_rows)
    tree = condensed_tree(cored.select("key", "n", "core"), edges, min_size, level)
    clusters = tree.clusters[0]
    for more in tree.clusters[1:]:
        clusters = clusters.unionByName(more)
    marks = choose_clusters(tree.clusters, epsilon)
    held = tree.members.join(marks.where("mark is not null"), "cluster").select("key", F.col("mark").alias("cluster"), "distance")
    held = settle(held, "held")
    numbered = range_positions(held.groupBy("cluster").agg(F.min("key").alias("first")), [], ["first"], "_id")
    dense = clusters.select("cluster", "created").join(numbered, "cluster")
    share = F.when(F.col("distance") == 0, 1.0).otherwise(F.col("created") / F.greatest("distance", "created"))
    scored = held.join(dense, "cluster").select("key", (F.col("_id") - 1).cast("int").alias("cluster"), share.alias("probability"))
    scored = settle(scored, "scored")
    copies = point.where("n > 1").select(F.col("key").alias("first"), "vector")
    twins = base.join(copies, "vector").select("key", "first")
    firsts = base.select("key").join(twins, "key", "left").withColumn("first", F.coalesce("first", "key"))
    labels = firsts.join(scored.withColumnRenamed("key", "first"), "first", "left").select(
        F.col("key").alias(key), F.coalesce("cluster", F.lit(NOISE)).alias("cluster"), F.coalesce("probability", F.lit(0.0)).alias("probability")
    )
    # copies hang on each other at their core distance
    twin_edges = twins.where("key <> first").join(cored.select(F.col("key").alias("first"), "core"), "first")
    joined = tree.edges.unionByName(twin_edges.select(F.col("first").alias("a"), F.col("key").alias("b"), F.col("core").alias("weight")))
    return Hierarchy(labels, clusters.drop("part", "inner").withColumnRenamed("distance", "born").withColumnRenamed("mass", "stability"), joined)


def relative_validity(labels: DataFrame, edges: DataFrame, key: str = "category") -> DataFrame:
    """How well the spanning tree's edges tell the clusters apart: one row, ``stability_score``.

    Per cluster the shortest edge to another one against the longest edge inside, weighted by
    size over all points. A cluster without such an edge counts as twice the longest edge apart; if it
    is the only one, as twice the shortest edge to noise. Null without clusters.
    """
    label = lambda end: labels.select(F.col(key).alias(end), F.col("cluster").alias(f"{end}_cluster"))
    ends = edges.join(label("a"), "a").join(label("b"), "b")
    one, two, far = F.col("a_cluster"), F.col("b_cluster"), F.col("weight")
    ends = settle(ends.select(one, two, far), "ends")
    real = ends.where((one != NOISE) & (two != NOISE))
    inside = real.where(one == two).groupBy(one.alias("cluster")).agg(F.max(far).alias("inside"))
    across = real.where(one != two)
    apart = across.select(one.alias("cluster"), far).unionByName(across.select(two.alias("cluster"), far))
    apart = apart.groupBy("cluster").agg(F.min(far).alias("apart"))
    outlier = F.min(F.when((one == NOISE) != (two == NOISE), far))
    longest = ends.agg(F.max(far).alias("longest"), outlier.alias("outlier"))
    sizes = labels.groupBy("cluster").agg(F.count("*").alias("size"))
    table = settle(sizes.where(F.col("cluster") != NOISE).join(inside, "cluster", "left").join(apart, "cluster", "left"), "validity")
    only = table.agg((F.count("*") == 1).alias("only"))
    bounds = longest.select(
        F.when(only.scalar(), F.coalesce("outlier", "longest")).otherwise(F.col("longest")).alias("correction")
    )
    gap = F.coalesce("apart", 2 * bounds.scalar())
    within = F.coalesce("inside", F.lit(0.0))
    index = F.coalesce(F.try_divide(gap - within, F.greatest(gap, within)), F.lit(0.0))
    total = sizes.agg(F.sum("size"))
    return table.agg((F.sum(F.col("size") * index) / total.scalar()).alias("stability_score"))
