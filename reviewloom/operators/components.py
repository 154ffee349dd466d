"""Components of a graph: as a job over its edges, and inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from reviewloom.staging import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node of every component: ``node, root``.

    ``edges`` has columns ``a, b``. Alternates two steps that hang each node's
    larger, then smaller, neighbours on its smallest one, until only stars are left; the
    number of rounds grows with the logarithm of the graph. Each round is written
    out, so a lost executor costs one round and the plan stays short.
    """
    current = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    while not _all_stars(current):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(floor, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        )
        current = settle(hung.select("col.a", "col.b").where("a <> b").distinct(), "edges")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _all_stars(edges: DataFrame) -> bool:
    """Does every node hang on exactly one node, which itself hangs on none?"""
    ends = F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    loose = nodes.agg(F.max("up").alias("up"), F.max(F.least("up", "down")).alias("inner")).first()
    return (loose["up"] or 0) <= 1 and not loose["inner"]


def joined(one: np.ndarray, two: np.ndarray, n: int) -> np.ndarray:
    """Least number linked to each of ``n`` numbers by the pairs ``one, two``, directly or not."""
    root = np.arange(n)
    while len(one):
        low = np.minimum(root[one], root[two])
        new = root.copy()
        for end in (one, two):
            np.minimum.at(new, root[end], low)
            np.minimum.at(new, end, low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    return root
