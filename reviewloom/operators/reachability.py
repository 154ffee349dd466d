"""Core distances and the spanning tree of mutual reachability, by searches with a bound per point.

A point first meets its own tile, which tells how far it has to look; then it searches only tiles whose box is
within that bound. No pass combines all tiles. The work of a search is one numpy
block of the searching points against a tile.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from reviewloom.operators.components import connected_components, joined
from reviewloom.operators.tiles import box_tiles, exact_slices, has_place, matrix, search_blocks, searches
from reviewloom.staging import settle

TREE_TILE = 1024  # points of a tile
HELD = 500_000  # edges held at once by a task before they are cut down to a forest
PROBES = 64  # tiles, about, that tell how near neighbours are
USUAL, WIDER = 0.99, 1.25  # the first pass links this share of the points to a neighbour, with this margin
NARROW = 0.05  # share of the tiles that may be narrower than twice the first pass's reach


# ------------------------------------------------------------- core distances


def _own_nearest(k: int, farthest: float):
    """Up to ``k`` nearest points of each point in its own tile, and how far the ``k``-th can be at most."""

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        place, copies = matrix(rows["vector"]), rows["n"].to_numpy()
        few, gaps, counts = min(k, len(rows)), [], []
        for cut, gap in exact_slices(place, place):
            gap[np.arange(len(gap)), np.arange(cut.start, cut.stop)] = np.inf
            near = np.argpartition(gap, few - 1, axis=1)[:, :few]
            found = np.take_along_axis(gap, near, axis=1)
            order = np.argsort(found, axis=1, kind="stable")
            gaps.append(np.take_along_axis(found, order, axis=1))
            counts.append(np.where(np.isfinite(gaps[-1]), copies[np.take_along_axis(near, order, axis=1)], 0))
        gaps, counts = np.concatenate(gaps), np.concatenate(counts)
        enough = (copies - 1)[:, None] + np.cumsum(counts, axis=1) >= k
        core = np.where(enough.any(axis=1), gaps[np.arange(len(gaps)), enough.argmax(axis=1)], np.inf)
        core[copies > k] = 0.0
        kept = np.isfinite(gaps) & (gaps <= farthest)
        return pd.DataFrame(
            {
                "key": rows["key"],
                "vector": rows["vector"],
                "n": copies,
                "_tile": rows["_tile"],
                "core": core,
                "bound": np.minimum(core, farthest),
                "gaps": [g[i] for g, i in zip(gaps, kept)],
                "counts": [c[i] for c, i in zip(counts, kept)],
            }
        )

    return block


def _nearer_block(k: int):
    """Up to ``k`` points of the tile that are nearer to a searching point than its bound."""

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        keys, bound, copies, out = left["key"].to_numpy(), left["bound"].to_numpy(), right["n"].to_numpy(), []
        few = min(k, len(right))
        for cut, gap in exact_slices(matrix(left["vector"]), matrix(right["vector"])):
            near = np.argpartition(gap, few - 1, axis=1)[:, :few]
            found = np.take_along_axis(gap, near, axis=1)
            row, col = np.nonzero((found <= bound[cut][:, None]) & np.isfinite(found))
            out.append(pd.DataFrame({"key": keys[cut][row], "distance": found[row, col], "n": copies[near[row, col]]}))
        return pd.concat(out, ignore_index=True)

    return block


def core_distances(points: DataFrame, k: int, rows: int = TREE_TILE, farthest: float = math.inf) -> DataFrame:
    """``key, n, vector, core`` of points with ``n`` copies: distance to the ``k``-th other point.

    Points with fewer than ``k`` others within ``farthest`` have an infinite core distance, or any above it. A
    vector with a null or non-finite coordinate is near its copies only.
    """
    key_type = dict(points.dtypes)["key"]
    tiled, boxes = box_tiles(points.select("key", "n", "vector").where(has_place("vector")), rows)
    schema = f"key {key_type}, vector array<double>, n bigint, _tile string, core double, bound double, gaps array<double>, counts array<bigint>"
    own = settle(tiled.groupBy("_tile").applyInPandas(_own_nearest(k, farthest), schema), "own")
    asked = searches(own.select("key", "vector", "bound", "_tile"), boxes)
    near = settle(search_blocks(asked, tiled, _nearer_block(k), f"key {key_type}, distance double, n bigint"), "near")
    again = own.join(near.select("key"), "key", "left_semi")
    first = again.select("key", F.inline(F.arrays_zip(F.col("gaps").alias("distance"), F.col("counts").alias("n"))))
    copies = again.where("n > 1").select("key", F.lit(0.0).alias("distance"), (F.col("n") - 1).alias("n"))
    running = W.partitionBy("key").orderBy("distance").rowsBetween(W.unboundedPreceding, 0)
    seen = near.unionByName(first).unionByName(copies).withColumn("seen", F.sum("n").over(running)).where(F.col("seen") >= k)
    nearer = seen.groupBy("key").agg(F.min("distance").alias("nearer"))
    crowd = points.where(~has_place("vector") & (F.col("n") > k)).select("key", F.lit(0.0).alias("core"))
    known = own.select("key", "core").join(nearer, "key", "left").select("key", F.coalesce("nearer", "core").alias("core"))
    found = known.unionByName(crowd)
    return points.join(found, "key", "left").withColumn("core", F.coalesce("core", F.lit(math.inf)))


# ------------------------------------------------------ spanning tree candidates


def forest(one: np.ndarray, two: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Places of the edges of a minimum spanning forest of ``n`` nodes, the lightest edge of every part at a time.

    Of equal weights the one with the smaller ends is lighter, so that forests of overlapping graphs agree.
    """
    low, high = np.minimum(one, two), np.maximum(one, two)
    order = np.lexsort((high, low, weight))
    low, high = low[order], high[order]
    part, left, chosen = np.arange(n), np.arange(len(order)), [np.empty(0, np.int64)]
    while True:
        a, b = part[low[left]], part[high[left]]
        apart = a != b
        left, a, b = left[apart], a[apart], b[apart]
        if not len(left):
            return order[np.concatenate(chosen)]
        best = np.full(n, len(order))
        np.minimum.at(best, a, left)
        np.minimum.at(best, b, left)
        picked = np.unique(best[best < len(order)])
        chosen.append(picked)
        part = joined(part[low[picked]], part[high[picked]], n)[part]


def _reach(gap: np.ndarray, alpha: float, core: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Mutual reachability from distances, in place."""
    gap /= alpha
    np.maximum(gap, core[:, None], out=gap)
    return np.maximum(gap, other[None, :], out=gap)


def _surround_block(reach: float, alpha: float):
    """Minimum spanning forest, up to ``reach``, of the edges that have an end in the tile (the right points).

    The left points are those of the tile too, or around it.
    """

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        a, b = left["key"].to_numpy(), right["key"].to_numpy()
        every, code = np.unique(np.concatenate([a, b]), return_inverse=True)
        code_a, code_b = code[: len(a)], code[len(a) :]
        core_a, core_b = left["core"].to_numpy(), right["core"].to_numpy()
        inside = np.isin(code_a, code_b)
        held, count = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))], 0

        def thin() -> tuple:
            one, two, weight = map(np.concatenate, zip(*held))
            kept = forest(one, two, weight, len(every))
            return one[kept], two[kept], weight[kept]

        for cut, gap in exact_slices(matrix(left["vector"]), matrix(right["vector"])):
            gap = _reach(gap, alpha, core_a[cut], core_b)
            i, j = np.nonzero(gap <= min(reach, np.finfo(float).max))
            x, y = code_a[cut][i], code_b[j]
            new = ~inside[cut][i] | (x < y)  # two points of the tile meet twice
            held.append((x[new], y[new], gap[i, j][new]))
            count += len(i)
            if count > HELD:
                held, count = [thin()], 0
        one, two, weight = thin()
        return pd.DataFrame({"a": every[np.minimum(one, two)], "b": every[np.maximum(one, two)], "weight": weight})

    return block


def _least_reach(alpha: float):
    """Least mutual reachability of each point in its tile."""

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        place, core, least = matrix(rows["vector"]), rows["core"].to_numpy(), []
        for cut, gap in exact_slices(place, place):
            gap = _reach(gap, alpha, core[cut], core)
            gap[np.arange(len(gap)), np.arange(cut.start, cut.stop)] = np.inf
            least.append(gap.min(axis=1))
        return pd.DataFrame({"reach": np.concatenate(least)})

    return block


def _first_reach(tiled: DataFrame, boxes: DataFrame, alpha: float, farthest: float) -> float:
    """How far the first pass looks: about as far as nearly all points have a neighbour, but no farther than half of
    most tiles. It decides about the work only, never about the edges found."""
    tiles = boxes.count()
    if tiles <= 1:
        return farthest
    some = tiled.where(F.pmod(F.xxhash64("_tile"), F.lit(math.ceil(tiles / PROBES))) == 0)
    least = some.groupBy("_tile").applyInPandas(_least_reach(alpha), "reach double")
    usual = least.agg(F.percentile_approx("reach", USUAL)).first()[0]
    side = F.array_max(F.zip_with("high", "low", lambda a, b: a - b)) / 2 / alpha
    narrow = boxes.agg(F.percentile_approx(side, NARROW)).first()[0]
    return min(farthest, narrow if usual is None else min(WIDER * usual, narrow))


def _leaving_block(alpha: float):
    """The lightest edge, within their bounds, by which the searching points of each part reach another part."""

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        core, other = left["core"].to_numpy(), right["core"].to_numpy()
        part, parts = pd.factorize(pd.concat([left["part"], right["part"]]), use_na_sentinel=False)
        mine, theirs = part[: len(left)], part[len(left) :]
        best, at = np.empty(len(left)), np.empty(len(left), np.int64)
        for cut, gap in exact_slices(matrix(left["vector"]), matrix(right["vector"])):
            gap = _reach(gap, alpha, core[cut], other)
            gap[mine[cut][:, None] == theirs[None, :]] = np.inf
            at[cut] = gap.argmin(axis=1)
            best[cut] = np.take_along_axis(gap, at[cut][:, None], axis=1)[:, 0]
        # the bound is a distance: the reach may equal it after division
        ok = np.isfinite(best) & (best <= left["most"].to_numpy())
        row = np.nonzero(ok)[0]
        row = row[np.argsort(best[row], kind="stable")]
        row = row[np.unique(mine[row], return_index=True)[1]]
        there = at[row]
        return pd.DataFrame(
            {
                "part": left["part"].to_numpy()[row],
                "other": right["part"].to_numpy()[there],
                "a": left["key"].to_numpy()[row],
                "b": right["key"].to_numpy()[there],
                "weight": best[row],
            }
        )

    return block


def tree_edges(points: DataFrame, alpha: float = 1.0, rows: int = TREE_TILE, farthest: float = math.inf) -> DataFrame:
    """``a, b, weight``: edges that hold a minimum spanning forest of the mutual reachability up to ``farthest``.

    ``points`` has ``key, vector, core``. The first pass finds all short edges: every tile with the points
    around it returns a forest. After it, what is linked by short edges is a part. In each round every part but the
    largest takes the lightest edge that leaves it, so the number of parts at least halves; a part looks
    no farther than the lightest edge that its own tiles give.
    """
    key_type = dict(points.dtypes)["key"]
    points = points.select("key", "vector", F.col("core").cast("double").alias("core"))
    points = points.where((F.col("core") < math.inf) & has_place("vector") & F.col("key").isNotNull())
    tiled, boxes = box_tiles(points, rows)
    reach = _first_reach(tiled, boxes, alpha, farthest)
    around = searches(tiled.withColumn("bound", F.lit(reach * alpha)), boxes, once=True)
    around = tiled.unionByName(around.drop("bound"))
    found = search_blocks(around, tiled, _surround_block(reach, alpha), f"a {key_type}, b {key_type}, weight double")
    edges = settle(found, "edges")
    if reach >= farthest:
        return edges
    links, at = edges.select("a", "b"), "key"
    schema = f"part {key_type}, other {key_type}, a {key_type}, b {key_type}, weight double"
    while True:
        roots = connected_components(links).select(F.col("node").alias(at), "root")
        tiled = settle(tiled.join(roots, at, "left").withColumn("part", F.coalesce("root", at)).drop("root"), "parts")
        found = settle(_leaving(tiled, boxes, alpha, farthest, schema), "found")
        if found.isEmpty():
            return edges
        edges = edges.unionByName(found.select("a", "b", "weight").distinct())
        links, at = found.select(F.col("part").alias("a"), F.col("other").alias("b")), "part"


def _leaving(tiled: DataFrame, boxes: DataFrame, alpha: float, farthest: float, schema: str) -> DataFrame:
    """The lightest edge that leaves each part but the largest."""
    sizes = settle(tiled.groupBy("part").agg(F.count("*").alias("size")), "sizes")
    largest = sizes.orderBy(F.desc("size"), "part").limit(1).select("part")
    sources = settle(tiled.join(largest, "part", "left_anti").select(*tiled.columns), "sources")
    only = tiled.groupBy("_tile").agg(F.min("part").alias("low_part"), F.max("part").alias("high_part"))
    whole = F.when(F.col("low_part") == F.col("high_part"), F.col("low_part")).alias("part")
    boxes = settle(boxes.join(only.select("_tile", whole), "_tile"), "boxes")
    block = _leaving_block(alpha)

    # first a look at the own tile, or from one point of a tile that is all one part at the nearest other tile
    mixed = boxes.where("part is null").select("_tile")
    near = sources.join(mixed, "_tile", "left_semi")
    lone = sources.join(mixed, "_tile", "left_anti").groupBy("_tile").agg(F.min_by(F.struct("key", "vector", "core", "part"), "key").alias("_p"))
    lone = lone.select("_p.*").join(boxes.select(F.col("part").alias("_own"), "_tile", "low", "high"), F.lit(True))
    lone = lone.where("_own is null or _own <> part")
    ends = F.slice("vector", 1, F.size("low"))
    outside = F.zip_with(F.zip_with("low", ends, lambda a, b: a - b), F.zip_with(ends, "high", lambda a, b: a - b), lambda a, b: F.greatest(a, b, F.lit(0.0)))
    far = F.aggregate(outside, F.lit(0.0), lambda acc, x: acc + x * x)
    lone = lone.groupBy("key").agg(F.min_by(F.struct("vector", "core", "part", "_tile"), far).alias("_p"))
    first = near.select("key", "vector", "core", "part", "_tile").unionByName(lone.select("key", "_p.*"))
    first = first.withColumn("most", F.lit(farthest))
    found = settle(search_blocks(first, tiled, block, schema), "found")

    # then every point looks as far as its part may have to
    most = found.groupBy("part").agg(F.min("weight").alias("most"))
    bound = sources.join(settle(most, "most"), "part", "left").withColumn("most", F.coalesce("most", F.lit(farthest)))
    bound = bound.where(F.col("core") <= F.col("most")).withColumn("bound", F.col("most") * alpha)
    asked = searches(bound.select("key", "vector", "core", "part", "most", "bound", "_tile"), boxes)
    found = found.unionByName(search_blocks(asked, tiled, block, schema))
    one, two = F.least("a", "b"), F.greatest("a", "b")
    best = found.groupBy("part").agg(F.min(F.struct("weight", one.alias("a"), two.alias("b"), "other")).alias("_e"))
    return best.select("part", "_e.other", "_e.a", "_e.b", "_e.weight")
