"""Distances between points without emitting pairs.

The measures of this package need distances between many points, yet never the
distances themselves: a nearest neighbour, a sum per cluster, a linked component is
enough. Points are cut into tiles of bounded size; one task sees one tile against
another, computes the block with numpy and returns at most a few rows per point.
A tile never grows with the data, and a crowded place only gives more tiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from reviewloom.operators.ranks import whole_table
from reviewloom.staging import settle

TILE_ROWS = 2048
WIDE_TILE = 4 * TILE_ROWS  # points of a tile of many: rows are sent to each tile, so fewer tiles move less
SPREAD = 24  # tiles at least before they are as wide as that
GRID_DIMS = 3
SLICE = 500_000  # distances held at once, about the processor's cache
FEW_DIMS = 8  # up to so many coordinates, differences are faster than a product
BOX_DIMS = 16  # coordinates that a tile's box covers
SEARCHES = 8 * TILE_ROWS  # points, about, that search one tile in one task
SLACK = 1 + 1e-9  # bounds by boxes are widened by this for rounding
NEAR, ROUNDING = 1e-4, 1e-11  # shares of the largest squares that a product's digits do not settle


def matrix(vectors: pd.Series) -> np.ndarray:
    """Array column of a batch as a float64 matrix."""
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _by_differences(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = np.zeros((len(left), len(right)))
    gap = np.empty_like(out)
    for x, y in zip(left.T, right.T):
        np.subtract(x[:, None], y[None, :], out=gap)
        out += np.multiply(gap, gap, out=gap)
    return np.sqrt(out, out=out)


def distance_slices(left: np.ndarray, right: np.ndarray, edge: float | None = None) -> Iterator[tuple[slice, np.ndarray]]:
    """Euclidean distances of slices of the left points to all right ones; the next slice reuses the memory.

    Many coordinates are compared by a matrix product around a common centre. What is so near that this would
    lose digits, or so near to ``edge`` that rounding could move it across, is taken by
    differences, so that equal points are at exactly 0.
    """
    step = max(1, SLICE // max(1, len(right)))
    cuts = [slice(at, min(at + step, len(left))) for at in range(0, len(left), step)]
    wide = left.shape[1] > FEW_DIMS and len(right) > 0
    if wide:
        centre = right.mean(axis=0)
        a, b = left - centre, right - centre
        size_a, size_b = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
        scale = size_a.max(initial=0.0) + size_b.max()
        wide = bool(np.isfinite(scale))
    if not wide:
        for cut in cuts:
            yield cut, _by_differences(left[cut], right)
        return
    one, two = np.ones((len(a), 1)), np.ones((len(b), 1))
    rows, columns = np.hstack([-2 * a, size_a[:, None], one]), np.hstack([b, two, size_b[:, None]]).T.copy()
    memory = np.empty((step, len(b)))
    for cut in cuts:
        gap = np.matmul(rows[cut], columns, out=memory[: cut.stop - cut.start])
        doubtful = gap < NEAR * scale
        if edge is not None:
            doubtful |= np.abs(gap - edge * edge) < ROUNDING * scale
        if doubtful.any():
            i, j = np.nonzero(doubtful)
            apart = left[cut][i] - right[j]
            gap[i, j] = np.einsum("ij,ij->i", apart, apart)
        yield cut, np.sqrt(gap, out=gap)


def distances(left: np.ndarray, right: np.ndarray, edge: float | None = None) -> np.ndarray:
    """Euclidean distances of all left to all right points; see :func:`distance_slices`."""
    out = np.empty((len(left), len(right)))
    for cut, gap in distance_slices(left, right, edge):
        out[cut] = gap
    return out


def cluster_tiles(points: DataFrame, cluster: str, key: str, rows: int = TILE_ROWS) -> tuple[DataFrame, int]:
    """Add ``_tile`` and ``_whole`` so that a small cluster lies in one tile.

    Clusters above ``rows`` points are spread over tiles of their own
    (``_whole`` is false there). Also returns the number of tiles.
    """
    sizes = settle(points.groupBy(cluster).agg(F.count("*").alias("_size")), "sizes")
    total = sizes.agg(F.sum("_size")).first()[0] or 0
    shared = max(1, math.ceil(total / rows))
    big = sizes.where(F.col("_size") > rows).withColumn("_parts", F.ceil(F.col("_size") / rows))
    before = F.sum("_parts").over(whole_table().orderBy(cluster)) - F.col("_parts")
    spread = settle(big.select(cluster, "_parts", (before + shared).alias("_first")), "spread")
    extra = spread.agg(F.coalesce(F.sum("_parts"), F.lit(0))).first()[0]
    inside = F.col("_first") + F.pmod(F.xxhash64(key), F.col("_parts"))
    tile = F.coalesce(inside, F.pmod(F.xxhash64(cluster), F.lit(shared)))
    tiled = points.join(spread, cluster, "left").withColumn("_tile", tile.cast("int"))
    tiled = tiled.withColumn("_whole", F.col("_parts").isNull()).drop("_parts", "_first")
    return tiled, int(shared + extra)


def even_tiles(points: DataFrame, key: str, rows: int = TILE_ROWS) -> tuple[DataFrame, int]:
    """Add ``_tile``, spreading points evenly; also returns the number of tiles."""
    n = max(1, math.ceil(points.count() / rows))
    return points.withColumn("_tile", F.pmod(F.xxhash64(key), F.lit(n)).cast("int")), n


def _cogroup(left: DataFrame, right: DataFrame, block, schema: str) -> DataFrame:
    """Hand each pair of tiles to ``block``; both sides may stem from one table, so
    the columns of one side get names of their own."""
    other = right.select([F.col(c).alias(c) for c in right.columns])
    names = T.StructType.fromDDL(schema).names

    def run(lhs: pd.DataFrame, rhs: pd.DataFrame) -> pd.DataFrame:
        if lhs.empty or rhs.empty:
            return pd.DataFrame(columns=names)
        return block(lhs, rhs)

    return left.groupBy("_lt", "_rt").cogroup(other.groupBy("_lt", "_rt")).applyInPandas(run, schema)


def tile_against_tile(
    left: DataFrame, n_left: int, right: DataFrame, n_right: int, block, schema: str
) -> DataFrame:
    """Run ``block(left_tile, right_tile)`` for all tile combinations.

    Both inputs carry ``_tile``; each row is repeated once per tile (not per row)
    of the other side.
    """

    def others(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    lhs = left.withColumnRenamed("_tile", "_lt").withColumn("_rt", others(n_right))
    rhs = right.withColumnRenamed("_tile", "_rt").withColumn("_lt", others(n_left))
    return _cogroup(lhs, rhs, block, schema)


def tiles_once(tiled: DataFrame, n: int, block, schema: str) -> DataFrame:
    """Run ``block(tile, other_tile)`` once for each two of ``n`` tiles and for each tile with itself."""
    lhs = tiled.withColumnRenamed("_tile", "_lt").withColumn("_rt", F.explode(F.sequence("_lt", F.lit(n - 1))))
    rhs = tiled.withColumnRenamed("_tile", "_rt").withColumn("_lt", F.explode(F.sequence(F.lit(0), "_rt")))
    return _cogroup(lhs, rhs, block, schema)


def _tile_name() -> Column:
    return F.concat_ws(",", F.col("_cell").cast("array<string>"), F.col("_sub").cast("string"))


def near_tiles(
    points: DataFrame, vector: str, key: str, radius: float, rows: int = TILE_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Tiles by place, and the tile combinations that can hold points within ``radius``."""
    return reaching_tiles(points, vector, key, radius, rows)[:2]


def reaching_tiles(
    points: DataFrame, vector: str, key: str, radius: float, rows: int = TILE_ROWS
) -> tuple[DataFrame, DataFrame, float]:
    """Tiles by place, the combinations that can hold points within a reach, and that reach,
    which is ``radius`` or more. An infinite radius combines all tiles.

    The grid covers the leading coordinates: points within ``radius`` in the full
    space are within it there too, so no pair is lost in any dimension. A cell is at
    least ``radius`` wide, and wider where the bulk of the data is sparse; a crowded cell is
    split into tiles of about ``rows`` points.
    """
    axes = [F.get(F.col(vector), F.lit(i)).cast("double") for i in range(GRID_DIMS)]
    # Where the bulk lies; a few far points must not widen the cells of all others.
    reach = [
        F.percentile_approx(c, share, 1000).alias(f"{name}{i}")
        for i, c in enumerate(axes)
        for name, share in (("low", 0.01), ("high", 0.99))
    ]
    extent = points.agg(F.count("*").alias("n"), *reach).first()
    dims = max(1, sum(extent[f"low{i}"] is not None for i in range(GRID_DIMS)))
    per_axis = max(1.0, (extent["n"] / rows) ** (1.0 / dims))
    lows = [extent[f"low{i}"] or 0.0 for i in range(dims)]
    spans = [(extent[f"high{i}"] or 0.0) - low for i, low in enumerate(lows)]
    sides = [max(radius, span / per_axis) * (1 + 1e-9) or 1.0 for span in spans]
    cell = F.array(*[F.floor((c - F.lit(low)) / F.lit(side)) for c, low, side in zip(axes, lows, sides)])
    placed = points.withColumn("_cell", cell)
    counts = placed.groupBy("_cell").agg(F.count("*").alias("_n"))
    subs = settle(counts.select("_cell", F.ceil(F.col("_n") / rows).alias("_subs")), "cells")
    tiled = placed.join(subs, "_cell").withColumn("_sub", F.pmod(F.xxhash64(key), F.col("_subs")))
    tiled = tiled.withColumn("_tile", _tile_name()).drop("_cell", "_sub", "_subs")

    tiles = subs.select("_cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_subs") - 1)).alias("_sub"))
    shifts = F.array(*[F.array(*[F.lit(s).cast("bigint") for s in shift]) for shift in product((-1, 0, 1), repeat=dims)])
    around = tiles.select(
        _tile_name().alias("_lt"),
        F.explode(F.transform(shifts, lambda s: F.zip_with(F.col("_cell"), s, lambda a, b: a + b))).alias("_cell"),
    )
    pairs = around.join(tiles, "_cell").select("_lt", _tile_name().alias("_rt"))
    return tiled, pairs, min(sides) / (1 + 1e-9)


def near_blocks(left: DataFrame, right: DataFrame, pairs: DataFrame, block, schema: str) -> DataFrame:
    """Run ``block(left_tile, right_tile)`` for the given tile combinations."""
    lhs = left.withColumnRenamed("_tile", "_lt").join(pairs, "_lt")
    rhs = right.withColumnRenamed("_tile", "_rt").join(pairs, "_rt")
    return _cogroup(lhs, rhs, block, schema)


# --------------------------------------------------- searches bounded by boxes


def exact_slices(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Like :func:`distance_slices`, by differences whatever the number of coordinates."""
    step = max(1, SLICE // max(1, len(right)))
    for at in range(0, len(left), step):
        cut = slice(at, min(at + step, len(left)))
        yield cut, _by_differences(left[cut], right)


def has_place(vector: str) -> Column:
    """Has the vector only finite coordinates?"""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(finite, F.lit(False))


def box_tiles(points: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Points (``key, vector``, finite) with ``_tile``, and the boxes of the tiles: ``_tile, low, high, n``.

    Slabs of equal numbers of points are cut along the leading coordinates in turn, so that a
    tile is small where points are many. What cannot be cut, as the leading coordinates are
    equal, is dealt by key. Boxes cover the first ``BOX_DIMS`` coordinates.
    """
    shape = points.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dims")).first()
    dims = max(1, shape["dims"] or 1)
    cut_dims = min(dims, GRID_DIMS)
    per_axis = math.ceil(max(1.0, shape["n"] / rows) ** (1.0 / cut_dims))
    placed = points.withColumn("_tile", F.lit(0).cast("bigint"))
    if per_axis > 1:
        shares = [i / per_axis for i in range(1, per_axis)]
        for axis in range(cut_dims):
            x = F.get("vector", F.lit(axis))
            cuts = placed.groupBy("_tile").agg(F.percentile_approx(x, shares, 1000).alias("_cuts"))
            cuts = settle(cuts, "cuts")
            slab = F.size(F.filter("_cuts", lambda c: c < x))  # noqa: B023
            placed = placed.join(cuts, "_tile").withColumn("_tile", F.col("_tile") * per_axis + slab).drop("_cuts")
        subs = placed.groupBy("_tile").agg(F.ceil(F.count("*") / (2 * rows)).alias("_subs"))
        placed = placed.join(settle(subs, "subs"), "_tile")
        sub = F.pmod(F.xxhash64("key"), F.col("_subs"))
        placed = placed.withColumn("_tile", F.concat_ws("-", F.col("_tile").cast("string"), sub.cast("string"))).drop("_subs")
    else:
        placed = placed.withColumn("_tile", F.lit("0-0"))
    placed = settle(placed, "tiled")
    ends = [F.get("vector", F.lit(i)) for i in range(min(dims, BOX_DIMS))]
    boxes = placed.groupBy("_tile").agg(
        F.array(*map(F.min, ends)).alias("low"), F.array(*map(F.max, ends)).alias("high"), F.count("*").alias("n")
    )
    return placed, settle(boxes, "boxes")


def _far_boxes(low: Column, high: Column, other_low: Column, other_high: Column) -> Column:
    """Distance of two boxes."""
    minus = lambda a, b: a - b
    gaps = F.zip_with(
        F.zip_with(other_low, high, minus), F.zip_with(low, other_high, minus), lambda a, b: F.greatest(a, b, F.lit(0.0))
    )
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x * x))


def _from_box(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Distance of each point to a box over its leading coordinates."""
    out = np.zeros(len(points))
    for x, least, most in zip(points.T, low, high):
        gap = np.maximum(np.maximum(least - x, x - most), 0.0)
        out += gap * gap
    return np.sqrt(out)


def searches(sources: DataFrame, boxes: DataFrame, once: bool = False) -> DataFrame:
    """Sources (``key, vector, bound, _tile``, ...) once for each other tile, now ``_tile``, whose box
    is within their own ``bound``.

    With ``boxes.part``, the tile's only part or null, a source leaves out tiles that lie wholly in its
    own ``part``. With ``once`` only one of two tiles searches the other one.
    """
    widest = sources.groupBy("_tile").agg(F.max("bound").alias("widest"))
    one = boxes.join(widest, "_tile").select(F.col("_tile").alias("_lt"), F.col("low").alias("_low"), F.col("high").alias("_high"), "widest")
    given = [c for c in ("part",) if c in boxes.columns]
    two = boxes.select(F.col("_tile").alias("_rt"), "low", "high", *given)
    far = _far_boxes(F.col("_low"), F.col("_high"), F.col("low"), F.col("high"))
    ordered = F.col("_lt") < F.col("_rt") if once else F.col("_lt") != F.col("_rt")
    pairs = one.join(two, ordered & (far <= F.col("widest") * SLACK)).select("_lt", "_rt", "low", "high", *given)
    names = sources.columns

    def run(points: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if points.empty or near.empty:
            return pd.DataFrame(columns=names)
        place, bound, out = matrix(points["vector"]), points["bound"].to_numpy() * SLACK, []
        low, high, tile = matrix(near["low"]), matrix(near["high"]), near["_rt"].to_numpy()
        for i in range(len(near)):
            wanted = _from_box(place, low[i], high[i]) <= bound
            if given:
                wanted &= (points["part"] != near["part"].iat[i]).to_numpy()
            if wanted.any():
                out.append(points[wanted].assign(_tile=tile[i]))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=names)

    return sources.groupBy("_tile").cogroup(pairs.groupBy("_lt")).applyInPandas(run, sources.schema)


def search_blocks(requests: DataFrame, tiled: DataFrame, block, schema: str) -> DataFrame:
    """Run ``block(searching points, points of the tile)`` for each tile; many searches of one tile are dealt
    over tasks."""
    requests = settle(requests, "requests")
    chunks = requests.groupBy("_tile").agg(F.ceil(F.count("*") / SEARCHES).alias("_chunks"))
    chunks = settle(chunks, "chunks")
    lhs = requests.join(chunks, "_tile").withColumn("_rt", F.pmod(F.xxhash64("key"), F.col("_chunks"))).drop("_chunks")
    rhs = tiled.join(chunks, "_tile").withColumn("_rt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_chunks") - 1))).drop("_chunks")
    return _cogroup(lhs.withColumnRenamed("_tile", "_lt"), rhs.withColumnRenamed("_tile", "_lt"), block, schema)
