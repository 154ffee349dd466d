"""Mixing sources to target weights by subset-sum budgets.

Texts are counted by source and exact length. Each source's budget is filled with whole
passes over the source, then a share of every length, then a bounded-knapsack dynamic
program over the lengths left, which meets the rest to the word where lengths allow.
Which texts of a length are taken follows a seeded order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from reviewloom.llm.common import SPACE_PATTERN
from reviewloom.shipping import ship
from reviewloom.staging import settle

WEIGHTS = (5, 2, 1)  # of the sources by code point, repeating
REPEATS = 3  # no source and no text is used more often
GROUP = 50_000  # texts of one source and length that are ordered together


def text_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: the number of words of each text (null: 0)."""
    words = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), SPACE_PATTERN)
    size = F.size(words) - (F.get(words, F.lit(0)) == "").cast("int")
    last = F.when(F.size(words) > 1, (F.get(words, F.size(words) - 1) == "").cast("int")).otherwise(0)
    return docs.select(
        "doc_id", F.col("source").cast("string"), (size - last).cast("long").alias("size"), row_key(docs).alias("row")
    )


def row_key(docs: DataFrame) -> Column:
    """128 bits that tell rows apart by all their columns; a hash skips nulls, so these are told apart first."""
    missing = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in docs.columns])
    return F.concat_ws(" ", *[F.xxhash64(F.lit(half), missing, *docs.columns) for half in (1, 2)])


def source_targets(histogram: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Budget of each source: key, source_size, target.

    A source is never given more than ``repeats`` times its size; what it cannot use is
    shared by weight among the others until none is above. That point is the greatest
    level "rest of the budget / rest of the weights" met when sources are closed in order
    of their size by weight. One small row per source is sorted here, no text.
    """
    totals = histogram.groupBy("key", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ordered = W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights)))
    weighed = totals.withColumn("weight", F.get(F.array(*map(F.lit, weights)), place))
    cap = F.col("source_size") * repeats
    closing = W.partitionBy(F.lit(0)).orderBy(cap / F.col("weight"), "key")
    before = closing.rowsBetween(W.unboundedPreceding, -1)
    after = closing.rowsBetween(W.currentRow, W.unboundedFollowing)
    every = W.partitionBy(F.lit(0))
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    level = weighed.withColumn("level", rest / F.sum("weight").over(after))
    target = F.least(cap.cast("double"), F.col("weight") * F.max("level").over(every))
    return level.select("key", "source_size", target.alias("target"))


def knapsack(sizes: np.ndarray, free: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take, at most ``free``, for the greatest sum up to ``budget``.

    Each length becomes items of 1, 2, 4, ... copies; an item is noted at every sum it is
    the first to reach, which is enough to walk back.
    """
    taken = np.zeros(len(sizes), np.int64)
    reached, by = np.zeros(budget + 1, bool), np.full(budget + 1, -1, np.int64)
    reached[0], items = True, []
    for i in np.argsort(sizes, kind="stable"):
        left, copies = min(int(free[i]), budget // int(sizes[i])) if sizes[i] > 0 else 0, 1
        while left > 0 and not reached[budget]:
            copies = min(copies, left)
            weight = copies * int(sizes[i])
            if weight <= budget:
                new = np.flatnonzero(reached[: budget + 1 - weight] & ~reached[weight:]) + weight
                reached[new], by[new] = True, len(items)
                items.append((i, copies))
            left, copies = left - copies, copies * 2
        if reached[budget]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, copies = items[by[at]]
        taken[i] += copies
        at -= copies * int(sizes[i])
    return taken


def fill_budget(sizes: np.ndarray, counts: np.ndarray, target: float, repeats: int = REPEATS) -> tuple[int, np.ndarray]:
    """Whole passes over a source and, for each length, how many texts are taken once more."""
    total = int((sizes * counts).sum())
    if not total:
        return 0, np.zeros(len(sizes), np.int64)
    passes = min(int(target // total), repeats)
    budget = min(round(target) - passes * total, total) if passes < repeats else 0
    share = counts * (max(budget, 0) / total)
    extra = np.minimum(np.floor(share).astype(np.int64), counts)
    rest = max(budget, 0) - int((sizes * extra).sum())
    order = np.lexsort((sizes, -(share - extra)))
    fits = order[(np.cumsum(sizes[order]) <= rest) & (extra[order] < counts[order])]
    extra[fits] += 1
    rest -= int(sizes[fits].sum())
    if rest > 0:
        extra += knapsack(sizes, counts - extra, rest)
    return passes, extra


def _uses(docs: DataFrame, weights: tuple[int, ...], repeats: int, seed: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, uses, row."""
    ship(docs.sparkSession)
    key = F.when(F.col("source").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), "source")).alias("key")
    rows = settle(text_sizes(docs).select("doc_id", "source", key, "size", "row"), "sizes")
    histogram = settle(rows.groupBy("key", "source", "size").agg(F.count("*").alias("n")), "lengths")
    targets = settle(source_targets(histogram, weights, repeats), "targets")

    def plan(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("size")
        sizes, counts = part["size"].to_numpy(np.int64), part["n"].to_numpy(np.int64)
        passes, extra = fill_budget(sizes, counts, float(part["target"].iloc[0]), repeats)
        return part.assign(passes=passes, extra=extra)

    schema = "key string, size long, n long, source_size long, target double, passes long, extra long"
    known = histogram.drop("source").join(targets, "key")
    plans = settle(known.groupBy("key").applyInPandas(plan, schema), "plans")

    order = F.xxhash64(F.lit(seed), "doc_id", "row")  # rows of one id, or without any, are spread too
    unit = F.shiftrightunsigned(order, 11) / F.lit(float(1 << 53))
    groups = F.ceil(F.col("n") / F.lit(GROUP))
    placed = rows.drop("source").join(plans, ["key", "size"]).withColumn("order", order)
    placed = placed.withColumn("part", F.floor(unit * groups))
    parts = placed.groupBy("key", "size", "part").agg(F.count("*").alias("here"))
    upto = F.sum("here").over(W.partitionBy("key", "size").orderBy("part"))
    parts = parts.withColumn("before", upto - F.col("here")).drop("here")
    within = F.row_number().over(W.partitionBy("key", "size", "part").orderBy("order", "row"))
    ranked = placed.join(parts, ["key", "size", "part"]).withColumn("rank", F.col("before") + within)
    once_more = (F.col("rank") <= F.col("extra")).cast("long")
    return ranked.select(
        "doc_id", "size", "source_size", "target", (F.col("passes") + once_more).alias("uses"), "row"
    )


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = 3
) -> DataFrame:
    """Mix ``docs`` (doc_id, source, text): one row per input row.

    Columns: doc_id, size, source_size, target, taken (words used, repeats counted; a
    multiple of size). A null source is a source of its own, last in order. Null and empty
    texts have size 0 and are never taken; a source of size 0 has target 0. Rows that share
    a doc_id are separate texts; equal rows are alike, whichever is taken. A null
    doc_id sorts first. Other columns are ignored; an empty table gives an empty result.
    """
    used = _uses(docs, weights, repeats, seed)
    return used.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("uses")).alias("taken"))


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = 3) -> DataFrame:
    """The mix itself: rows of ``docs``, all columns as they are, each as often as it is used.

    Rows that differ in any column are used apart; equal rows as often as all of them
    together. Rows without a word are not part of a mix. Nulls and empty tables as above.
    """
    used = _uses(docs, weights, repeats, seed).where("size > 0")
    used = used.groupBy("row").agg(F.sum("uses").alias("__uses")).where("__uses > 0")
    used = used.withColumnRenamed("row", "__row")
    rows = docs.withColumn("__row", row_key(docs)).join(used, "__row").dropDuplicates(["__row"])
    return rows.withColumn("__uses", F.explode(F.sequence(F.lit(1), "__uses"))).select(*docs.columns)
