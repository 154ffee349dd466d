"""Exact ranks without sorting a whole group in one task.

A plain ``row_number()`` sends every row of a group to one task, which fails as
soon as one group holds a large share of the table. Here a group is cut into
order-preserving buckets; bucket counts (one small row each) say how many rows
come before a bucket, and only rows of one bucket ever have to be sorted together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from reviewloom.functions.hashing import order_digest
from reviewloom.staging import settle

# Hex digits of a digest that make a bucket. Finding a cut sorts two narrow columns of
# one bucket per group; numbering all rows sorts whole rows of every bucket.
CUT_DIGITS, POSITION_DIGITS = 3, 4


def whole_table() -> WindowSpec:
    """Window over all rows; only for tables that are already aggregated."""
    return W.partitionBy(F.lit(0))


def digest_bucket(digest: Column, digits: int = CUT_DIGITS) -> Column:
    """Leading hex digits of a digest: uniform and order-preserving."""
    return F.substring(digest, 1, digits)


def value_bucket(value: Column, step: float) -> Column:
    """Order-preserving buckets of width ``step`` over a number."""
    return F.floor(value / F.lit(step))


def _histogram(keyed: DataFrame, groups: list[str]) -> DataFrame:
    counts = keyed.groupBy(*groups, "_bucket").agg(F.sum("_weight").alias("_n"))
    upto = F.sum("_n").over(W.partitionBy(*groups).orderBy("_bucket"))
    return counts.withColumn("_before", upto - F.col("_n"))


def locate_ranks(
    rows: DataFrame,
    groups: list[str],
    order: list[str],
    bucket: Column,
    targets: Callable[[DataFrame], DataFrame],
    weight: Column | None = None,
) -> DataFrame:
    """Find the row that sits at a wanted rank of its group.

    ``targets`` receives the group sizes (``groups`` plus ``n``) and returns rows
    ``groups, cut, k``: the name of a cut and the rank (from 1) it asks for. The
    result has one row per cut with the ``order`` values found there. ``weight``
    lets one row stand for many equal ones.
    """
    weight = F.lit(1) if weight is None else weight
    key = group_key(groups)
    keyed = rows.select(key, *order, bucket.alias("_bucket"), weight.cast("bigint").alias("_weight"))
    histogram = settle(_histogram(keyed, ["_group"]), "histogram")
    sizes = histogram.groupBy("_group").agg(F.sum("_n").alias("n")).select("_group.*", "n")
    wanted = targets(sizes).select(key, "cut", "k")
    edges = (
        histogram.join(wanted, "_group")
        .where((F.col("k") > F.col("_before")) & (F.col("k") <= F.col("_before") + F.col("_n")))
        .select("_group", "cut", "_bucket", (F.col("k") - F.col("_before")).alias("_need"))
    )
    near = keyed.join(settle(edges, "edges"), ["_group", "_bucket"])
    running = W.partitionBy("_group", "cut").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        near.withColumn("_seen", F.sum("_weight").over(running))
        .where((F.col("_seen") >= F.col("_need")) & (F.col("_seen") - F.col("_weight") < F.col("_need")))
        .select("_group.*", "cut", *order)
    )


def group_key(groups: list[str]) -> Column:
    """The group of a row as one value that is never null: a null field equals a null field."""
    return F.struct(*groups).alias("_group")


def with_cuts(df: DataFrame, cuts: DataFrame, groups: list[str], how: str = "inner") -> DataFrame:
    """Rows of ``df`` with the cuts of their group, also where the group is null. A group of
    which nothing is wanted has no cuts: ``how="left"`` keeps its rows, without any."""
    keyed = cuts.select(group_key(groups), "cuts")
    return df.withColumn("_group", group_key(groups)).join(keyed, "_group", how).drop("_group")


def ranked_positions(
    df: DataFrame, groups: list[str], order: list[Column], bucket: Column, name: str = "position"
) -> DataFrame:
    """Add the rank (from 1) of every row inside its group.

    The bucket counts join on the same keys by which the rows are then sorted, so the
    rows are shuffled once.
    """
    keyed = df.withColumn("_bucket", bucket).withColumn("_weight", F.lit(1))
    histogram = _histogram(keyed, groups)
    within = F.row_number().over(W.partitionBy(*groups, "_bucket").orderBy(*order))
    return (
        keyed.drop("_weight")
        .join(histogram.drop("_n"), [*groups, "_bucket"])
        .withColumn(name, (F.col("_before") + within).cast("bigint"))
        .drop("_bucket", "_before")
    )


def range_positions(df: DataFrame, groups: list[str], order: list[str], name: str = "position") -> DataFrame:
    """Like :func:`ranked_positions`, for order columns of any type and any skew.

    Spark cuts the order into ranges of even size, also through the middle of a
    group or of many equal values (``order`` must end in a unique column). The
    ranges are written out, which fixes them for the counting that follows.
    """
    ranged = df.repartitionByRange(*groups, *order).withColumn("_range", F.spark_partition_id())
    fixed = settle(ranged, "ranges").withColumn("_all", F.lit(0))
    columns = [F.col(c) for c in order]
    return ranked_positions(fixed, groups or ["_all"], columns, F.col("_range"), name).drop("_range", "_all")


def hash_cuts(
    df: DataFrame,
    groups: list[str],
    seed: int,
    row_id: str,
    targets: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Cut points of a seeded shuffle inside each group, one row per group.

    Columns: ``groups`` and ``cuts``, a map from cut name to the (digest, id) pair
    of the last row before the cut. Only the group and id columns are read.
    """
    slim = df.select(*groups, order_digest(seed, F.col(row_id)).alias("_digest"), F.col(row_id).alias("_id"))
    found = locate_ranks(slim, groups, ["_digest", "_id"], digest_bucket(F.col("_digest")), targets)
    point = F.struct("_digest", "_id")
    cuts = found.groupBy(*groups).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("cut"), point))).alias("cuts")
    )
    return settle(cuts, "cuts")


def hash_point(seed: int, row_id: str) -> Column:
    """The (digest, id) pair of a row, comparable with the values of ``cuts``."""
    return F.struct(order_digest(seed, F.col(row_id)).alias("_digest"), F.col(row_id).alias("_id"))
