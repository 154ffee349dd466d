"""Top-k per group.

Each ``row_number() <= k`` filter lets Spark keep only k rows per group and map
task before the shuffle, so a meta-category that holds most products stays cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from reviewloom.contracts import NOISE, UNKNOWN_TOKEN
from reviewloom.operators.ranks import range_positions, whole_table


def _top(df: DataFrame, groups: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*groups).orderBy(*order))
    return df.withColumn(name, rank).where(F.col(name) <= k)


class UnknownCategoryOnly(ValueError):
    """A meta-category has no named category."""


def main_subcategory(counts: DataFrame, strict: bool = False) -> DataFrame:
    """The category with most reviews per meta-category (ties: alphabetical).

    The unknown category is chosen only where there is no other; ``strict`` turns
    that case into an error.
    """
    unknown = (F.col("category") == UNKNOWN_TOKEN).cast("int")
    top = _top(counts, ["meta_category"], [unknown, F.desc("n_reviews"), F.col("category")], 1).drop("rank")
    if strict:
        message = F.concat(F.lit("no named category in meta-category "), F.col("meta_category"))
        named = F.when(unknown == 1, F.raise_error(message).cast("string")).otherwise(F.col("category"))
        top = top.withColumn("category", named)
    return top


def top_products(stats: DataFrame, k: int = 3, groups: list[str] | None = None) -> DataFrame:
    """Best mean rating, then most ratings, then asin."""
    order = [F.desc("mean_rating"), F.desc("n_rated"), F.col("asin")]
    return _top(stats, groups or ["meta_category"], order, k)


def worst_product(stats: DataFrame, k: int = 1, groups: list[str] | None = None) -> DataFrame:
    """Lowest mean rating, then most helpful votes, then asin."""
    order = [F.asc("mean_rating"), F.desc("helpful_votes"), F.col("asin")]
    return _top(stats, groups or ["meta_category"], order, k)


def most_reviewed_products(stats: DataFrame, k: int = 5, groups: list[str] | None = None) -> DataFrame:
    """Most rated reviews, then asin."""
    return _top(stats, groups or ["meta_category"], [F.desc("n_rated"), F.col("asin")], k)


def helpful_samples(
    reviews: DataFrame, k: int = 2, groups: list[str] | None = None, row_id: str = "review_id"
) -> DataFrame:
    """The most helpful reviews of each product."""
    order = [F.desc_nulls_last("helpful_vote"), F.col(row_id)]
    return _top(reviews, groups or ["meta_category", "asin"], order, k, "sample_rank")


def negative_samples(
    reviews: DataFrame, k: int = 2, groups: list[str] | None = None, row_id: str = "review_id"
) -> DataFrame:
    """The lowest rated, then most helpful, reviews of each product."""
    order = [F.asc_nulls_last("rating"), F.desc_nulls_last("helpful_vote"), F.col(row_id)]
    return _top(reviews, groups or ["meta_category", "asin"], order, k, "sample_rank")


def cluster_top_categories(labels: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` categories of each cluster by name, and its mean probability."""
    real = labels.where(F.col("cluster") != NOISE)
    first = _top(real, ["cluster"], [F.col("category")], k)
    names = first.groupBy("cluster").agg(
        F.array_sort(F.collect_list("category")).alias("_names")
    )
    means = real.groupBy("cluster").agg(F.avg("probability").alias("avg_probability"))
    return means.join(names, "cluster").select(
        "cluster", F.array_join("_names", ", ").alias("top_categories"), "avg_probability"
    )


def silhouette_profile(samples: DataFrame, gap: int = 10) -> DataFrame:
    """Stacked positions of a silhouette figure: samples ascending inside each
    cluster, clusters one above the other with ``gap`` rows between them."""
    real = samples.where(F.col("cluster") != NOISE)
    ranked = range_positions(real, ["cluster"], ["silhouette", "category"], "rank")
    sizes = real.groupBy("cluster").agg(F.count("*").alias("n"))
    stack = whole_table().orderBy("cluster")
    below = F.sum(F.col("n") + gap).over(stack) - F.col("n")
    starts = sizes.select("cluster", below.cast("bigint").alias("y_lower"))
    return ranked.join(starts, "cluster").select(
        "cluster", "category", "silhouette", "rank", (F.col("y_lower") + F.col("rank") - 1).alias("y")
    )
