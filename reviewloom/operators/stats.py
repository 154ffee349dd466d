"""Aggregations. Hot groups are safe: every aggregate combines before the shuffle,
and totals over groups are taken from the aggregated table, never from its input."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from reviewloom.contracts import NOISE
from reviewloom.operators.joins import name_meta_category
from reviewloom.operators.ranks import locate_ranks, value_bucket, whole_table


def corpus_profile(df: DataFrame) -> DataFrame:
    """Rows, distinct products, distinct categories.

    Counting per (category, asin) first leaves the distinct counts a table that is
    smaller than the reviews by the number of reviews per product.
    """
    pairs = df.groupBy("category", "asin").agg(F.count("*").alias("n"))
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_reviews"),
        F.count_distinct("asin").alias("n_products"),
        F.count_distinct("category").alias("n_categories"),
    )


def products_per_cluster(df: DataFrame, approx: bool = False, rsd: float = 0.02) -> DataFrame:
    """Distinct products per meta-category; ``approx`` trades exactness for one
    small sketch per task."""
    count = F.approx_count_distinct("asin", rsd) if approx else F.count_distinct("asin")
    known = df.where(F.col("meta_category").isNotNull())
    return known.groupBy("meta_category").agg(count.alias("n_products"))


def class_counts(df: DataFrame) -> DataFrame:
    known = df.where(F.col("sentiment").isNotNull())
    return known.groupBy("split", "sentiment").agg(F.count("*").alias("n_rows"))


def class_shares(df: DataFrame, columns: tuple[str, ...] = ("rating", "sentiment")) -> DataFrame:
    """Normalized distribution of each column within each split, in long form."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
    long = df.select("split", F.inline(pairs)).where(F.col("value").isNotNull())
    counts = long.groupBy("split", "field", "value").agg(F.count("*").alias("n_rows"))
    total = F.sum("n_rows").over(W.partitionBy("split", "field"))
    return counts.withColumn("share", F.col("n_rows") / total)


def removal_report(before: DataFrame, after: DataFrame, by: str = "split") -> DataFrame:
    """Rows before and after a cleaning step, removed rows and their percentage."""
    tagged = before.select(by, F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select(by, F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    counts = tagged.groupBy(by).agg(F.sum("b").alias("n_before"), F.sum("a").alias("n_after"))
    removed = F.col("n_before") - F.col("n_after")
    return counts.withColumn("n_removed", removed).withColumn(
        "pct_removed", F.coalesce(F.try_divide(removed * F.lit(100.0), "n_before"), F.lit(0.0))
    )


def meta_category_counts(df: DataFrame, names: dict[int, str] | None = None) -> DataFrame:
    """Reviews per meta-category with its name; rank 1 is the largest."""
    known = df.where(F.col("meta_category").isNotNull())
    counts = known.groupBy("meta_category").agg(F.count("*").alias("n_reviews"))
    rank = F.row_number().over(whole_table().orderBy(F.desc("n_reviews"), "meta_category"))
    return name_meta_category(counts.withColumn("size_rank", rank), names)


def meta_category_ids(df: DataFrame) -> DataFrame:
    return df.select("meta_category").where(F.col("meta_category").isNotNull()).distinct()


def subcategory_counts(df: DataFrame) -> DataFrame:
    """Rows per category inside each meta-category."""
    known = df.where(F.col("meta_category").isNotNull() & F.col("category").isNotNull())
    return known.groupBy("meta_category", "category").agg(F.count("*").alias("n_reviews"))


def product_stats(df: DataFrame, by: tuple[str, ...] = ("asin",)) -> DataFrame:
    """Rated reviews, mean rating, helpful votes and category of each product.

    ``n_rows`` counts all its reviews, ``n_rated`` those with a rating. The category
    is the alphabetically first one, which a product of one category has anyway.
    Reviews are first summed per product and category: those are plain numbers, which
    Spark keeps in a hash table, where a minimum over names would sort every review.
    """
    keyed = df
    for key in by:
        keyed = keyed.where(F.col(key).isNotNull())
    cells = keyed.groupBy(*dict.fromkeys([*by, "category"])).agg(
        F.count("*").alias("n_rows"),
        F.count("rating").alias("n_rated"),
        F.sum("rating").alias("_stars"),
        F.coalesce(F.sum("helpful_vote"), F.lit(0)).alias("helpful_votes"),
    )
    mean = F.try_divide(F.sum("_stars"), F.sum("n_rated")).alias("mean_rating")
    sums = {name: F.sum(name).alias(name) for name in ("n_rows", "n_rated", "helpful_votes")}
    category = [] if "category" in by else [F.min("category").alias("category")]
    return cells.groupBy(*by).agg(sums["n_rows"], sums["n_rated"], mean, sums["helpful_votes"], *category)


def min_reviews(stats: DataFrame, n: int = 10) -> DataFrame:
    return stats.where(F.col("n_rated") >= n)


def cluster_sizes(labels: DataFrame) -> DataFrame:
    """Categories per cluster. Noise is not listed but counts in the share's total."""
    counts = labels.groupBy("cluster").agg(F.count("*").alias("n_categories"))
    share = F.col("n_categories") / counts.agg(F.sum("n_categories")).scalar()
    return counts.withColumn("share", share).where(F.col("cluster") != NOISE)


def noise_report(labels: DataFrame) -> DataFrame:
    """One row: clusters, noise points, noise ratio. ``stability_score`` needs the
    cluster tree, which a flat cut does not have, so it is always null."""
    noise = F.col("cluster") == NOISE
    counts = labels.groupBy("cluster").agg(F.count("*").alias("n"))
    return counts.agg(
        F.count_if(~noise).alias("n_clusters"),
        F.coalesce(F.sum(F.when(noise, F.col("n"))), F.lit(0)).alias("n_noise"),
        F.sum("n").alias("n_points"),
    ).select(
        "n_clusters",
        "n_noise",
        F.try_divide(F.col("n_noise"), F.col("n_points")).alias("noise_ratio"),
        F.lit(None).cast("double").alias("stability_score"),
    )


def noise_categories(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("cluster") == NOISE).select("category")


def cluster_probability(labels: DataFrame, members: bool = False) -> DataFrame:
    """Size, mean and smallest membership probability of each cluster.

    ``members`` adds the category list as rows, one per category, instead of one long
    value per cluster.
    """
    real = labels.where(F.col("cluster") != NOISE)
    table = real.groupBy("cluster").agg(
        F.count("*").alias("n_categories"),
        F.avg("probability").alias("avg_probability"),
        F.min("probability").alias("min_probability"),
    )
    return table.join(real.select("cluster", "category"), "cluster") if members else table


def probability_moments(labels: DataFrame) -> DataFrame:
    """Mean and population deviation of membership, noise included."""
    return labels.agg(
        F.avg("probability").alias("mean_probability"),
        F.stddev_pop("probability").alias("std_probability"),
    )


def category_rollup(labels: DataFrame, names: dict[int, str] | None = None) -> DataFrame:
    """Category hierarchy: value 1 per category, totals per meta-category, grand total.

    ``level`` is 0 for a category, 1 for a meta-category, 3 for the grand total.
    """
    named = name_meta_category(labels.where(F.col("cluster") != NOISE), names, key="cluster")
    return named.rollup("meta_name", "category").agg(
        F.count("*").alias("n_categories"), F.grouping_id().cast("int").alias("level")
    )


QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)


def metric_quartiles(
    scores: DataFrame, metrics: list[str], points: tuple[float, ...] = QUARTILES, step: float = 1 / 4096
) -> DataFrame:
    """Box-plot values (interpolated quantiles) of each metric column, in long form.

    Equal values are counted before anything is ranked, so neither many articles
    nor one very common score makes a task large.
    """
    long = scores.unpivot([], metrics, "metric", "value").where(F.col("value").isNotNull())
    values = long.groupBy("metric", "value").agg(F.count("*").alias("n"))

    spot = [F.struct(F.lit(p).alias("p"), (F.lit(p) * (F.col("n") - 1)).alias("at")) for p in points]
    sides = F.array(
        F.struct(F.lit("lo").alias("side"), F.floor("at").alias("idx")),
        F.struct(F.lit("hi").alias("side"), F.ceil("at").alias("idx")),
    )

    def targets(sizes: DataFrame) -> DataFrame:
        spots = sizes.select("metric", F.inline(F.array(*spot)))
        cut = F.struct("p", (F.col("at") - F.floor("at")).alias("frac"), "side")
        return spots.select("metric", "p", "at", F.inline(sides)).select(
            "metric", cut.alias("cut"), (F.col("idx") + 1).cast("bigint").alias("k")
        )

    found = locate_ranks(
        values, ["metric"], ["value"], value_bucket(F.col("value"), step), targets, F.col("n")
    )
    low, high = (F.max(F.when(F.col("cut.side") == s, F.col("value"))) for s in ("lo", "hi"))
    ends = found.groupBy("metric", F.col("cut.p").alias("quantile"), F.col("cut.frac").alias("frac")).agg(
        low.alias("lo"), high.alias("hi")
    )
    return ends.select(
        "metric", "quantile", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")).alias("value")
    )


def probability_density(
    labels: DataFrame, grid_points: int = 200, reach: float = 3.0
) -> DataFrame:
    """Gaussian kernel density of membership probability per cluster.

    Scott's bandwidth; the grid runs ``reach`` bandwidths past the data. A cluster
    without spread has no curve. Equal probabilities are counted first, so the work
    is (distinct values × grid points), spread over all tasks.
    """
    known = labels.where(F.col("cluster") != NOISE)
    values = known.groupBy("cluster", "probability").agg(F.count("*").alias("n"))
    shape = (
        known.groupBy("cluster")
        .agg(
            F.count("*").alias("size"),
            F.stddev_samp("probability").alias("sd"),
            F.min("probability").alias("lowest"),
            F.max("probability").alias("highest"),
        )
        .where(F.col("highest") > F.col("lowest"))
        .withColumn("bandwidth", F.col("sd") * F.pow("size", F.lit(-0.2)))
    )
    start = F.col("lowest") - F.lit(reach) * F.col("bandwidth")
    stop = F.col("highest") + F.lit(reach) * F.col("bandwidth")
    at = start + (stop - start) * F.col("grid") / F.lit(grid_points - 1)
    z = (F.col("x") - F.col("probability")) / F.col("bandwidth")
    root = (2 * 3.141592653589793) ** 0.5
    kernel = F.col("n") * F.exp(-z * z / 2) / (F.col("size") * F.col("bandwidth") * F.lit(root))
    grid = F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("grid")
    curve = values.join(shape, "cluster").select("*", grid).withColumn("x", at)
    return curve.groupBy("cluster", "grid").agg(F.max("x").alias("x"), F.sum(kernel).alias("density"))
