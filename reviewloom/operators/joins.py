"""Lookups, semi and anti joins, unions.

No join here carries a broadcast hint: lookup tables arrive as settled files, so Spark
knows their size and decides by it; adaptive execution splits hot keys of the shuffled
case. Names of meta-categories are a literal map and need no join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from reviewloom.contracts import END_MARKER, META_CATEGORY_NAMES, lookup


def assign_meta_category(reviews: DataFrame, labels: DataFrame) -> DataFrame:
    """Add the cluster of each review's category; unknown categories get null."""
    mapping = labels.select("category", F.col("cluster").alias("meta_category"))
    return reviews.drop("meta_category").join(mapping, "category", "left")


def name_meta_category(
    df: DataFrame,
    names: dict[int, str] | None = None,
    key: str = "meta_category",
    out: str = "meta_name",
    fallback: bool = True,
) -> DataFrame:
    """Add the display name of a meta-category; ids without one become ``cluster N``
    (or stay null without ``fallback``). The names are a literal map, so no row moves."""
    name = lookup(names or META_CATEGORY_NAMES, F.col(key).cast("int"))
    if fallback:
        name = F.coalesce(name, F.concat(F.lit("cluster "), F.col(key)))
    return df.withColumn(out, name)


def reviews_of_selected(
    reviews: DataFrame, selected: DataFrame, keys: tuple[str, ...] = ("meta_category", "asin")
) -> DataFrame:
    """Reviews of the chosen products only."""
    return reviews.join(selected.select(*keys).distinct(), list(keys), "left_semi")


def missing_product_names(reviews: DataFrame, cache: DataFrame) -> DataFrame:
    """Products whose name is not cached yet."""
    asins = reviews.where(F.col("asin").isNotNull()).select("asin").distinct()
    return asins.join(cache.select("asin"), "asin", "left_anti")


def merge_product_names(cache: DataFrame, resolved: DataFrame) -> DataFrame:
    """Cache plus newly resolved names; a new name wins over a cached one, and a
    failed lookup (null name) falls back to ``Product <asin>``."""
    name = F.coalesce("name", F.concat(F.lit("Product "), "asin"))
    both = cache.select("asin", "name", F.lit(0).alias("age")).unionByName(
        resolved.select("asin", name.alias("name"), F.lit(1).alias("age"))
    )
    latest = F.row_number().over(W.partitionBy("asin").orderBy(F.desc("age"), "name"))
    return both.withColumn("_rank", latest).where("_rank = 1").select("asin", "name")


class NoTrainingText(ValueError):
    """No example could be joined with a prompt."""


def training_text(
    examples: DataFrame, prompts: DataFrame, end: str = END_MARKER, check: bool = False
) -> DataFrame:
    """Prompt, example output and end marker in one text per example.

    Examples whose meta-category has no review data are left out. ``check`` raises
    when nothing is left.
    """
    usable = prompts.where(F.trim("review_data") != "").select("meta_category", "prompt")
    out = examples.join(usable, "meta_category").select(
        "meta_category", F.concat("prompt", "output", F.lit(end)).alias("text")
    )
    if check and out.isEmpty():
        raise NoTrainingText("no valid training examples")
    return out


def union_splits(parts: dict[str, DataFrame]) -> DataFrame:
    """All rows of the named parts, with ``split`` telling them apart."""
    tagged = [df.withColumn("split", F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def product_overlap(df: DataFrame, generated: str = "generated", source: str = "source") -> DataFrame:
    """Compare two product arrays: shared, only generated, only in the source."""
    g, s = F.col(generated), F.col(source)
    return (
        df.withColumn("shared", F.array_intersect(g, s))
        .withColumn("only_generated", F.array_except(g, s))
        .withColumn("only_source", F.array_except(s, g))
    )
