"""Review digests and prompts: the best and worst products of every meta-category.

All meta-categories are handled in one plan. The reviews are scanned twice: once
without their text, to rank products; once to fetch the few sample texts of the
chosen products. What joins the second scan is a settled table of at most a few
rows per meta-category.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from reviewloom.contracts import RANKING_COLUMNS, UNKNOWN_TOKEN, require_columns
from reviewloom.functions.formats import one_decimal, thousands
from reviewloom.operators.joins import name_meta_category
from reviewloom.operators.ranking import (
    main_subcategory,
    most_reviewed_products,
    top_products,
    worst_product,
)
from reviewloom.staging import settle

# Headings and field labels of a digest.
TOP_HEADING = "\nTOP RATED PRODUCTS:"
WORST_HEADING = "\nWORST RATED PRODUCT WARNING:"
SAMPLES = "Sample Reviews:"
NEGATIVE_SAMPLES = "Sample Negative Reviews:"

_TOP, _WORST = "top", "worst"


def ranked_base(reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Product statistics inside each meta-category's main category.

    One aggregation by (meta-category, category, asin) serves both the choice of
    the main category and the ranking. Returns the statistics and one row per
    meta-category with its main category.
    """
    require_columns(reviews, RANKING_COLUMNS, "reviews")
    cells = (
        reviews.where(F.col("meta_category").isNotNull() & F.col("category").isNotNull())
        .groupBy("meta_category", "category", "asin")
        .agg(
            F.count("*").alias("n_rows"),
            F.count("rating").alias("n_rated"),
            F.avg("rating").alias("mean_rating"),
            F.coalesce(F.sum("helpful_vote"), F.lit(0)).alias("helpful_votes"),
        )
    )
    cells = settle(cells, "product-cells")
    counts = cells.groupBy("meta_category", "category").agg(F.sum("n_rows").alias("n_reviews"))
    main = settle(main_subcategory(counts), "main-category")
    stats = cells.where(F.col("asin").isNotNull()).join(
        main.select("meta_category", "category"), ["meta_category", "category"]
    )
    return stats, main


def _with_samples(reviews: DataFrame, picks: DataFrame, k: int) -> DataFrame:
    """Attach up to ``k`` sample texts to each picked product, best first.

    Top products show their most helpful reviews, the worst one its lowest rated.
    """
    slim = reviews.select("meta_category", "category", "asin", "rating", "helpful_vote", "text", "review_id")
    found = slim.join(picks.select("meta_category", "category", "asin", "role"), ["meta_category", "category", "asin"])
    low_first = F.when(F.col("role") == _WORST, F.col("rating"))
    order = [F.asc_nulls_last(low_first), F.desc_nulls_last("helpful_vote"), F.col("review_id")]
    rank = F.row_number().over(W.partitionBy("meta_category", "role", "asin").orderBy(*order))
    kept = found.withColumn("_n", rank).where(F.col("_n") <= k)
    text = F.transform(F.array_sort(F.collect_list(F.struct("_n", "text"))), lambda x: x["text"])
    samples = kept.groupBy("meta_category", "role", "asin").agg(F.array_join(text, "\n").alias("samples"))
    return picks.join(samples, ["meta_category", "role", "asin"], "left")


def _names(picks: DataFrame, product_names: DataFrame | None) -> DataFrame:
    fallback = F.concat(F.lit("Product "), F.col("asin").cast("string"))
    if product_names is None:
        return picks.withColumn("product", fallback)
    named = picks.join(product_names.select("asin", F.col("name").alias("_name")), "asin", "left")
    return named.withColumn("product", F.coalesce("_name", fallback)).drop("_name")


def _lines(*parts: Column | str) -> Column:
    cols = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat(*cols)


def _ordered(role: str) -> Column:
    """The blocks of one role in rank order; at most a handful per meta-category."""
    mine = F.collect_list(F.when(F.col("role") == role, F.struct("rank", "block")))
    return F.transform(F.array_sort(mine), lambda x: x["block"])


def review_digest(
    reviews: DataFrame,
    min_reviews: int = 10,
    n_top: int = 3,
    n_samples: int = 2,
    product_names: DataFrame | None = None,
) -> DataFrame:
    """One digest per meta-category: its top products and a warning about the worst.

    Columns: ``meta_category, category, review_data, n_qualified``. Only products of
    the main category with ``min_reviews`` ratings qualify. A meta-category without
    any has both headings, no blocks, and ``n_qualified = 0``.
    """
    stats, main = ranked_base(reviews)
    fit = stats.where(F.col("n_rated") >= min_reviews)
    best = top_products(fit, n_top).withColumn("role", F.lit(_TOP))
    worst = worst_product(fit, 1).withColumn("role", F.lit(_WORST))
    picks = settle(best.unionByName(worst), "picks")
    chosen = _names(_with_samples(reviews, picks, n_samples), product_names)
    heading = F.when(F.col("role") == _TOP, SAMPLES).otherwise(NEGATIVE_SAMPLES)
    block = _lines(
        "\nProduct: ", F.col("product"),
        "\nAverage Rating: ", one_decimal(F.col("mean_rating")), "/5",
        "\nTotal Reviews: ", F.col("n_rows").cast("string"),
        "\n", heading, "\n", F.coalesce("samples", F.lit("")),
    )
    texts = chosen.withColumn("block", block).groupBy("meta_category").agg(
        _ordered(_TOP).alias("_top"), _ordered(_WORST).alias("_worst")
    )
    qualified = fit.groupBy("meta_category").agg(F.count("*").alias("n_qualified"))
    none = F.array().cast("array<string>")
    pieces = F.concat(
        F.array(F.lit(TOP_HEADING)), F.coalesce("_top", none),
        F.array(F.lit(WORST_HEADING)), F.coalesce("_worst", none),
    )
    return (
        main.join(texts, "meta_category", "left")
        .join(qualified, "meta_category", "left")
        .select(
            "meta_category",
            "category",
            F.array_join(pieces, "\n").alias("review_data"),
            F.coalesce("n_qualified", F.lit(0)).alias("n_qualified"),
        )
    )


def review_digest_popular(
    reviews: DataFrame,
    n_top: int = 5,
    n_samples: int = 3,
    product_names: DataFrame | None = None,
    strict: bool = False,
) -> DataFrame:
    """Digest of the most reviewed products, without a minimum and without a warning.

    ``strict`` raises for a meta-category whose only category is the unknown one.
    """
    stats, main = ranked_base(reviews)
    if strict:
        message = F.concat(F.lit("no named category in meta-category "), F.col("meta_category"))
        unknown = F.col("category") == UNKNOWN_TOKEN
        main = main.withColumn(
            "category", F.when(unknown, F.raise_error(message).cast("string")).otherwise(F.col("category"))
        )
    top = most_reviewed_products(stats, n_top).withColumn("role", F.lit(_TOP))
    chosen = _names(_with_samples(reviews, settle(top, "picks"), n_samples), product_names)
    block = _lines(
        "\nProduct: ", F.col("product"),
        "\nCategory: ", F.col("category"),
        "\nTotal Reviews: ", thousands(F.col("n_rows")),
        "\nAverage Rating: ", one_decimal(F.col("mean_rating")), "/5",
        "\n", SAMPLES, "\n", F.coalesce("samples", F.lit("")),
    )
    texts = chosen.withColumn("block", block).groupBy("meta_category").agg(_ordered(_TOP).alias("_top"))
    return main.join(texts, "meta_category", "left").select(
        "meta_category",
        "category",
        F.coalesce(F.array_join("_top", "\n"), F.lit("")).alias("review_data"),
    )


PROMPT_TEMPLATE = (
    "Write a short buyer's guide about {meta_category} products from the customer reviews below.\n"
    "Use these parts, in this order:\n"
    "Title: an inviting comparison of three products\n"
    "Introduction: what was compared\n"
    "TOP 3 RECOMMENDED PRODUCTS: how they differ and what buyers complain about\n"
    "WORST PRODUCT WARNING: the product of {category} to avoid, and the reason\n"
    "Final Verdict: one recommendation per product and a last warning\n"
    "\nReview data:\n{review_data}\n"
)


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """Replace ``{name}`` placeholders by columns; values are never expanded again."""
    parts: list[Column] = []
    rest = template
    while rest:
        spots = [(rest.find("{" + name + "}"), name) for name in values if "{" + name + "}" in rest]
        if not spots:
            parts.append(F.lit(rest))
            break
        at, name = min(spots)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(values[name].cast("string"))
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts)


def prompt_table(
    digest: DataFrame, template: str = PROMPT_TEMPLATE, names: dict[int, str] | None = None
) -> DataFrame:
    """Add ``meta_name`` and the filled ``prompt`` to a digest table."""
    named = name_meta_category(digest, names)
    values = {
        "meta_category": F.col("meta_name"),
        "category": F.col("category"),
        "review_data": F.col("review_data"),
    }
    return named.withColumn("prompt", fill_template(template, values))


Generator = Callable[[pd.DataFrame], pd.Series]


def outline_generator(batch: pd.DataFrame) -> pd.Series:
    """Stand-in for a language model: a fixed five-part article from the digest."""

    def article(row) -> str:
        lines = [line for line in row.review_data.split("\n") if line.startswith("Product: ")]
        best, worst = lines[:-1], lines[-1:]
        return "\n".join(
            [
                f"Title: Choosing among {row.meta_name}",
                f"Introduction: What buyers report about {row.category}.",
                "TOP 3 RECOMMENDED PRODUCTS:",
                *best,
                "WORST PRODUCT WARNING:",
                *worst,
                "Final Verdict: Trust the ratings above.",
            ]
        )

    return pd.Series([article(row) for row in batch.itertuples(index=False)], dtype="object")


class UnknownMetaCategory(ValueError):
    """A meta-category was asked for that the prompts do not have."""


class ModelMissing(RuntimeError):
    """Generation was asked for without a generator."""


def article_generation(
    prompts: DataFrame, generator: Generator | None = outline_generator, only: list[int] | None = None
) -> DataFrame:
    """Apply a generator to every prompt: ``meta_category, article``.

    A generator maps a batch (pandas) with ``meta_category, meta_name, category,
    review_data, prompt`` to a series of texts; it runs in Arrow batches on the
    executors. ``only`` limits the run to some ids, all of which must exist.
    """
    if generator is None:
        raise ModelMissing("article generation needs a generator")
    if only is not None:
        wanted = prompts.sparkSession.createDataFrame([(i,) for i in only], "meta_category int")
        absent = wanted.join(prompts, "meta_category", "left_anti")
        if not absent.isEmpty():
            raise UnknownMetaCategory(f"not among the prompts: {sorted(only)}")
        prompts = prompts.join(wanted, "meta_category", "left_semi")
    slim = prompts.select("meta_category", "meta_name", "category", "review_data", "prompt")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"meta_category": batch["meta_category"], "article": generator(batch)})

    return slim.mapInPandas(run, "meta_category int, article string")
