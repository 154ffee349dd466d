"""Article scores side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reviewloom.operators.articles import product_metrics, section_metrics, soft_match_score


def score_articles(
    articles: DataFrame, vectors: DataFrame | None = None, buckets: int = 0, key: str = "article_id"
) -> dict[str, DataFrame]:
    """Section, product and (given token vectors) soft-match scores per article."""
    parts = {
        "structure": section_metrics(articles).drop("generated", "source"),
        "products": product_metrics(articles).drop("generated", "source"),
    }
    if vectors is not None:
        parts["soft_match"] = soft_match_score(articles, vectors, buckets, key)
    return parts
