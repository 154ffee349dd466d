"""Samples, splits and shuffles."""

from __future__ import annotations

from checks.base import rank, text
from checks.rows import SENTIMENT, SPLIT
from reviewloom.operators import quality, sampling
from reviewloom.sources import adapters
from pyspark.sql import functions as F


def _rank(spark, sf):
    return adapters.ranked_reviews(spark, sf)


def sample_per_category(spark, sf):
    return sampling.sample_per_category(_rank(spark, sf), 0.03).select("review_id", "category", "rating")


def sample_per_category_floor(spark, sf):
    return sampling.sample_per_category(_rank(spark, sf), 0.03, seed=7, rounding="floor").select("review_id", "category")


def stratified_split(spark, sf):
    return sampling.stratified_split(_rank(spark, sf)).select("review_id", "rating", "split")


def _unrated(spark, sf):
    """Every thirteenth product without a category and a rating."""
    rows, some = _rank(spark, sf), F.col("asin") % 13 != 0
    return rows.withColumn("category", F.when(some, F.col("category"))).withColumn("rating", F.when(some, F.col("rating")))


def sample_per_category_nulls(spark, sf):
    return sampling.sample_per_category(_unrated(spark, sf), 0.5).select("review_id", "category")


def stratified_split_nulls(spark, sf):
    return sampling.stratified_split(_unrated(spark, sf)).select("review_id", "rating", "split")


def check_min_class(spark, sf):
    return sampling.class_minimum(sampling.check_min_class(_rank(spark, sf)))


PER_CLASS, VAL, TEST = 200, 90, 60


def balanced_splits(spark, sf):
    rows = quality.sentiment_label(adapters.text_reviews(spark, sf))
    out = sampling.balanced_splits(rows, PER_CLASS, VAL, TEST)
    return out.select("review_id", "sentiment", "source_split", "split")


def balanced_splits_train_only(spark, sf):
    rows = quality.sentiment_label(adapters.text_reviews(spark, sf))
    out = sampling.balanced_splits(rows, PER_CLASS // 2, VAL, TEST, source_splits=["train"])
    return out.select("review_id", "sentiment", "source_split", "split")


def deterministic_shuffle(spark, sf):
    return sampling.deterministic_shuffle(_rank(spark, sf)).select("review_id", "shuffle_key", "position")


def split_leakage(spark, sf):
    return sampling.split_leakage(adapters.text_reviews(spark, sf))


def _sample(size: str, seed: int, columns: str) -> str:
    return rank(
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY md5('{seed}:' || review_id), review_id) AS pos,"
        f" count(*) OVER (PARTITION BY category) AS n FROM reviews) WHERE pos <= {size}"
    )


def _balanced(per_class: int, where: str) -> str:
    return text(
        f"""SELECT review_id, sentiment, source_split,
  CASE WHEN pos <= {per_class} THEN 'train' WHEN pos <= {per_class + VAL // 3} THEN 'val' ELSE 'test' END AS split
FROM (SELECT review_id, sentiment, split AS source_split,
             row_number() OVER (PARTITION BY sentiment ORDER BY md5('42:' || review_id), review_id) AS pos
      FROM (SELECT *, {SENTIMENT} AS sentiment FROM reviews WHERE {where}) WHERE sentiment IS NOT NULL)
WHERE pos <= {per_class + VAL // 3 + TEST // 3}"""
    )


UNRATED = """(SELECT * REPLACE (CASE WHEN asin % 13 <> 0 THEN category END AS category,
  CASE WHEN asin % 13 <> 0 THEN rating END AS rating) FROM reviews)"""

CASES = {
    "sample_per_category": (
        sample_per_category,
        _sample("round_even(0.03::DOUBLE * n, 0)", 42, "review_id, category, rating"),
    ),
    "sample_per_category_floor": (
        sample_per_category_floor,
        _sample("floor(0.03::DOUBLE * n)", 7, "review_id, category"),
    ),
    "stratified_split": (
        stratified_split,
        rank("SELECT review_id, rating, split FROM parted", "pool AS (SELECT * FROM reviews)", SPLIT),
    ),
    "sample_per_category_nulls": (
        sample_per_category_nulls,
        _sample("round_even(0.5::DOUBLE * n, 0)", 42, "review_id, category").replace("FROM reviews)", f"FROM {UNRATED})"),
    ),
    "stratified_split_nulls": (
        stratified_split_nulls,
        rank("SELECT review_id, rating, split FROM parted", f"pool AS (SELECT * FROM {UNRATED})", SPLIT.replace("USING (rating)", "ON ranked.rating IS NOT DISTINCT FROM quota.rating")),
    ),
    "check_min_class": (
        check_min_class,
        rank(
            "SELECT count(*) AS n_classes, min(n) AS smallest, min(n) >= 3 AS enough"
            " FROM (SELECT rating, count(*) AS n FROM reviews GROUP BY rating)"
        ),
    ),
    "balanced_splits": (balanced_splits, _balanced(PER_CLASS, "true")),
    "balanced_splits_train_only": (balanced_splits_train_only, _balanced(PER_CLASS // 2, "split = 'train'")),
    "deterministic_shuffle": (
        deterministic_shuffle,
        rank(
            "SELECT review_id, md5('42:' || review_id) AS shuffle_key,"
            " row_number() OVER (ORDER BY md5('42:' || review_id), review_id) AS position FROM reviews"
        ),
    ),
    "split_leakage": (
        split_leakage,
        text(
            "SELECT * FROM (SELECT text, max((split = 'train')::INT) AS in_train, max((split = 'val')::INT) AS in_val,"
            " max((split = 'test')::INT) AS in_test, count(*) AS n_rows FROM reviews GROUP BY text)"
            " WHERE in_train + in_val + in_test > 1"
        ),
    ),
}
