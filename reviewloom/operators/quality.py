"""Row filters, label derivation and table checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from reviewloom.contracts import (
    SENTIMENT_IDS,
    SPLIT_COLUMNS,
    STRICT_COLUMNS,
    UNKNOWN_SOURCE,
    UNKNOWN_TOKEN,
    lookup,
    missing_columns,
)
from reviewloom.functions.text import computed_once, has_words, normalize_text
from reviewloom.operators.ranks import whole_table
from reviewloom.staging import settle

# Star rating → sentiment. Any other rating has none.
RATING_SENTIMENT = {1.0: "Negative", 2.0: "Negative", 3.0: "Neutral", 4.0: "Positive", 5.0: "Positive"}


def valid_reviews(df: DataFrame, min_rating: int = 1, max_rating: int = 5) -> DataFrame:
    """Rating within the bounds (inclusive) and a non-empty text."""
    text = F.col("text")
    return df.where(F.col("rating").between(min_rating, max_rating) & text.isNotNull() & (F.length(text) > 0))


def clean_raw(df: DataFrame, min_length: int = 4, split: str = "split") -> DataFrame:
    """Drop unrated training rows and, everywhere, null or very short texts."""
    rated = (F.col(split) != "train") | (F.col("rating") > 0)
    return df.where(rated & F.col("text").isNotNull() & (F.length("text") > min_length))


def drop_empty_processed(df: DataFrame, column: str = "processed_text") -> DataFrame:
    return df.where(F.length(column) > 0)


def min_words(df: DataFrame, n: int = 3, column: str = "processed_text") -> DataFrame:
    """Keep rows whose text has at least ``n`` words."""
    return df.where(has_words(F.col(column), n))


def dedup_reviews(
    df: DataFrame,
    keys: tuple[str, ...] = ("text", "rating", "category"),
    within: tuple[str, ...] = ("split",),
    row_id: str = "review_id",
) -> DataFrame:
    """Keep the first row (lowest id) of each set of equal rows, split by split.

    64-bit hashes are counted first. Rows whose hash is the only one of its kind stay
    without having been compared; only rows whose hash repeats are brought together, on
    all their keys, so equal hashes never merge different rows. The group limit Spark
    derives from ``= 1`` reduces copies before that shuffle.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*within, *keys))
    counts = hashed.groupBy("_hash").agg(F.count("*").alias("_n"))
    again = settle(counts.where("_n > 1").select("_hash"), "repeated")
    first = F.row_number().over(W.partitionBy("_hash", *within, *keys).orderBy(row_id))
    one = hashed.join(again, "_hash", "left_semi").withColumn("_copy", first).where(F.col("_copy") == 1)
    return hashed.join(again, "_hash", "left_anti").unionByName(one.drop("_copy")).select(df.columns)


def relabel_unknown(df: DataFrame) -> DataFrame:
    category = F.col("category")
    return df.withColumn("category", F.when(category == UNKNOWN_SOURCE, UNKNOWN_TOKEN).otherwise(category))


def sentiment_of(rating: Column) -> Column:
    """Sentiment of a whole-star rating, null for anything else."""
    out = F.lit(None).cast("string")
    for star, name in RATING_SENTIMENT.items():
        out = F.when(rating == star, name).otherwise(out)
    return out


def sentiment_label(df: DataFrame) -> DataFrame:
    return df.withColumn("sentiment", sentiment_of(F.col("rating")))


def encode_label(df: DataFrame, column: str = "sentiment", out: str = "label", strict: bool = False) -> DataFrame:
    """Sentiment → 0, 1, 2. An unknown name gives null, or an error if ``strict``."""
    code = lookup(SENTIMENT_IDS, F.col(column))
    if strict:
        message = F.concat(F.lit("unknown sentiment: "), F.coalesce(F.col(column), F.lit("null")))
        code = F.coalesce(code, F.raise_error(message).cast("int"))
    return df.withColumn(out, code)


def check_integrity(df: DataFrame, mode: str = "strict", by: list[str] | None = None) -> DataFrame:
    """Is a table fit to publish? One row (per ``by`` group) with counts and ``ok``.

    ``strict`` wants rows, the columns text, rating and category, and no null or
    empty text. ``rowcount`` only wants rows. An absent column makes ``ok`` false.
    """
    bad = F.lit(0)
    if "text" in df.columns:
        bad = F.when(F.col("text").isNull() | (F.col("text") == ""), 1).otherwise(0)
    totals = df.groupBy(*(by or [])).agg(
        F.count("*").alias("n_rows"), F.coalesce(F.sum(bad), F.lit(0)).cast("bigint").alias("n_bad_text")
    )
    ok = F.col("n_rows") > 0
    if mode == "strict":
        complete = not missing_columns(df, STRICT_COLUMNS)
        ok = ok & (F.col("n_bad_text") == 0) & F.lit(complete)
    elif mode != "rowcount":
        raise ValueError(f"unknown mode: {mode}")
    return totals.withColumn("ok", ok)


def verify_splits(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows, share of all rows and empty texts of each split, and whether it passes."""
    complete = not missing_columns(df, SPLIT_COLUMNS)
    empty = F.lit(0)
    if "processed_text" in df.columns:
        text = F.col("processed_text")
        empty = F.when(text.isNull() | (text == ""), 1).otherwise(0)
    counts = df.groupBy(split).agg(F.count("*").alias("n_rows"), F.sum(empty).cast("bigint").alias("n_empty"))
    total = F.sum("n_rows").over(whole_table())
    return counts.withColumn("share", F.col("n_rows") / total).withColumn(
        "ok", (F.col("n_empty") == 0) & F.lit(complete)
    )


def preprocess_dataset(
    df: DataFrame, text_column: str = "text", n_words: int = 3, strict: bool = False
) -> DataFrame:
    """Add ``processed_text`` unless it is there, then keep texts of enough words."""
    if "processed_text" not in df.columns:
        df = computed_once(df, "processed_text", normalize_text(F.col(text_column), strict))
    return min_words(df, n_words)
