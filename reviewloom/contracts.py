"""Schemas and fixed values shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# --- fixed values -----------------------------------------------------------
RAW_CONFIG_PREFIX = "raw_review_"
INGEST_COLUMNS = ["text", "rating", "asin", "title", "helpful_vote"]
UNKNOWN_SOURCE = "Unknown"
UNKNOWN_TOKEN = "[UNKNOWN]"
SENTIMENT_IDS = {"Negative": 0, "Neutral": 1, "Positive": 2}
META_CATEGORY_NAMES = {
    0: "Entertainment & General Retail",
    1: "Technology & Automotive",
    2: "Industrial & DIY",
    3: "Health & Beauty",
    4: "Home & Garden",
}
ARTICLE_SECTIONS = [
    "Title:",
    "Introduction:",
    "TOP 3 RECOMMENDED PRODUCTS:",
    "WORST PRODUCT WARNING:",
    "Final Verdict:",
]
END_MARKER = "</s>"
NOISE = -1
# ----------------------------------------------------------------------------

# The columns of a raw review, in the order of the source.
RAW_REVIEW = T.StructType(
    [
        T.StructField("rating", T.DoubleType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("images", T.ArrayType(T.StringType())),
        T.StructField("asin", T.StringType()),
        T.StructField("parent_asin", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("helpful_vote", T.LongType()),
        T.StructField("verified_purchase", T.BooleanType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("updated", T.TimestampType()),
    ]
)

SPLIT_COLUMNS = ["text", "processed_text", "rating", "category"]
STRICT_COLUMNS = ["text", "rating", "category"]
RANKING_COLUMNS = ["meta_category", "category", "asin", "rating", "helpful_vote", "text"]


class MissingColumns(ValueError):
    """A table lacks columns that an operator needs."""


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required names absent from ``df``, in the order they were asked for."""
    return [name for name in required if name not in df.columns]


def require_columns(df: DataFrame, required: Iterable[str], table: str = "table") -> DataFrame:
    """Return ``df`` unchanged, or raise when a required column is absent."""
    missing = missing_columns(df, required)
    if missing:
        raise MissingColumns(f"missing columns in {table}: {missing}")
    return df


def missing_column_report(
    spark: SparkSession, tables: dict[str, DataFrame], required: Iterable[str]
) -> DataFrame:
    """One row per table: how many required columns it lacks, and which."""
    required = list(required)
    rows = []
    for name, df in tables.items():
        missing = missing_columns(df, required)
        rows.append((name, len(missing), ",".join(sorted(missing))))
    return spark.createDataFrame(rows, "table_name string, n_missing bigint, missing string")


def meta_names(spark: SparkSession, names: dict[int, str] | None = None) -> DataFrame:
    """The id → display name table of the meta-categories."""
    rows = sorted((names or META_CATEGORY_NAMES).items())
    return spark.createDataFrame(rows, "meta_category int, name string")


def lookup(values: dict, key):
    """A literal map applied to a column; a key outside the map gives null."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.create_map(*pairs)[key]
