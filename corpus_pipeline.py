"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing, token files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewloom.llm import fertility, minhash, mixing, rans, winnow, wordids
from reviewloom.staging import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts outside the quality rules go."""
    return fertility.keep_fertile(docs, wordids.vocabulary("piece_bpe_32k.model"))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, 0.8).

    Of rows that repeat an id and a text one stays. Rows without an id stay.
    """
    verdicts = settle(minhash.near_duplicates(docs, minhash.MinHash(shingle=5, percent=80)), "verdicts")
    gone = verdicts.where(~F.col("kept")).select(F.col("doc_id").alias("__id")).distinct()
    repeated = verdicts.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias("__id"))
    repeated = repeated.count().where("count > 1").select("__id")
    out = gone.unionByName(repeated).hint("merge")  # grows with the corpus: not to be broadcast
    single = docs.join(out, F.col("doc_id") == F.col("__id"), "left_anti")
    again = docs.join(repeated, F.col("doc_id") == F.col("__id"), "left_semi")
    return single.unionByName(again.dropDuplicates(["doc_id", "text"]))


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that share a passage with the benchmark go."""
    return winnow.drop_contaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sources meet their target weights; a document used several times has as many rows."""
    return mixing.mixed_rows(docs)


def token_files(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mix as token files; one row per text, as read back."""
    return rans.token_files(docs, wordids.vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_to_weights),
    ("token_files", token_files),
]

# The tokenizer and the components of near duplicates are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each one written and read again."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, folder), name)
    return docs
