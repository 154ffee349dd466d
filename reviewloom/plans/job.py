"""The data job: from a folder of raw review files to verified splits on disk.

Every step can be run again. Files that the ledger knows are not read twice, the sample of
a file replaces what an earlier attempt left of it, and the splits are written anew from
all samples.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reviewloom.contracts import RAW_REVIEW
from reviewloom.operators.quality import verify_splits
from reviewloom.operators.ranks import range_positions
from reviewloom.operators.sampling import sample_per_category
from reviewloom.plans.prepare import prepare
from reviewloom.sources.ledger import pending_files, read_ledger, record_progress
from reviewloom.sources.reviews import category_of_file, file_row_report, ingest_category, scan_reviews
from reviewloom.sources.sinks import write_table
from reviewloom.staging import settle


def add_review_id(df: DataFrame, *also: str) -> DataFrame:
    """Add ``review_id``: a digest of all columns and the number among equal rows.

    ``also`` names columns that count for the digest but are dropped (the file, say). The
    same table always yields the same ids, copies get ids of their own, and only rows that
    repeat are moved.
    """
    values = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    rows = df.withColumn("_digest", F.md5(values)).drop(*also)
    repeated = settle(rows.groupBy("_digest").agg(F.count("*").alias("_n")).where("_n > 1").select("_digest"), "repeated")
    single = rows.join(repeated, "_digest", "left_anti").withColumn("_number", F.lit(1).cast("bigint"))
    copies = rows.join(repeated, "_digest", "left_semi").withColumn("_row", F.monotonically_increasing_id())
    numbered = range_positions(settle(copies, "copies"), ["_digest"], ["_row"], "_number").drop("_row")
    every = single.unionByName(numbered)
    return every.withColumn("review_id", F.concat_ws("-", "_digest", "_number")).drop("_digest", "_number")


@dataclass
class DataJob:
    """What a run of the job leaves: the splits as written, their check, and the ledger."""

    splits: DataFrame
    report: DataFrame
    ledger: DataFrame


def ingest_pending(
    spark: SparkSession, source: str, target: str, frac: float, seed: int = 42, schema: T.StructType = RAW_REVIEW
) -> DataFrame:
    """Sample every raw file that the ledger lacks into ``target/sampled``; returns the ledger.

    The sample of a file is its own partition, replaced if the file has to run again; the
    ledger learns of a file only after its sample is written.
    """
    book = f"{target}/ledger"
    present = file_row_report(spark, source).withColumnRenamed("file_name", "name")
    todo = settle(pending_files(present, read_ledger(spark, book)).join(present, "name"), "pending")
    rows = scan_reviews(spark, source, schema).withColumn("category", category_of_file())
    rows = rows.withColumn("name", F.col("_metadata.file_name")).join(todo.select("name"), "name", "left_semi")
    kept = ingest_category(rows.select("*"), F.col("category")).columns
    reviews = add_review_id(rows.select(*kept, F.col("name").alias("file")))
    sampled = settle(sample_per_category(reviews, frac, seed, group="file"), "sampled")
    sampled.hint("rebalance", "file").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "file"
    ).parquet(f"{target}/sampled")
    return record_progress(spark, book, todo)


def data_job(
    spark: SparkSession,
    source: str,
    target: str,
    variant: str = "normalized",
    frac: float = 0.03,
    test: float = 0.1,
    val: float = 0.1,
    seed: int = 42,
    schema: T.StructType = RAW_REVIEW,
) -> DataJob:
    """Ingest, sample, combine, clean, split, verify and write.

    Raises ``ValueError`` if a split fails its check; nothing is written to
    ``target/splits`` then.
    """
    ledger = ingest_pending(spark, source, target, frac, seed, schema)
    try:
        combined = spark.read.parquet(f"{target}/sampled").drop("file")
    except AnalysisException as missing:
        raise ValueError(f"no review files in {source}") from missing
    splits = settle(prepare(combined, variant, None, test, val, seed), "splits")
    report = settle(verify_splits(splits), "report")
    failed = [r["split"] for r in report.where("not ok").select("split").collect()]  # three splits
    if failed:
        raise ValueError(f"splits that fail their check: {sorted(failed)}")
    return DataJob(write_table(splits, f"{target}/splits", ["split"]), report, ledger)
