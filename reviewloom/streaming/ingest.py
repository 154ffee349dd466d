"""Unattended ingest: a file stream takes the place of the ledger.

The stream's checkpoint remembers which files were read, so a restart neither skips
nor repeats any.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from reviewloom.contracts import RAW_REVIEW
from reviewloom.operators.quality import valid_reviews
from reviewloom.sources.reviews import category_of_file, ingest_category


def ingest_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType = RAW_REVIEW,
    needed_columns: list[str] | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Read every file that is new since the last run, keep valid reviews, append.

    Each batch lands in its own ``batch`` partition, which is overwritten when the
    batch has to run again; that makes the sink exactly-once. Batch numbers begin anew
    with each checkpoint, so the partition is named after both: streams with checkpoints
    of their own may share a target.
    """
    owner = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    )
    rows = ingest_category(stream, category_of_file(), needed_columns)

    def store(batch: DataFrame, number: int) -> None:
        tagged = valid_reviews(batch).withColumn("batch", F.lit(f"{owner}-{number}"))
        tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "batch", "category"
        ).parquet(target)

    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
