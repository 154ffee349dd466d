"""Which inputs have been processed, and what remains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewloom.contracts import LEDGER
from reviewloom.staging import settle


def pending_files(available: DataFrame, ledger: DataFrame, name: str = "name") -> DataFrame:
    """Names not in the ledger yet. Running it again changes nothing."""
    return available.select(name).distinct().join(ledger.select(name), name, "left_anti")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, or an empty one if none has been written."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def record_progress(spark: SparkSession, path: str, processed: DataFrame) -> DataFrame:
    """Append ``name, n_rows`` of newly processed inputs; known names are skipped."""
    known = read_ledger(spark, path)
    fresh = processed.select("name", F.col("n_rows").cast("bigint")).join(known, "name", "left_anti")
    entry = settle(fresh.withColumn("updated", F.current_timestamp()), "ledger")
    entry.write.mode("append").parquet(path)
    return read_ledger(spark, path)


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """One row: processed names, rows in total, time of the last update."""
    return ledger.agg(
        F.count("name").alias("n_completed"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_rows"),
        F.max("updated").alias("last_updated"),
    )


def reconcile_categories(
    every: DataFrame, backed_up: DataFrame, local: DataFrame, completed: DataFrame
) -> DataFrame:
    """Compare four sets of category names: one row per name with its state.

    ``remaining``: wanted but not backed up. ``local_only``: processed here, not
    backed up. ``unlisted``: backed up, but the ledger does not know it.
    """
    places = {"in_all": every, "in_backup": backed_up, "in_local": local, "in_ledger": completed}
    tagged = None
    for place, names in places.items():
        part = names.select("category", F.lit(place).alias("place"))
        tagged = part if tagged is None else tagged.unionByName(part)
    flags = [F.max(F.col("place") == place).alias(place) for place in places]
    state = tagged.groupBy("category").agg(*flags)
    return (
        state.withColumn("remaining", F.col("in_all") & ~F.col("in_backup"))
        .withColumn("local_only", F.col("in_local") & ~F.col("in_backup"))
        .withColumn("unlisted", F.col("in_backup") & ~F.col("in_ledger"))
    )


def reconcile_counts(state: DataFrame) -> DataFrame:
    """Totals of :func:`reconcile_categories` in one row."""
    flags = ["in_all", "in_backup", "in_local", "in_ledger", "remaining", "local_only", "unlisted"]
    return state.agg(*[F.count_if(F.col(f)).alias(f"n_{f}") for f in flags])
