"""Writing tables, metrics and articles; publishing behind a check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewloom.operators.quality import check_integrity
from reviewloom.staging import fresh_path


def write_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite"
) -> DataFrame:
    """Write parquet and return the table read back.

    Rows are spread by Spark's rebalancing before the write, which gives files of
    even size and splits a partition value that holds much of the table. Overwriting
    replaces the whole table, also partitions that ``df`` has no rows for.
    """
    keys = partition_by or []
    out = df.hint("rebalance", *keys) if keys else df
    writer = out.write.mode(mode).option("partitionOverwriteMode", "static")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


def write_metrics(df: DataFrame, path: str, fmt: str = "csv") -> DataFrame:
    """Write a metric table as CSV with a header, or as JSON, and read it back."""
    spark = df.sparkSession
    if fmt == "csv":
        df.write.mode("overwrite").csv(path, header=True)
        return spark.read.schema(df.schema).csv(path, header=True)
    if fmt == "json":
        df.write.mode("overwrite").json(path, ignoreNullFields=False)
        return spark.read.schema(df.schema).json(path).select(df.columns)
    raise ValueError(f"unknown format: {fmt}")


def write_articles(df: DataFrame, path: str, text: str = "article") -> DataFrame:
    """One folder of text output per meta-category; returns ``meta_category, article``."""
    out = df.select("meta_category", F.col(text).alias("value"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("meta_category").text(path)
    back = df.sparkSession.read.text(path, wholetext=True)
    return back.select(
        F.col("meta_category").cast("int").alias("meta_category"),
        F.regexp_replace("value", r"\n\z", "").alias("article"),
    )


def publish_validated(
    df: DataFrame, target: str, mode: str = "strict", partition: str = "category"
) -> DataFrame:
    """Stage, verify, then replace: only categories that pass reach ``target``.

    The rows are written to a staging folder first and checked as they were
    written. Passing categories replace their partition of the target; rejected
    ones leave it as it was. Rows without a category (null or empty) are rejected, as
    no partition could be replaced by them alone. The result reports every category with
    its counts and whether it was published; a rejection is reported, not raised.
    """
    spark = df.sparkSession
    staged = write_table(df, fresh_path(spark, "publish"), [partition])
    checked = check_integrity(staged, mode, [partition])
    named = F.col(partition).isNotNull() & (F.col(partition).cast("string") != "")
    report = write_table(checked.withColumn("ok", F.col("ok") & named), fresh_path(spark, "publish-report"))
    good = staged.join(report.where("ok").select(partition), partition, "left_semi")
    good.hint("rebalance", partition).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(partition).parquet(target)
    return report.withColumnRenamed("ok", "published")
