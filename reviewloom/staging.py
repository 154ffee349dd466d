"""Intermediate tables that are written once and read back.

Writing an intermediate result does three jobs at once: it cuts the lineage, it
survives the loss of an executor, and it gives the optimizer the *measured* size
of the table. Spark then broadcasts it only below
``spark.sql.autoBroadcastJoinThreshold`` and falls back to a shuffled join above,
so no operator in this package needs a blind broadcast hint.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY, _WAREHOUSE = "spark.checkpoint.dir", "spark.sql.warehouse.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # since Spark 4.1


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else the warehouse.

    A cluster must name one of the two; only a local master may rest on Spark's own
    default for the warehouse, a folder below the working directory.
    """
    given = spark.sparkContext.getConf()
    folder = spark.conf.get(_KEY, None) or given.get(_KEY)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") and not given.contains(_WAREHOUSE):
        raise ValueError(f"{_KEY} must name a folder shared by all executors")
    return spark.conf.get(_WAREHOUSE).rstrip("/")


def release(spark: SparkSession) -> None:
    """Delete everything this application has settled. For the end of a job: tables that
    were read from settled ones can no longer be computed afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/reviewloom/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call has returned."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "table", compact: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back.

    ``compact`` is for large tables: their files are packed tighter, and the shuffle files of the
    write go when it ends, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    if compact:
        before = spark.conf.get(_CLEANUP, None)
        spark.conf.set(_CLEANUP, "true")
        try:
            df.select("*").write.option("compression", "zstd").parquet(path)  # a new plan, which takes the setting on
        finally:
            spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
