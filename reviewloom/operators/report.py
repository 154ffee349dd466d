"""Tables behind the report figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewloom.contracts import NOISE, meta_names
from reviewloom.operators.joins import name_meta_category

# Node sizes of the category graph.
META_SIZE, SUB_SIZE = 2000, 1000


def metric_bars(metrics: DataFrame) -> DataFrame:
    """Numeric, non-null metrics of a one-row table in long form."""
    kinds = ("double", "float", "int", "bigint")
    numeric = [F.col(c).cast("double").alias(c) for c, t in metrics.dtypes if t in kinds]
    wide = metrics.select(numeric)
    return wide.unpivot([], wide.columns, "metric", "value").where(F.col("value").isNotNull())


def _members(labels: DataFrame, names: dict[int, str] | None) -> DataFrame:
    """Categories of the named clusters; others do not appear in the figures."""
    known = name_meta_category(labels, names, key="cluster", fallback=False)
    return known.where(F.col("meta_name").isNotNull())


def category_graph(labels: DataFrame, names: dict[int, str] | None = None) -> DataFrame:
    """Node and edge rows of the star graph meta-category → category.

    ``kind`` is ``node`` (with ``node_type`` and ``size``) or ``edge`` (with ``target``).
    """
    none = F.lit(None)
    members = _members(labels, names)
    metas = meta_names(labels.sparkSession, names).select(
        F.lit("node").alias("kind"), F.col("name").alias("source"), none.cast("string").alias("target"),
        F.lit("meta").alias("node_type"), F.lit(META_SIZE).alias("size"),
    )
    rows = F.array(
        F.struct(F.lit("node").alias("kind"), F.col("category").alias("source"), none.cast("string").alias("target"),
                 F.lit("sub").alias("node_type"), F.lit(SUB_SIZE).alias("size")),
        F.struct(F.lit("edge").alias("kind"), F.col("meta_name").alias("source"), F.col("category").alias("target"),
                 none.cast("string").alias("node_type"), none.cast("int").alias("size")),
    )
    return metas.unionByName(members.select(F.inline(rows)))


def treemap_rows(labels: DataFrame, names: dict[int, str] | None = None) -> DataFrame:
    """Membership probability per category with the totals above it.

    ``level`` is 0 for a category, 1 for a meta-category, 3 for the grand total.
    """
    return _members(labels, names).rollup("meta_name", "category").agg(
        F.sum("probability").alias("probability"), F.grouping_id().cast("int").alias("level")
    )


def cluster_contents(labels: DataFrame, names: dict[int, str] | None = None) -> DataFrame:
    """Categories of every named cluster, one row each.

    A named cluster without categories keeps one row with a null category; clusters
    without a name are left out. One row per category keeps a large cluster from
    becoming one huge value.
    """
    known = name_meta_category(labels.where(F.col("cluster") != NOISE), names, key="cluster", out="name", fallback=False)
    filled = known.where(F.col("name").isNotNull()).select(F.col("cluster").cast("int").alias("meta_category"), "name", "category")
    everything = meta_names(labels.sparkSession, names)
    empty = everything.join(filled.select("meta_category").distinct(), "meta_category", "left_anti")
    return filled.unionByName(empty.withColumn("category", F.lit(None).cast("string")))
