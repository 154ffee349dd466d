"""Classification measures. Inputs are predictions with integer ``label`` and
``prediction``; everything but the loss works on the confusion counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.contracts import SENTIMENT_IDS
from reviewloom.functions.hashing import order_digest
from reviewloom.operators.ranks import POSITION_DIGITS, digest_bucket, ranked_positions, whole_table

N_CLASSES = len(SENTIMENT_IDS)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight n / (k · n_c) per class; k counts the classes present."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n_rows"))
    weight = F.sum("n_rows").over(whole_table()) / (F.count("*").over(whole_table()) * F.col("n_rows"))
    return counts.withColumn("weight", weight)


def confusion_counts(df: DataFrame) -> DataFrame:
    known = df.where(F.col("label").isNotNull() & F.col("prediction").isNotNull())
    return known.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, n_classes: int = N_CLASSES) -> DataFrame:
    """One row per true class, one column per predicted class, zeros included."""
    classes = df.sparkSession.range(n_classes).select(F.col("id").cast("int").alias("label"))
    cells = [
        F.coalesce(F.sum(F.when(F.col("prediction") == c, F.col("n"))), F.lit(0)).alias(f"pred_{c}")
        for c in range(n_classes)
    ]
    return classes.join(confusion_counts(df), "label", "left").groupBy("label").agg(*cells)


def _ratio(top: str, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(F.col(top).cast("double"), bottom), F.lit(0.0))


def class_metrics(df: DataFrame, n_classes: int = N_CLASSES) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where undefined."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    cells = confusion_counts(df)
    sides = F.array(
        F.struct(F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")),
    )
    sums = cells.select(F.inline(sides)).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("tp", "support", "predicted")]
    )
    classes = df.sparkSession.range(n_classes).select(F.col("id").cast("int").alias("class"))
    full = classes.join(sums, "class", "left").na.fill(0)
    scored = full.withColumn("precision", _ratio("tp", F.col("predicted"))).withColumn(
        "recall", _ratio("tp", F.col("support"))
    )
    both = F.col("precision") + F.col("recall")
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), both), F.lit(0.0))
    return scored.withColumn("f1", f1).select("class", "precision", "recall", "f1", "support")


def weighted_metrics(df: DataFrame, n_classes: int = N_CLASSES) -> DataFrame:
    """Accuracy and the support-weighted means of precision, recall and F1."""
    per_class = class_metrics(df, n_classes)
    total = F.sum("support")
    means = [
        F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), total), F.lit(0.0)).alias(c)
        for c in ("precision", "recall", "f1")
    ]
    # the share of right predictions equals the support-weighted recall
    return per_class.agg(*means).select(F.col("recall").alias("accuracy"), "precision", "recall", "f1")


def smoothed_loss(
    df: DataFrame,
    weights: DataFrame,
    smoothing: float = 0.1,
    batch_size: int = 64,
    seed: int = 42,
    row_id: str = "id",
) -> DataFrame:
    """Class-weighted, label-smoothed cross entropy: the plain mean of batch means.

    ``df`` has ``label`` and an array ``probability``; batches are consecutive runs
    of the seeded shuffle. ``weights`` has one row per class (``label, weight``).
    """
    rows = df.withColumn("_key", order_digest(seed, F.col(row_id))).withColumn("_all", F.lit(0))
    order = [F.col("_key"), F.col(row_id)]
    placed = ranked_positions(rows, ["_all"], order, digest_bucket(F.col("_key"), POSITION_DIGITS), "_pos")
    table = weights.groupBy().agg(
        F.map_from_entries(F.collect_list(F.struct("label", F.col("weight").cast("double")))).alias("_w")
    )
    lookup = table.scalar()  # one entry per class
    weighted = placed.withColumn("_w", lookup)
    logs = F.transform("probability", lambda p: -F.ln(p))
    own = F.coalesce(F.col("_w")[F.col("label")], F.lit(0.0))
    target = own * F.get(logs, F.col("label"))
    every = F.aggregate(
        F.transform(logs, lambda x, i: x * F.coalesce(F.col("_w")[i], F.lit(0.0))),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
    loss = (1 - smoothing) * target + F.lit(smoothing) / F.size("probability") * every
    batch = F.floor((F.col("_pos") - 1) / batch_size).alias("batch")
    batches = weighted.groupBy(batch).agg((F.sum(loss) / F.sum(own)).alias("loss"))
    return batches.agg(F.count("*").alias("n_batches"), F.avg("loss").alias("loss"))
