"""Exact-size samples, stratified and balanced splits, reproducible shuffles.

Every draw follows the order of a seeded digest of the row id. The cut points are
found first on two narrow columns; the full rows are then read once and kept or
labelled by comparing with the cut of their group, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.functions.hashing import order_digest
from reviewloom.staging import settle
from reviewloom.operators.ranks import (
    POSITION_DIGITS,
    digest_bucket,
    hash_cuts,
    hash_point,
    ranked_positions,
    whole_table,
    with_cuts,
)

SENTIMENTS = ["Negative", "Neutral", "Positive"]


def sample_per_category(
    df: DataFrame,
    frac: float = 0.03,
    seed: int = 42,
    row_id: str = "review_id",
    group: str = "category",
    rounding: str = "half_even",
) -> DataFrame:
    """A sample of exactly ``frac`` of each category.

    ``rounding="half_even"`` rounds the sample size to the nearest integer;
    ``"floor"`` cuts it off. Rows without a category are a category of their own.
    """
    size = {"half_even": F.bround, "floor": F.floor}[rounding](F.col("n") * F.lit(frac)).cast("bigint")

    def targets(sizes: DataFrame) -> DataFrame:
        return sizes.select(group, F.lit("sample").alias("cut"), size.alias("k"))

    cuts = hash_cuts(df, [group], seed, row_id, targets)
    return (
        with_cuts(df, cuts, [group])
        .where(hash_point(seed, row_id) <= F.col("cuts")["sample"])
        .drop("cuts")
        .select(df.columns)
    )


class TooFewRows(ValueError):
    """A split was asked of a table that cannot be divided."""


def class_minimum(df: DataFrame, label: str = "rating", minimum: int = 3) -> DataFrame:
    """One row: number of classes, size of the smallest, and whether it suffices."""
    return _smallest(df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")), minimum)


def _smallest(sizes: DataFrame, minimum: int) -> DataFrame:
    return sizes.agg(
        F.count("*").alias("n_classes"), F.coalesce(F.min("n"), F.lit(0)).alias("smallest")
    ).withColumn("enough", F.col("smallest") >= minimum)


def check_min_class(df: DataFrame, label: str = "rating", minimum: int = 3) -> DataFrame:
    """Return ``df``, or raise when it is empty or its smallest class is too small."""
    _raise_if_few(class_minimum(df, label, minimum).first(), label, minimum)
    return df


def _raise_if_few(row, label: str, minimum: int) -> None:
    if row["n_classes"] == 0:
        raise TooFewRows("the input has no rows")
    if not row["enough"]:
        raise TooFewRows(f"each {label} class needs {minimum} rows, the smallest has {row['smallest']}")


def _largest_remainder(strata: DataFrame, label: str, size: str, total: Column, out: str) -> DataFrame:
    """Share ``total`` draws over strata in proportion to the column ``size``.

    ``strata`` has one row per class. Left-over draws go to the largest
    fractions, ties to the smaller class label.
    """
    exact = F.coalesce(F.try_divide(F.col(size) * F.col("_total"), F.col("_all")), F.lit(0.0))
    everything = whole_table()
    base = (
        strata.withColumn("_all", F.sum(size).over(everything))
        .withColumn("_total", total)
        .withColumn("_floor", F.floor(exact))
        .withColumn("_rest", exact - F.col("_floor"))
        .withColumn("_spare", F.col("_total") - F.sum("_floor").over(everything))
        .withColumn("_rank", F.row_number().over(everything.orderBy(F.desc("_rest"), F.col(label).asc_nulls_last())))
    )
    extra = F.when(F.col("_rank") <= F.col("_spare"), 1).otherwise(0)
    return base.withColumn(out, (F.col("_floor") + extra).cast("bigint")).drop(
        "_all", "_total", "_floor", "_rest", "_spare", "_rank"
    )


def split_quotas(sizes: DataFrame, label: str, test: float, val: float) -> DataFrame:
    """Rows per class for the test and validation parts: ``label, n, n_test, n_val``.

    Each part gets at least three rows overall. The test part is drawn first; the
    validation part is its share of what is left.
    """
    rows = F.col("_rows")
    at_least = F.lit(3.0) / rows
    test_share = F.greatest(F.lit(float(test)), at_least)
    val_share = F.try_divide(F.greatest(F.lit(float(val)), at_least), F.lit(1.0) - test_share)
    sized = sizes.withColumn("_rows", F.sum("n").over(whole_table()))
    with_test = _largest_remainder(sized, label, "n", F.ceil(test_share * rows), "n_test")
    left = with_test.withColumn("_left", F.col("n") - F.col("n_test"))
    n_val = F.ceil(val_share * F.sum("_left").over(whole_table()))
    return _largest_remainder(left, label, "_left", n_val, "n_val").select(label, "n", "n_test", "n_val")


def stratified_split(
    df: DataFrame,
    test: float = 0.1,
    val: float = 0.1,
    seed: int = 42,
    label: str = "rating",
    row_id: str = "review_id",
    check: bool = True,
) -> DataFrame:
    """Add ``split`` (train, val or test) so that each part keeps the class mix.

    Rows without a label are a class of their own, which counts like the others.
    """

    def targets(sizes: DataFrame) -> DataFrame:
        quotas = split_quotas(sizes, label, test, val)
        if check:
            _raise_if_few(_smallest(sizes, 3).first(), label, 3)
            if quotas.agg(F.sum(F.col("n") - F.col("n_test") - F.coalesce("n_val", "n"))).first()[0] <= 0:
                raise TooFewRows("no rows would be left to train on")
        cut = F.explode(
            F.create_map(
                F.lit("test"), F.col("n_test"), F.lit("val"), F.col("n_test") + F.col("n_val")
            )
        ).alias("cut", "k")
        return quotas.select(label, cut)

    cuts = hash_cuts(df, [label], seed, row_id, targets)
    point, edge = hash_point(seed, row_id), F.col("cuts")
    part = (
        F.when(point <= edge["test"], "test").when(point <= edge["val"], "val").otherwise("train")
    )
    kept = [c for c in df.columns if c != "split"]
    return with_cuts(df.drop("split"), cuts, [label], "left").withColumn("split", part).select(*kept, "split")


def balanced_splits(
    df: DataFrame,
    per_class: int = 200_000,
    val: int = 50_000,
    test: int = 50_000,
    seed: int = 42,
    label: str = "sentiment",
    row_id: str = "review_id",
    source_splits: list[str] | None = None,
) -> DataFrame:
    """Equal class sizes: per class the first ``per_class`` shuffled rows train, the
    next ``val // 3`` validate, the next ``test // 3`` test; further rows are left out.

    A class with too few rows fills the training part first. ``source_splits``
    limits the rows drawn from to some of the existing splits (default: all). The
    result's ``split`` is the new part; the old one stays in ``source_split``.
    """
    pool = df.where(F.col(label).isin(SENTIMENTS))
    if "split" in df.columns:
        if source_splits is not None:
            pool = pool.where(F.col("split").isin(source_splits))
        pool = pool.withColumnRenamed("split", "source_split")
    ends = {"train": per_class, "val": per_class + val // 3, "test": per_class + val // 3 + test // 3}

    def targets(sizes: DataFrame) -> DataFrame:
        pairs = [x for name, k in ends.items() for x in (F.lit(name), F.least(F.lit(k), F.col("n")))]
        return sizes.select(label, F.explode(F.create_map(*pairs)).alias("cut", "k"))

    cuts = hash_cuts(pool, [label], seed, row_id, targets)
    point, edge = hash_point(seed, row_id), F.col("cuts")
    part = F.when(point <= edge["train"], "train").when(point <= edge["val"], "val").when(
        point <= edge["test"], "test"
    )
    labelled = with_cuts(pool, cuts, [label]).withColumn("split", part).where(F.col("split").isNotNull())
    return labelled.select(*pool.columns, "split")


def shuffle_key(df: DataFrame, seed: int = 42, row_id: str = "review_id") -> DataFrame:
    """Add ``shuffle_key``; sorting by it (then by id) is a reproducible shuffle."""
    return df.withColumn("shuffle_key", order_digest(seed, F.col(row_id)))


def deterministic_shuffle(df: DataFrame, seed: int = 42, row_id: str = "review_id") -> DataFrame:
    """Add ``shuffle_key`` and ``position``, the row number (from 1) in shuffled order."""
    keyed = shuffle_key(df, seed, row_id).withColumn("_all", F.lit(0))
    bucket = digest_bucket(F.col("shuffle_key"), POSITION_DIGITS)
    order = [F.col("shuffle_key"), F.col(row_id)]
    return ranked_positions(keyed, ["_all"], order, bucket).drop("_all")


def split_leakage(
    df: DataFrame, text: str = "text", split: str = "split", parts=("train", "val", "test")
) -> DataFrame:
    """Texts present in more than one split, with a flag per split and their row count.

    Hashes are compared first, so that only texts whose hash occurs in several splits
    travel; those are then compared as they are.
    """
    flags = [F.max(F.when(F.col(split) == p, 1).otherwise(0)).alias(f"in_{p}") for p in parts]
    several = sum((F.col(f"in_{p}") for p in parts), F.lit(0)) > 1
    hashed = df.withColumn("_hash", F.xxhash64(text))
    suspects = settle(hashed.groupBy("_hash").agg(*flags).where(several).select("_hash"), "suspects")
    seen = hashed.join(suspects, "_hash", "left_semi").groupBy(text).agg(*flags, F.count("*").alias("n_rows"))
    return seen.where(several)
