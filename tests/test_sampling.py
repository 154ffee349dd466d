from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reviewloom.operators import quality, ranks, sampling


def order(ids, seed=42):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


def frame(spark, sizes, name="category"):
    """Rows with consecutive ids; ``sizes`` maps a group to its number of rows."""
    rows, at = [], 0
    for group, n in sizes.items():
        rows += [(at + i, group) for i in range(n)]
        at += n
    return spark.createDataFrame(rows, f"review_id long, {name} {'double' if name == 'rating' else 'string'}")


def test_sample_is_exact_and_follows_the_digest(spark):
    df = frame(spark, {"hot": 700, "b": 50, "c": 7, "d": 1})
    got = sampling.sample_per_category(df, 0.1)
    sizes = Counter(r.category for r in got.collect())
    assert sizes == {"hot": 70, "b": 5, "c": 1}  # 0.7 rounds to 1, 0.1 to 0
    mine = sorted(r.review_id for r in got.where("category = 'hot'").collect())
    assert mine == sorted(order(range(700))[:70])


def test_sample_rounding(spark):
    df = frame(spark, {"a": 25, "b": 35})
    even = Counter(r.category for r in sampling.sample_per_category(df, 0.1).collect())
    down = Counter(r.category for r in sampling.sample_per_category(df, 0.1, rounding="floor").collect())
    assert even == {"a": 2, "b": 4} and down == {"a": 2, "b": 3}


def test_sample_reads_rows_without_shuffling_them(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    frame(spark, {"a": 200, "b": 100}).withColumn("payload", F.lit("x")).write.parquet(path)
    sampling.sample_per_category(spark.read.parquet(path), 0.1).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_split_of_nine_rows(spark):
    df = frame(spark, {4.0: 3, 5.0: 3, 3.0: 3}, "rating")
    out = sampling.stratified_split(df, test=0.2, val=0.2)
    counts = Counter(r.split for r in out.collect())
    assert sum(counts.values()) == 9 and set(counts) == {"train", "val", "test"}
    assert counts["test"] == 3  # at least three rows


def test_split_needs_three_rows_per_class(spark):
    with pytest.raises(sampling.TooFewRows, match="needs 3 rows"):
        sampling.stratified_split(frame(spark, {1.0: 10, 2.0: 2}, "rating"))
    with pytest.raises(sampling.TooFewRows, match="left to train"):
        sampling.stratified_split(frame(spark, {1.0: 6}, "rating"))
    with pytest.raises(sampling.TooFewRows, match="no rows"):
        sampling.stratified_split(frame(spark, {1.0: 3}, "rating").limit(0))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(3, 60), min_size=3, max_size=5), st.sampled_from([0.1, 0.2, 0.25]))
def test_split_is_a_partition_with_proportional_parts(spark, sizes, share):
    df = frame(spark, {float(i): n for i, n in enumerate(sizes)}, "rating")
    rows = sampling.stratified_split(df, share, share).collect()
    total = sum(sizes)
    assert len({r.review_id for r in rows}) == len(rows) == total
    n_test = math.ceil(max(share, 3 / total) * total)
    tests = Counter(r.rating for r in rows if r.split == "test")
    assert sum(tests.values()) == n_test
    for i, n in enumerate(sizes):
        assert abs(tests[float(i)] - n * n_test / total) < 1


def test_balanced_splits_unbalanced_input(spark):
    sizes = {"Positive": 1502, "Negative": 1001, "Neutral": 501}
    df = frame(spark, sizes, "sentiment")
    out = sampling.balanced_splits(df, per_class=2000, val=60, test=60)
    counts = Counter((r.split, r.sentiment) for r in out.collect())
    assert counts == {("train", k): n for k, n in sizes.items()}  # a short class never reaches val
    out = sampling.balanced_splits(df, per_class=500, val=60, test=90)
    counts = Counter((r.split, r.sentiment) for r in out.collect())
    assert counts[("train", "Neutral")] == 500 and counts[("val", "Neutral")] == 1 and ("test", "Neutral") not in counts
    assert counts[("val", "Positive")] == 20 and counts[("test", "Positive")] == 30
    text = out.withColumn("text", F.col("review_id").cast("string"))
    assert sampling.split_leakage(text).count() == 0


def test_balanced_splits_from_training_rows_only(spark):
    df = frame(spark, {"Positive": 40, "Negative": 40}, "sentiment").withColumn(
        "split", F.when(F.col("review_id") % 2 == 0, "train").otherwise("test")
    )
    out = sampling.balanced_splits(df, 10, 6, 6, source_splits=["train"]).collect()
    assert {r.source_split for r in out} == {"train"} and len(out) == 28


def test_shuffle_positions(spark):
    df = spark.range(300).select(F.col("id").alias("review_id"))
    out = sampling.deterministic_shuffle(df, seed=3).orderBy("position").collect()
    assert [r.review_id for r in out] == order(range(300), 3)
    assert [r.position for r in out] == list(range(1, 301))


def test_leakage(spark):
    rows = [("a", "train"), ("a", "train"), ("b", "train"), ("b", "test"), ("c", "val"), ("c", "test"), ("c", "train")]
    out = {r.text: r for r in sampling.split_leakage(spark.createDataFrame(rows, "text string, split string")).collect()}
    assert set(out) == {"b", "c"} and out["c"].n_rows == 3 and out["b"].in_val == 0


def test_locate_ranks_with_weights(spark):
    df = spark.createDataFrame([("g", float(v), n) for v, n in [(1, 5), (2, 1), (3, 90), (4, 4)]], "g string, v double, n long")

    def targets(sizes):
        assert sizes.first().n == 100
        return sizes.select("g", F.explode(F.array(*[F.lit(k) for k in (1, 5, 6, 7, 96, 97, 100)])).alias("k")).withColumn("cut", F.col("k"))

    out = ranks.locate_ranks(df, ["g"], ["v"], ranks.value_bucket(F.col("v"), 2.0), targets, F.col("n"))
    assert {r.cut: r.v for r in out.collect()} == {1: 1.0, 5: 1.0, 6: 2.0, 7: 3.0, 96: 3.0, 97: 4.0, 100: 4.0}


def test_sentiment_of_sampled_rows(spark):
    df = spark.createDataFrame([(r,) for r in (1.0, 2.0, 3.0, 4.0, 5.0, 0.0, 3.5)], "rating double")
    got = [r.sentiment for r in quality.sentiment_label(df).collect()]
    assert got == ["Negative", "Negative", "Neutral", "Positive", "Positive", None, None]


def test_rows_without_a_group_are_a_group(spark):
    rows = spark.range(200).selectExpr("id AS review_id", "IF(id % 10 = 0, NULL, id % 3) AS rating", "IF(id % 10 = 0, NULL, 'A') AS category")
    split = sampling.stratified_split(rows)
    assert split.count() == 200
    assert {r.split for r in split.where("rating IS NULL").collect()} == {"train", "val", "test"}
    assert sampling.sample_per_category(rows, 1.0).count() == 200
    assert sampling.sample_per_category(rows, 0.5).where("category IS NULL").count() == 10
