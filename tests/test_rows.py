from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewloom import contracts
from reviewloom.operators import quality, stats
from reviewloom.plans.prepare import clean_split, prepare


def reviews(spark, rows):
    return spark.createDataFrame(
        rows, "review_id long, text string, rating double, category string, split string"
    )


def ids(df):
    return sorted(r.review_id for r in df.select("review_id").collect())


@pytest.fixture(scope="module")
def mixed(spark):
    return reviews(
        spark,
        [
            (1, "good product here", 5.0, "A", "train"),
            (2, "good product here", 5.0, "A", "train"),
            (3, "good product here", 5.0, "A", "test"),
            (4, None, 4.0, "A", "train"),
            (5, "", 4.0, "A", "train"),
            (6, "abcd", 4.0, "A", "val"),
            (7, "no stars at all", 0.0, "Unknown", "train"),
            (8, "no stars at all", 0.0, "Unknown", "test"),
            (9, "half a star off", 4.5, "B", "train"),
            (10, "<i></i><br>", 3.0, "B", "train"),
            (11, "six stars given", 6.0, "B", "train"),
        ],
    )


def test_valid_reviews(mixed):
    assert ids(quality.valid_reviews(mixed)) == [1, 2, 3, 6, 9, 10]


def test_clean_raw_keeps_unrated_rows_outside_training(mixed):
    assert ids(quality.clean_raw(mixed)) == [1, 2, 3, 8, 9, 10, 11]


def test_clean_split(mixed):
    out = {r.review_id: r for r in clean_split(mixed).collect()}
    assert sorted(out) == [1, 3, 8, 9, 11]  # copies go inside a split only, bare markup goes
    assert out[8].category == "[UNKNOWN]"
    assert [out[i].sentiment for i in (1, 8, 9, 11)] == ["Positive", None, None, None]


def test_dedup_keeps_first_of_a_hot_group(spark):
    rows = [(i, "same text", 5.0, "A", "train") for i in range(500)] + [(1000 + i, f"t{i}", 1.0, "A", "train") for i in range(50)]
    out = quality.dedup_reviews(reviews(spark, rows).repartition(7))
    assert ids(out) == [0] + list(range(1000, 1050))


def test_dedup_limits_copies_before_the_shuffle(mixed, capsys):
    quality.dedup_reviews(mixed).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_encode_label(spark):
    df = spark.createDataFrame([("Negative",), ("Neutral",), ("Positive",), ("Odd",), (None,)], "sentiment string")
    assert [r.label for r in quality.encode_label(df).collect()] == [0, 1, 2, None, None]
    with pytest.raises(Exception, match="unknown sentiment: Odd"):
        quality.encode_label(df.where("sentiment = 'Odd'"), strict=True).collect()


def test_check_integrity(spark, mixed):
    good = reviews(spark, [(1, "Great product!", 5.0, "A", "x"), (2, "Nice item", 4.0, "A", "x")])
    assert quality.check_integrity(good).first().ok
    assert not quality.check_integrity(good.limit(0)).first().ok
    assert not quality.check_integrity(good.drop("rating")).first().ok
    row = quality.check_integrity(mixed).first()
    assert (row.n_rows, row.n_bad_text, row.ok) == (11, 2, False)
    assert quality.check_integrity(mixed.drop("category"), "rowcount").first().ok


def test_preprocess_keeps_existing_text_and_min_words(spark):
    df = reviews(spark, [(1, "<b>One</b> two three", 5.0, "A", "x"), (2, "one two", 5.0, "A", "x")])
    out = quality.preprocess_dataset(df).collect()
    assert [(r.review_id, r.processed_text) for r in out] == [(1, "one two three")]
    given = df.withColumn("processed_text", F.lit("a b c"))
    assert quality.preprocess_dataset(given).count() == 2


def test_preprocess_computes_the_text_once(spark, capsys):
    df = reviews(spark, [(1, "one two three", 5.0, "A", "x")])
    quality.preprocess_dataset(df).explain()
    assert capsys.readouterr().out.count("lower(") == 1


def test_prepare_normalized_splits_everything(spark):
    rows = [(i, f"review number {'abc'[i % 3]} text", float(1 + i % 5), "AB"[i % 2], None) for i in range(100)]
    out = prepare(reviews(spark, rows).drop("split"), "normalized", frac=None)
    assert {r.split: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 80, "val": 10, "test": 10}
    report = quality.verify_splits(out).collect()
    assert all(r.ok for r in report) and abs(sum(r.share for r in report) - 1) < 1e-12


def test_removal_report(mixed):
    out = {r.split: r for r in stats.removal_report(mixed, clean_split(mixed)).collect()}
    assert (out["train"].n_before, out["train"].n_after, out["train"].n_removed) == (8, 3, 5)
    assert out["train"].pct_removed == pytest.approx(62.5)


def test_required_columns(spark, ranked):
    assert contracts.require_columns(ranked, ["asin"]) is ranked
    with pytest.raises(contracts.MissingColumns, match="nope"):
        contracts.require_columns(ranked, ["asin", "nope"], "train")


def test_missing_column_report(spark, ranked):
    out = contracts.missing_column_report(spark, {"reviews": ranked, "none": ranked.select("asin")}, ["asin", "text", "nope"])
    assert sorted(map(tuple, out.collect())) == [("none", 2, "nope,text"), ("reviews", 1, "nope")]
