from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewloom.plans.job import add_review_id, data_job


def raw_file(spark, path, n: int, offset: int = 0) -> None:
    rows = spark.range(n).select(
        (F.col("id") % 5 + 1).cast("double").alias("rating"),
        F.concat(F.lit("a useful review number "), F.col("id") + offset).alias("text"),
        F.lit("B1").alias("asin"),
    )
    rows.toPandas().to_parquet(path)  # the other columns of the contract are absent


def test_ids_are_stable_and_unique(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("a", 2)] + [("c", 3)] * 40, "text string, x int")
    first, second = (add_review_id(rows.repartition(n)) for n in (1, 4))
    ids = sorted(r.review_id for r in first.collect())
    assert ids == sorted(r.review_id for r in second.collect()) and len(set(ids)) == 44


def test_from_raw_files_to_splits_again_and_again(spark, tmp_path):
    source, target = tmp_path / "raw", str(tmp_path / "out")
    source.mkdir()
    raw_file(spark, source / "Books.parquet", 200)
    raw_file(spark, source / "Toys.v2.parquet", 100, 1000)
    first = data_job(spark, str(source), target, frac=0.5)
    rows = sorted(map(tuple, first.splits.collect()), key=repr)
    assert len(rows) == 150 and {r.split for r in first.splits.collect()} == {"train", "val", "test"}
    assert {r.category for r in first.splits.collect()} == {"Books", "Toys.v2"}
    again = data_job(spark, str(source), target, frac=0.5)
    assert sorted(map(tuple, again.splits.collect()), key=repr) == rows
    assert again.ledger.count() == 2
    raw_file(spark, source / "Music.parquet", 60, 5000)
    more = data_job(spark, str(source), target, frac=0.5)
    assert more.splits.count() == 180 and more.ledger.count() == 3
    assert {r["name"]: r.n_rows for r in more.ledger.collect()} == {"Books.parquet": 200, "Toys.v2.parquet": 100, "Music.parquet": 60}


def test_an_empty_folder_is_an_error(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    with pytest.raises(Exception):
        data_job(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
