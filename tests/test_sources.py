from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from reviewloom import staging
from reviewloom.contracts import RAW_REVIEW
from reviewloom.sources import examples, ledger, reviews, sinks
from reviewloom.streaming import ingest_new_files


def raw(spark, n, rating=4.0, text="fine item"):
    rows = [(rating, f"t{i}", text, None, f"A{i}", None, "u", 0, i, True) for i in range(n)]
    return spark.createDataFrame(rows, RAW_REVIEW)


def test_scan_and_ingest_a_folder(spark, tmp_path):
    folder = str(tmp_path / "raw")
    for name, n in (("Books", 5), ("Music", 3)):
        raw(spark, n).coalesce(1).toPandas().to_parquet(tmp_path / f"{name}.parquet")
    folder = str(tmp_path)
    rows = reviews.ingest_category(reviews.scan_reviews(spark, folder), reviews.category_of_file())
    assert rows.columns == ["text", "rating", "asin", "title", "helpful_vote", "category"]
    totals = [(r.category, r.n_reviews, r.running_total) for r in reviews.ingest_totals(rows).orderBy("category").collect()]
    assert totals == [("Books", 5, 5), ("Music", 3, 8)]
    report = {r.file_name: r.n_rows for r in reviews.file_row_report(spark, folder).collect()}
    assert report == {"Books.parquet": 5, "Music.parquet": 3}
    named = reviews.scan_reviews(spark, folder, splits=["Books", "Music"])
    assert {r.split: r["count"] for r in named.groupBy("split").count().collect()} == {"Books": 5, "Music": 3}


def test_columns_the_source_lacks_are_dropped(spark):
    out = reviews.ingest_category(raw(spark, 2).drop("title"), "Books", ["text", "title", "rating"])
    assert out.columns == ["text", "rating", "category"] and out.first().category == "Books"


def test_scan_reads_only_the_columns_asked_for(spark, tmp_path, capsys):
    raw(spark, 3).write.parquet(str(tmp_path / "t"))
    df = reviews.scan_reviews(spark, str(tmp_path / "t")).where("rating >= 3").select("asin")
    df.explain()
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<rating:double,asin:string>" in plan and "GreaterThanOrEqual(rating,3.0)" in plan


def test_list_categories(spark):
    df = spark.createDataFrame([("raw_review_Books",), ("raw_meta_Books",), ("raw_review_raw_review_x",)], "config_name string")
    assert sorted(r.category for r in reviews.list_categories(df).collect()) == ["Books", "x"]


def test_ledger_round_trip(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert ledger.ledger_summary(ledger.read_ledger(spark, path)).first().total_rows == 0
    first = spark.createDataFrame([("a.parquet", 400), ("b.parquet", 600)], "name string, n_rows long")
    ledger.record_progress(spark, path, first)
    book = ledger.record_progress(spark, path, first.unionByName(spark.createDataFrame([("c.parquet", 1)], first.schema)))
    row = ledger.ledger_summary(book).first()
    assert (row.n_completed, row.total_rows) == (3, 1001) and row.last_updated is not None
    every = spark.createDataFrame([("a.parquet",), ("d.parquet",)], "name string")
    assert [r.name for r in ledger.pending_files(every, book).collect()] == ["d.parquet"]


def test_reconcile(spark):
    def names(*values):
        return spark.createDataFrame([(v,) for v in values], "category string")

    state = ledger.reconcile_categories(names("a", "b", "c"), names("a", "x"), names("b"), names("a"))
    out = {r.category: (r.remaining, r.local_only, r.unlisted) for r in state.collect()}
    assert out == {"a": (False, False, False), "b": (True, True, False), "c": (True, False, False), "x": (False, False, True)}
    assert ledger.reconcile_counts(state).first().n_remaining == 2


def test_publish_replaces_good_categories_only(spark, tmp_path):
    target = str(tmp_path / "published")

    def batch(rows):
        return spark.createDataFrame(rows, "text string, rating double, category string")

    sinks.publish_validated(batch([("old", 1.0, "A"), ("old", 1.0, "B")]), target)
    report = sinks.publish_validated(batch([("new", 2.0, "A"), ("", 2.0, "B"), ("more", 3.0, "C")]), target)
    assert {r.category: r.published for r in report.collect()} == {"A": True, "B": False, "C": True}
    stored = {r.category: r.text for r in spark.read.parquet(target).collect()}
    assert stored == {"A": "new", "B": "old", "C": "more"}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "b", "y")], "id long, category string, split string")
    back = sinks.write_table(rows, str(tmp_path / "t"), ["split", "category"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    metrics = spark.createDataFrame([(0.5, None)], "silhouette double, other double")
    for fmt in ("csv", "json"):
        assert tuple(sinks.write_metrics(metrics, str(tmp_path / fmt), fmt).first()) == (0.5, None)
    articles = spark.createDataFrame([(0, "one\ntwo"), (1, "three\n")], "meta_category int, article string")
    out = {r.meta_category: r.article for r in sinks.write_articles(articles, str(tmp_path / "articles")).collect()}
    assert out == {0: "one\ntwo", 1: "three\n"}


def test_examples_from_json(spark, tmp_path):
    path = tmp_path / "examples.json"
    path.write_text("\n".join(json.dumps({"meta_category": i, "output": "o"}) for i in range(3)))
    assert examples.training_examples(spark, str(path)).count() == 3


def test_stream_ingest_reads_each_file_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    raw(spark, 4).toPandas().to_parquet(tmp_path / "in" / "Books.parquet")
    ingest_new_files(spark, source, target, state).awaitTermination()
    raw(spark, 2).toPandas().to_parquet(tmp_path / "in" / "Music.parquet")
    raw(spark, 2, rating=9.0).toPandas().to_parquet(tmp_path / "in" / "Toys.parquet")
    for _ in range(2):
        ingest_new_files(spark, source, target, state).awaitTermination()
    counts = {r.category: r["count"] for r in spark.read.parquet(target).groupBy("category").count().collect()}
    assert counts == {"Books": 4, "Music": 2}


def test_shared_folder_comes_from_the_session(spark):
    folder = staging.shared_folder(spark)
    wanted = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert folder == (wanted.rstrip("/") if wanted else staging.shared_folder(spark))
    df = spark.range(3).withColumn("x", F.lit("a"))
    out = staging.settle(df, "demo")
    assert out.schema["x"].dataType == df.schema["x"].dataType and out.count() == 3
    assert all(folder in name for name in out.inputFiles())
    assert staging.fresh_path(spark, "a") != staging.fresh_path(spark, "a")


def test_without_the_setting_the_warehouse_is_the_folder(spark, monkeypatch):
    monkeypatch.setattr(staging, "_KEY", "spark.reviewloom.not.set")
    assert staging.shared_folder(spark) == spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    assert staging.settle(spark.range(2), "demo").count() == 2


def test_a_cluster_without_the_setting_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(staging, "_KEY", "spark.reviewloom.not.set")
    monkeypatch.setattr(staging, "_WAREHOUSE", "spark.reviewloom.not.set.either")

    class Context:
        master = "yarn"

        def getConf(self):
            return spark.sparkContext.getConf()

    class Session:
        conf, sparkContext = spark.conf, Context()

    with pytest.raises(ValueError, match="shared by all executors"):
        staging.shared_folder(Session())


def test_overwriting_leaves_nothing_of_the_old_table(spark, tmp_path, monkeypatch):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rows = spark.createDataFrame([(1, "A"), (2, "B")], "x int, category string")
        path = str(tmp_path / "table")
        sinks.write_table(rows, path, ["category"])
        assert [r.x for r in sinks.write_table(rows.where("x = 1"), path, ["category"]).collect()] == [1]
        articles = spark.createDataFrame([(0, "a"), (1, "b")], "meta_category int, article string")
        path = str(tmp_path / "articles")
        sinks.write_articles(articles, path)
        assert [r.article for r in sinks.write_articles(articles.where("meta_category = 1"), path).collect()] == ["b"]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_rows_without_a_category_are_not_published(spark, tmp_path):
    rows = spark.createDataFrame([("t", 1.0, "A"), ("u", 1.0, None), ("v", 1.0, "")], "text string, rating double, category string")
    report = sinks.publish_validated(rows, str(tmp_path / "out")).collect()
    assert {(r.category, r.n_rows, r.published) for r in report} == {("A", 1, True), (None, 2, False)}
    assert [r.category for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["A"]


def test_streams_with_their_own_checkpoints_share_a_target(spark, tmp_path):
    for name in ("first", "second"):
        (tmp_path / name).mkdir()
        raw(spark, 3).toPandas().to_parquet(tmp_path / name / "Books.v2.parquet")
        ingest_new_files(spark, str(tmp_path / name), str(tmp_path / "out"), str(tmp_path / f"state-{name}")).awaitTermination()
    counts = spark.read.parquet(str(tmp_path / "out")).groupBy("category").count().collect()
    assert [(r.category, r["count"]) for r in counts] == [("Books.v2", 6)]


def test_split_files_keep_their_columns(spark, tmp_path):
    rows = spark.createDataFrame([("t", "p", 1.0, "A", "Positive")], "text string, processed_text string, rating double, category string, sentiment string")
    for name in ("train", "val"):
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    got = reviews.scan_reviews(spark, str(tmp_path), splits=["train", "val"])
    assert set(got.columns) == {*rows.columns, "split"} and got.where("sentiment = 'Positive'").count() == 2


def test_release_leaves_nothing_behind(spark):
    import os

    from reviewloom.session import get_session

    path = staging.settle(spark.range(3), "demo").inputFiles()[0].removeprefix("file:")
    other = get_session()
    assert other is spark and os.path.exists(path.replace("//", "", 1) if path.startswith("///") else path)
    folder = staging._application_folder(spark).removeprefix("file://").removeprefix("file:")
    kept = os.listdir(folder)
    assert any(name.startswith("demo-") for name in kept)
