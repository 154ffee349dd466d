from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import joins, ranking, stats
from reviewloom.plans import digest
from reviewloom.sources import examples


def test_product_stats_skip_null_ratings_and_votes(spark):
    rows = [("A", 5.0, None, "x"), ("A", None, None, "x"), ("B", 1.0, 3, None), ("B", 3.0, None, "y"), (None, 1.0, 1, "x")]
    df = spark.createDataFrame(rows, "asin string, rating double, helpful_vote long, category string")
    out = {r.asin: tuple(r) for r in stats.product_stats(df).collect()}
    assert out == {"A": ("A", 2, 1, 5.0, 0, "x"), "B": ("B", 2, 2, 2.0, 3, "y")}


def test_ties(spark):
    rows = [(0, "p3", 12, 4.0, 7), (0, "p1", 12, 4.0, 7), (0, "p2", 15, 4.0, 9), (0, "p4", 11, 2.0, 1), (0, "p5", 11, 2.0, 8)]
    df = spark.createDataFrame(rows, "meta_category int, asin string, n_rated long, mean_rating double, helpful_votes long")
    assert [r.asin for r in ranking.top_products(df).orderBy("rank").collect()] == ["p2", "p1", "p3"]
    assert [r.asin for r in ranking.worst_product(df).collect()] == ["p5"]
    assert [r.asin for r in ranking.most_reviewed_products(df, 2).orderBy("rank").collect()] == ["p2", "p1"]


def test_main_subcategory_avoids_the_unknown(spark):
    rows = [(0, "[UNKNOWN]", 9), (0, "b", 5), (0, "a", 5), (1, "[UNKNOWN]", 3), (2, "z", 8), (2, "[UNKNOWN]", 1)]
    df = spark.createDataFrame(rows, "meta_category int, category string, n_reviews long")
    got = {r.meta_category: r.category for r in ranking.main_subcategory(df).collect()}
    assert got == {0: "a", 1: "[UNKNOWN]", 2: "z"}
    with pytest.raises(Exception, match="no named category in meta-category 1"):
        ranking.main_subcategory(df, strict=True).collect()


def test_samples(spark):
    rows = [(0, "A", 5.0, 3, "r1"), (0, "A", 1.0, None, "r2"), (0, "A", 1.0, 9, "r3"), (0, "A", 4.0, 9, "r4"), (0, "A", None, 99, "r5")]
    df = spark.createDataFrame(rows, "meta_category int, asin string, rating double, helpful_vote long, review_id string")
    assert [r.review_id for r in ranking.helpful_samples(df, 3).orderBy("sample_rank").collect()] == ["r5", "r3", "r4"]
    assert [r.review_id for r in ranking.negative_samples(df, 3).orderBy("sample_rank").collect()] == ["r3", "r2", "r4"]


def test_top_k_limits_groups_before_the_shuffle(ranked, capsys):
    ranking.helpful_samples(ranked).explain()
    assert capsys.readouterr().out.count("WindowGroupLimit") == 2


EXPECTED = """
TOP RATED PRODUCTS:

Product: Product B001
Average Rating: 5.0/5
Total Reviews: 10
Sample Reviews:
B001 review 0
B001 review 1

Product: Product B002
Average Rating: 1.0/5
Total Reviews: 10
Sample Reviews:
B002 review 0
B002 review 1

WORST RATED PRODUCT WARNING:

Product: Product B002
Average Rating: 1.0/5
Total Reviews: 10
Sample Negative Reviews:
B002 review 0
B002 review 1"""


def test_review_digest(spark, ranked):
    out = {r.meta_category: r for r in digest.review_digest(ranked).collect()}
    assert out[0].review_data == EXPECTED
    assert (out[0].category, out[0].n_qualified) == ("Electronics", 2)
    assert (out[1].category, out[1].n_qualified) == ("Books", 0)
    assert out[1].review_data == "\nTOP RATED PRODUCTS:\n\nWORST RATED PRODUCT WARNING:"
    names = spark.createDataFrame([("B001", "Good Phone")], "asin string, name string")
    named = digest.review_digest(ranked, product_names=names).where("meta_category = 0").first()
    assert "Product: Good Phone\n" in named.review_data and "Product: Product B002\n" in named.review_data


def test_review_digest_of_one_hot_meta_category(spark):
    df = spark.range(20_000).select(
        F.lit(0).alias("meta_category"),
        F.lit("only").alias("category"),
        F.concat(F.lit("p"), F.col("id") % 100).alias("asin"),
        (F.col("id") % 100 / 25 + 1).alias("rating"),
        F.col("id").alias("helpful_vote"),
        F.concat(F.lit("t"), "id").alias("text"),
        F.col("id").cast("string").alias("review_id"),
    )
    (row,) = digest.review_digest(df, min_reviews=200).collect()
    assert row.n_qualified == 100
    assert [line for line in row.review_data.split("\n") if line.startswith("Product")] == [
        "Product: Product p99", "Product: Product p98", "Product: Product p97", "Product: Product p0"
    ]
    assert "t19999\nt19899" in row.review_data and row.review_data.endswith("t19900\nt19800")


def test_popular_digest(ranked):
    out = {r.meta_category: r for r in digest.review_digest_popular(ranked).collect()}
    assert out[1].review_data == (
        "\nProduct: Product B003\nCategory: Books\nTotal Reviews: 5\nAverage Rating: 3.0/5\nSample Reviews:\n"
        "B003 review 0\nB003 review 1\nB003 review 2"
    )


def test_prompt_and_generation(ranked):
    prompts = digest.prompt_table(digest.review_digest(ranked))
    row = prompts.where("meta_category = 0").first()
    assert row.meta_name == "Entertainment & General Retail" and EXPECTED in row.prompt and "{" not in row.prompt
    articles = {r.meta_category: r.article for r in digest.article_generation(prompts).collect()}
    assert set(articles) == {0, 1} and "Product: Product B002" in articles[0]
    assert list(digest.article_generation(prompts, only=[1]).toPandas()["meta_category"]) == [1]
    with pytest.raises(digest.UnknownMetaCategory):
        digest.article_generation(prompts, only=[99])
    with pytest.raises(digest.ModelMissing):
        digest.article_generation(prompts, generator=None)


def test_template_values_are_not_expanded_again(spark):
    df = spark.createDataFrame([("{b}", "x{a}")], "a string, b string")
    out = df.select(digest.fill_template("1 {a} 2 {b}{a} {c}", {"a": F.col("a"), "b": F.col("b")})).first()[0]
    assert out == "1 {b} 2 x{a}{b} {c}"


def test_training_text(spark, ranked):
    prompts = digest.prompt_table(digest.review_digest(ranked))
    out = joins.training_text(examples.training_examples(spark), prompts).collect()
    assert len(out) == 8 and all(r.text.endswith("</s>") for r in out)
    with pytest.raises(joins.NoTrainingText):
        joins.training_text(examples.training_examples(spark), prompts.limit(0), check=True)


def test_examples_cover_the_meta_categories(spark):
    rows = examples.example_rows()
    assert [sum(m == i for m, _ in rows) for i in range(5)] == [4, 4, 4, 4, 5]
    assert len({text for _, text in rows}) == 21


def test_product_name_cache(spark, ranked):
    cache = spark.createDataFrame([("B001", "old"), ("B002", "kept")], "asin string, name string")
    assert [r.asin for r in joins.missing_product_names(ranked, cache).collect()] == ["B003"]
    fresh = spark.createDataFrame([("B001", "new"), ("B003", None)], "asin string, name string")
    merged = {r.asin: r.name for r in joins.merge_product_names(cache, fresh).collect()}
    assert merged == {"B001": "new", "B002": "kept", "B003": "Product B003"}


def test_lookup_and_union(spark, ranked):
    labels = spark.createDataFrame([("Electronics", 4)], "category string, cluster int")
    got = {r.category: r.meta_category for r in joins.assign_meta_category(ranked, labels).collect()}
    assert got == {"Electronics": 4, "Books": None}
    parts = joins.union_splits({"train": ranked, "test": ranked.drop("text")})
    assert parts.count() == 50 and parts.where("split = 'test' and text is null").count() == 25
    few = spark.createDataFrame([(0, "B001")], "meta_category int, asin string")
    assert joins.reviews_of_selected(ranked, few).count() == 10


def test_profile_and_counts(ranked):
    assert tuple(stats.corpus_profile(ranked).first()) == (25, 3, 2)
    counts = {r.meta_category: (r.n_reviews, r.size_rank) for r in stats.meta_category_counts(ranked).collect()}
    assert counts == {0: (20, 1), 1: (5, 2)}
    assert sorted(r.meta_category for r in stats.meta_category_ids(ranked).collect()) == [0, 1]
    exact = {r.meta_category: r.n_products for r in stats.products_per_cluster(ranked).collect()}
    rough = {r.meta_category: r.n_products for r in stats.products_per_cluster(ranked, approx=True).collect()}
    assert exact == rough == {0: 2, 1: 1}
