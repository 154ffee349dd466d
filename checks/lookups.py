"""Joins, lookups and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import NAMES, POINTS, PRODUCTS, rank, text, written
from checks.ingest import _EXAMPLES
from checks.ranking import DIGEST, DIGEST_OUT, PROMPT, digests
from reviewloom.functions import extract_products
from reviewloom.operators import joins
from reviewloom.plans import digest
from reviewloom.sources import adapters, examples


def _documents_as_members(spark, sf):
    """Documents whose category is the vector their id falls on."""
    n = adapters.table(spark, sf, "embeddings").count()
    key = F.concat(F.lit("cat"), F.lpad((F.col("doc_id") % (2 * n)).cast("string"), 9, "0"))
    return adapters.table(spark, sf, "documents").select(F.col("doc_id").alias("review_id"), key.alias("category"))


def assign_meta_category(spark, sf):
    return joins.assign_meta_category(_documents_as_members(spark, sf), adapters.category_points(spark, sf))


def name_meta_category(spark, sf):
    points = adapters.category_points(spark, sf).select("category", F.col("cluster").alias("meta_category"))
    return joins.name_meta_category(points)


def reviews_of_selected(spark, sf):
    parts = adapters.table(spark, sf, "part").where(F.col("p_retailprice") > 905)
    selected = parts.select((F.col("p_size") % 5).alias("meta_category"), F.col("p_partkey").alias("asin"))
    return joins.reviews_of_selected(adapters.ranked_reviews(spark, sf), selected).select("review_id", "meta_category", "asin")


def _cache(spark, sf):
    parts = adapters.table(spark, sf, "part").where(F.col("p_brand") < "Brand#2")
    return parts.select(F.col("p_partkey").alias("asin"), F.col("p_name").alias("name"))


def missing_product_names(spark, sf):
    return joins.missing_product_names(adapters.ranked_reviews(spark, sf), _cache(spark, sf))


def merge_product_names(spark, sf):
    parts = adapters.table(spark, sf, "part")
    name = F.when(F.col("p_size") > 10, F.concat(F.lit("new "), F.col("p_name")))
    resolved = parts.where(F.col("p_brand") > "Brand#15").select(F.col("p_partkey").alias("asin"), name.alias("name"))
    return joins.merge_product_names(_cache(spark, sf), resolved)


def training_text(spark, sf):
    prompts = digest.prompt_table(digests(spark, sf))
    return joins.training_text(examples.training_examples(spark), prompts, check=True)


def union_splits(spark, sf):
    rows = adapters.text_reviews(spark, sf)
    parts = {name: rows.where(F.col("split") == name).drop("split") for name in ("train", "val")}
    parts["test"] = rows.where(F.col("split") == "test").drop("split", "helpful_vote")
    return joins.union_splits(parts).select("review_id", "split", "helpful_vote")


def product_overlap(spark, sf):
    articles = adapters.articles(spark, sf)
    sets = articles.select(
        "article_id", extract_products(F.col("generated")).alias("generated"), extract_products(F.col("source")).alias("source")
    )
    out = joins.product_overlap(sets)
    return out.select("article_id", *[F.size(c).cast("bigint").alias(c) for c in ("shared", "only_generated", "only_source")])


_CACHE = "cache AS (SELECT p_partkey AS asin, p_name AS name FROM part WHERE p_brand < 'Brand#2')"

CASES = {
    "assign_meta_category": (
        assign_meta_category,
        f"""WITH {POINTS}, docs AS (SELECT doc_id AS review_id,
  'cat' || lpad((doc_id % (2 * (SELECT count(*) FROM embeddings)))::VARCHAR, 9, '0') AS category FROM documents)
SELECT category, review_id, cluster AS meta_category FROM docs LEFT JOIN points USING (category)""",
    ),
    "name_meta_category": (
        name_meta_category,
        f"WITH {POINTS}, {NAMES} SELECT category, cluster AS meta_category, coalesce(name, 'cluster ' || cluster) AS meta_name"
        " FROM points LEFT JOIN names ON cluster = meta_category",
    ),
    "reviews_of_selected": (
        reviews_of_selected,
        rank(
            "SELECT review_id, meta_category, asin FROM reviews WHERE EXISTS (SELECT 1 FROM part"
            " WHERE p_retailprice > 905 AND p_size % 5 = meta_category AND p_partkey = asin)"
        ),
    ),
    "missing_product_names": (
        missing_product_names,
        rank("SELECT DISTINCT asin FROM reviews WHERE asin NOT IN (SELECT asin FROM cache)", _CACHE),
    ),
    "merge_product_names": (
        merge_product_names,
        f"""WITH {_CACHE}, fresh AS (SELECT p_partkey AS asin,
  CASE WHEN p_size > 10 THEN 'new ' || p_name ELSE 'Product ' || p_partkey END AS name FROM part WHERE p_brand > 'Brand#15')
SELECT asin, coalesce(f.name, c.name) AS name FROM cache c FULL JOIN fresh f USING (asin)""",
    ),
    "training_text": (
        training_text,
        rank(
            "SELECT meta_category, prompt || output || '</s>' AS text FROM examples JOIN prompts USING (meta_category)",
            _EXAMPLES, NAMES, DIGEST, DIGEST_OUT, PROMPT,
        ),
    ),
    "union_splits": (
        union_splits,
        text("SELECT review_id, split, CASE WHEN split <> 'test' THEN helpful_vote END AS helpful_vote FROM reviews"),
    ),
    "product_overlap": (
        product_overlap,
        written(
            "SELECT article_id, len(list_intersect(g, s)) AS shared,"
            " len(list_filter(g, lambda x: NOT list_contains(s, x))) AS only_generated,"
            " len(list_filter(s, lambda x: NOT list_contains(g, x))) AS only_source FROM named",
            PRODUCTS,
        ),
    ),
}
