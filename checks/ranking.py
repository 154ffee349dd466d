"""Top-k operators, digests, prompts, generation."""

from __future__ import annotations

from checks.base import NAMES, points, rank, rounded
from reviewloom.operators import ranking, stats, validity
from reviewloom.plans import digest
from reviewloom.sources import adapters, sinks
from reviewloom.staging import fresh_path

MIN_REVIEWS = 30


def reviews(spark, sf):
    return adapters.ranked_reviews(spark, sf)


def _by_meta(spark, sf):
    return stats.product_stats(reviews(spark, sf), ("meta_category", "asin"))


def main_subcategory(spark, sf):
    return ranking.main_subcategory(stats.subcategory_counts(reviews(spark, sf)))


def top_products(spark, sf):
    return rounded(ranking.top_products(_by_meta(spark, sf))).drop("category")


def worst_product(spark, sf):
    return rounded(ranking.worst_product(_by_meta(spark, sf))).drop("category")


def helpful_samples(spark, sf):
    return ranking.helpful_samples(reviews(spark, sf)).select("meta_category", "asin", "review_id", "sample_rank")


def negative_samples(spark, sf):
    return ranking.negative_samples(reviews(spark, sf)).select("meta_category", "asin", "review_id", "sample_rank")


def most_reviewed_products(spark, sf):
    return rounded(ranking.most_reviewed_products(_by_meta(spark, sf))).drop("category")


def cluster_top_categories(spark, sf):
    return rounded(ranking.cluster_top_categories(adapters.category_points(spark, sf)))


def silhouette_profile(spark, sf):
    samples = validity.silhouette_samples(adapters.category_points(spark, sf))
    return rounded(ranking.silhouette_profile(samples))


def digests(spark, sf):
    return digest.review_digest(reviews(spark, sf), MIN_REVIEWS)


def review_digest_popular(spark, sf):
    return digest.review_digest_popular(reviews(spark, sf))


def prompt_table(spark, sf):
    return digest.prompt_table(digests(spark, sf)).select("meta_category", "meta_name", "prompt")


def article_generation(spark, sf):
    return digest.article_generation(digest.prompt_table(digests(spark, sf)))


def write_articles(spark, sf):
    return sinks.write_articles(article_generation(spark, sf), fresh_path(spark, "articles"))


STATS = """stats AS (SELECT meta_category, asin, count(*) AS n_rows, count(rating) AS n_rated,
  round(avg(rating), 6) AS mean_rating, coalesce(sum(helpful_vote), 0)::BIGINT AS helpful_votes FROM reviews GROUP BY meta_category, asin)"""


def _ranked(order: str, k: int) -> str:
    return rank(
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY meta_category ORDER BY {order}) AS rank FROM stats) WHERE rank <= {k}",
        STATS,
    )


def _samples(order: str) -> str:
    return rank(
        "SELECT meta_category, asin, review_id, sample_rank FROM (SELECT *, row_number() OVER"
        f" (PARTITION BY meta_category, asin ORDER BY {order}, review_id) AS sample_rank FROM reviews) WHERE sample_rank <= 2"
    )


DIGEST = f"""cells AS (SELECT meta_category, category, asin, count(*) AS n_rows, count(rating) AS n_rated,
  avg(rating) AS mean_rating, coalesce(sum(helpful_vote), 0) AS helpful_votes FROM reviews GROUP BY meta_category, category, asin),
main AS (SELECT meta_category, category FROM (SELECT *, row_number() OVER (PARTITION BY meta_category
  ORDER BY (category = '[UNKNOWN]')::INT, n DESC, category) AS rn
  FROM (SELECT meta_category, category, sum(n_rows) AS n FROM cells GROUP BY meta_category, category)) WHERE rn = 1),
stats AS (SELECT cells.* FROM cells JOIN main USING (meta_category, category)),
fit AS (SELECT * FROM stats WHERE n_rated >= {MIN_REVIEWS}),
picks AS (
  SELECT * FROM (SELECT *, 'top' AS role, row_number() OVER (PARTITION BY meta_category ORDER BY mean_rating DESC, n_rated DESC, asin) AS rank FROM fit) WHERE rank <= 3
  UNION ALL
  SELECT * FROM (SELECT *, 'worst' AS role, row_number() OVER (PARTITION BY meta_category ORDER BY mean_rating, helpful_votes DESC, asin) AS rank FROM fit) WHERE rank = 1),
shown AS (SELECT p.meta_category, p.role, p.asin, string_agg(text, chr(10) ORDER BY n) AS samples FROM (
  SELECT p.meta_category, p.role, p.asin, r.text, row_number() OVER (PARTITION BY p.meta_category, p.role, p.asin
    ORDER BY CASE WHEN role = 'worst' THEN rating END NULLS LAST, helpful_vote DESC NULLS LAST, review_id) AS n
  FROM picks p JOIN reviews r ON r.meta_category = p.meta_category AND r.category = p.category AND r.asin = p.asin) p
  WHERE n <= 2 GROUP BY ALL),
blocks AS (SELECT meta_category, role, rank, chr(10) || 'Product: Product ' || asin || chr(10)
  || 'Average Rating: ' || printf('%.1f', round(mean_rating, 1)) || '/5' || chr(10)
  || 'Total Reviews: ' || n_rows || chr(10)
  || CASE WHEN role = 'top' THEN 'Sample Reviews:' ELSE 'Sample Negative Reviews:' END || chr(10) || samples AS block
  FROM picks JOIN shown USING (meta_category, role, asin))"""

DIGEST_OUT = """digest AS (SELECT meta_category, category,
  chr(10) || 'TOP RATED PRODUCTS:' || coalesce((SELECT string_agg(chr(10) || block, '' ORDER BY rank) FROM blocks b WHERE b.meta_category = m.meta_category AND role = 'top'), '')
  || chr(10) || chr(10) || 'WORST RATED PRODUCT WARNING:'
  || coalesce((SELECT string_agg(chr(10) || block, '' ORDER BY rank) FROM blocks b WHERE b.meta_category = m.meta_category AND role = 'worst'), '') AS review_data,
  (SELECT count(*) FROM fit f WHERE f.meta_category = m.meta_category) AS n_qualified
  FROM main m)"""


def _template_sql() -> str:
    """The prompt template as an SQL concatenation."""
    out = "'" + digest.PROMPT_TEMPLATE.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    for name, column in [("meta_category", "name"), ("category", "category"), ("review_data", "review_data")]:
        out = out.replace("{" + name + "}", f"' || {column} || '")
    return out


PROMPT = f"""prompts AS (SELECT meta_category, name AS meta_name, {_template_sql()} AS prompt
  FROM digest JOIN names USING (meta_category))"""

ARTICLE = """lines AS (SELECT meta_category, name, category,
  list_filter(string_split(review_data, chr(10)), lambda x: starts_with(x, 'Product: ')) AS l FROM digest JOIN names USING (meta_category)),
articles AS (SELECT meta_category, array_to_string(list_concat(
    ['Title: Choosing among ' || name, 'Introduction: What buyers report about ' || category || '.', 'TOP 3 RECOMMENDED PRODUCTS:'],
    l[1:len(l) - 1], ['WORST PRODUCT WARNING:'], l[len(l):len(l)], ['Final Verdict: Trust the ratings above.']), chr(10)) AS article
  FROM lines)"""

POPULAR = """popular AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY meta_category ORDER BY n_rated DESC, asin) AS prank FROM stats) WHERE prank <= 5),
pshown AS (SELECT meta_category, asin, string_agg(text, chr(10) ORDER BY n) AS samples FROM (
  SELECT p.meta_category, p.asin, r.text, row_number() OVER (PARTITION BY p.meta_category, p.asin ORDER BY helpful_vote DESC NULLS LAST, review_id) AS n
  FROM popular p JOIN reviews r ON r.meta_category = p.meta_category AND r.category = p.category AND r.asin = p.asin)
  WHERE n <= 3 GROUP BY meta_category, asin)"""

SILHOUETTE = """pairs AS (SELECT a.category, a.cluster, b.cluster AS other, list_distance(a.vector, b.vector) AS d
  FROM points a JOIN points b ON a.category <> b.category),
means AS (SELECT category, cluster, other, avg(d) AS m FROM pairs GROUP BY category, cluster, other),
ab AS (SELECT category, cluster, max(m) FILTER (other = cluster) AS a, min(m) FILTER (other <> cluster) AS b FROM means GROUP BY category, cluster),
silhouettes AS (SELECT category, cluster, CASE WHEN a IS NULL THEN 0.0::DOUBLE ELSE (b - a) / greatest(a, b) END AS silhouette FROM ab)"""

CASES = {
    "main_subcategory": (
        main_subcategory,
        rank(
            "SELECT meta_category, category, n_reviews FROM (SELECT *, row_number() OVER (PARTITION BY meta_category"
            " ORDER BY (category = '[UNKNOWN]')::INT, n_reviews DESC, category) AS rn FROM"
            " (SELECT meta_category, category, count(*) AS n_reviews FROM reviews GROUP BY ALL)) WHERE rn = 1"
        ),
    ),
    "top_products": (top_products, _ranked("mean_rating DESC, n_rated DESC, asin", 3)),
    "worst_product": (worst_product, _ranked("mean_rating, helpful_votes DESC, asin", 1)),
    "helpful_samples": (helpful_samples, _samples("helpful_vote DESC NULLS LAST")),
    "negative_samples": (negative_samples, _samples("rating, helpful_vote DESC NULLS LAST")),
    "most_reviewed_products": (most_reviewed_products, _ranked("n_rated DESC, asin", 5)),
    "cluster_top_categories": (
        cluster_top_categories,
        points(
            "SELECT cluster, array_to_string(list_sort(list(category))[1:5], ', ') AS top_categories,"
            " round(avg(probability), 6) AS avg_probability FROM points WHERE cluster <> -1 GROUP BY cluster"
        ),
    ),
    "silhouette_profile": (
        silhouette_profile,
        points(
            """SELECT s.cluster, category, round(silhouette, 6) AS silhouette,
  row_number() OVER (PARTITION BY s.cluster ORDER BY silhouette, category) AS rank,
  (below + row_number() OVER (PARTITION BY s.cluster ORDER BY silhouette, category) - 1)::BIGINT AS y
FROM silhouettes s JOIN (SELECT cluster, sum(count(*) + 10) OVER (ORDER BY cluster) - count(*) AS below
                         FROM points WHERE cluster <> -1 GROUP BY cluster) USING (cluster)""",
            SILHOUETTE,
        ),
    ),
    "review_digest": (digests, rank("SELECT * FROM digest", DIGEST, DIGEST_OUT)),
    "review_digest_popular": (
        review_digest_popular,
        rank(
            """SELECT meta_category, main.category, coalesce((SELECT string_agg(chr(10) || 'Product: Product ' || p.asin || chr(10)
  || 'Category: ' || p.category || chr(10) || 'Total Reviews: ' || format('{:,}', n_rows) || chr(10)
  || 'Average Rating: ' || printf('%.1f', round(mean_rating, 1)) || '/5' || chr(10) || 'Sample Reviews:' || chr(10) || samples,
  chr(10) ORDER BY prank) FROM popular p JOIN pshown s ON p.meta_category = s.meta_category AND p.asin = s.asin
  WHERE p.meta_category = main.meta_category), '') AS review_data FROM main""",
            DIGEST, POPULAR,
        ),
    ),
    "prompt_table": (prompt_table, rank("SELECT * FROM prompts", NAMES, DIGEST, DIGEST_OUT, PROMPT)),
    "article_generation": (article_generation, rank("SELECT * FROM articles", NAMES, DIGEST, DIGEST_OUT, ARTICLE)),
    "write_articles": (write_articles, rank("SELECT * FROM articles", NAMES, DIGEST, DIGEST_OUT, ARTICLE)),
}
