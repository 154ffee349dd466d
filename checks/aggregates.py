"""Aggregations and classification measures."""

from __future__ import annotations

from checks.base import ARTICLES, NAMES, PRODUCTS, guesses, points, rank, rounded, text
from checks.rows import SENTIMENT
from reviewloom.operators import articles as scores
from reviewloom.operators import metrics, quality, stats
from reviewloom.plans.prepare import clean_split
from reviewloom.sources import adapters


def _rank(spark, sf):
    return adapters.ranked_reviews(spark, sf)


def _points(spark, sf):
    return adapters.category_points(spark, sf)


def _labelled(spark, sf):
    return quality.sentiment_label(adapters.text_reviews(spark, sf))


def _guesses(spark, sf):
    return adapters.predictions(spark, sf)


def corpus_profile(spark, sf):
    return stats.corpus_profile(_rank(spark, sf))


def products_per_cluster(spark, sf):
    return stats.products_per_cluster(_rank(spark, sf))


def class_counts(spark, sf):
    return stats.class_counts(_labelled(spark, sf))


def class_shares(spark, sf):
    return rounded(stats.class_shares(_labelled(spark, sf)))


def removal_report(spark, sf):
    before = adapters.text_reviews(spark, sf)
    return rounded(stats.removal_report(before, clean_split(before)))


def meta_category_counts(spark, sf):
    return stats.meta_category_counts(_rank(spark, sf))


def meta_category_ids(spark, sf):
    return stats.meta_category_ids(_rank(spark, sf))


def subcategory_counts(spark, sf):
    return stats.subcategory_counts(_rank(spark, sf))


def product_stats(spark, sf):
    return rounded(stats.product_stats(_rank(spark, sf)))


def min_reviews(spark, sf):
    return rounded(stats.min_reviews(stats.product_stats(_rank(spark, sf)), 30))


def cluster_sizes(spark, sf):
    return rounded(stats.cluster_sizes(_points(spark, sf)))


def noise_report(spark, sf):
    return rounded(stats.noise_report(_points(spark, sf)))


def noise_categories(spark, sf):
    return stats.noise_categories(_points(spark, sf))


def cluster_probability(spark, sf):
    return rounded(stats.cluster_probability(_points(spark, sf)))


def cluster_probability_members(spark, sf):
    return rounded(stats.cluster_probability(_points(spark, sf), members=True))


def probability_moments(spark, sf):
    return rounded(stats.probability_moments(_points(spark, sf)))


def class_weights(spark, sf):
    return rounded(metrics.class_weights(_guesses(spark, sf)))


def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_guesses(spark, sf))


def class_metrics(spark, sf):
    return rounded(metrics.class_metrics(_guesses(spark, sf)))


def weighted_metrics(spark, sf):
    return rounded(metrics.weighted_metrics(_guesses(spark, sf)))


def smoothed_loss(spark, sf):
    rows = _guesses(spark, sf)
    return rounded(metrics.smoothed_loss(rows, metrics.class_weights(rows)))


def category_rollup(spark, sf):
    return stats.category_rollup(_points(spark, sf))


def metric_quartiles(spark, sf):
    scored = scores.product_metrics(adapters.articles(spark, sf))
    return rounded(stats.metric_quartiles(scored, ["precision", "recall", "f1"]))


def probability_density(spark, sf):
    return rounded(stats.probability_density(_points(spark, sf)))


_STATS = (
    "SELECT asin, count(*) AS n_rows, count(rating) AS n_rated, round(avg(rating), 6) AS mean_rating,"
    " coalesce(sum(helpful_vote), 0)::BIGINT AS helpful_votes, min(category) AS category FROM reviews GROUP BY asin"
)

_CLEAN = """kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY split, text, rating, category ORDER BY review_id) AS rn
  FROM reviews WHERE (split <> 'train' OR rating > 0) AND length(text) > 4)
  WHERE rn = 1 AND length(trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))) > 0)"""

_PER_CLASS = """per AS (SELECT c AS class,
  (SELECT count(*) FROM guesses WHERE label = c AND prediction = c)::DOUBLE AS tp,
  (SELECT count(*) FROM guesses WHERE prediction = c) AS predicted,
  (SELECT count(*) FROM guesses WHERE label = c) AS support FROM range(3) t(c)),
pr AS (SELECT class, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall, support, tp FROM per),
scored AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM pr)"""

_OVERLAP = """sets AS (SELECT article_id, len(list_intersect(g, s))::DOUBLE AS tp, len(g) AS n_g, len(s) AS n_s FROM named),
pr AS (SELECT article_id, CASE WHEN n_g > 0 THEN tp / n_g ELSE 0 END AS precision, CASE WHEN n_s > 0 THEN tp / n_s ELSE 0 END AS recall FROM sets),
scored AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pr),
long AS (SELECT 'precision' AS metric, precision AS value FROM scored UNION ALL SELECT 'recall', recall FROM scored UNION ALL SELECT 'f1', f1 FROM scored)"""

CASES = {
    "corpus_profile": (
        corpus_profile,
        rank("SELECT count(*) AS n_reviews, count(DISTINCT asin) AS n_products, count(DISTINCT category) AS n_categories FROM reviews"),
    ),
    "products_per_cluster": (
        products_per_cluster,
        rank("SELECT meta_category, count(DISTINCT asin) AS n_products FROM reviews GROUP BY meta_category"),
    ),
    "class_counts": (
        class_counts,
        text(
            f"SELECT split, sentiment, count(*) AS n_rows FROM (SELECT *, {SENTIMENT} AS sentiment FROM reviews)"
            " WHERE sentiment IS NOT NULL GROUP BY split, sentiment"
        ),
    ),
    "class_shares": (
        class_shares,
        text(
            "SELECT split, field, value, count(*) AS n_rows,"
            " round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY split, field), 6) AS share FROM ("
            "SELECT split, 'rating' AS field, rating::VARCHAR AS value FROM reviews"
            f" UNION ALL SELECT split, 'sentiment', {SENTIMENT} FROM reviews) WHERE value IS NOT NULL GROUP BY split, field, value"
        ),
    ),
    "removal_report": (
        removal_report,
        text(
            "SELECT split, n_before, n_after, n_before - n_after AS n_removed,"
            " round((n_before - n_after) * 100.0::DOUBLE / n_before, 6) AS pct_removed"
            " FROM (SELECT split, count(*) AS n_before FROM reviews GROUP BY split)"
            " JOIN (SELECT split, count(*) AS n_after FROM kept GROUP BY split) USING (split)",
            _CLEAN,
        ),
    ),
    "meta_category_counts": (
        meta_category_counts,
        rank(
            "SELECT meta_category, count(*) AS n_reviews, row_number() OVER (ORDER BY count(*) DESC, meta_category) AS size_rank,"
            " any_value(name) AS meta_name FROM reviews JOIN names USING (meta_category) GROUP BY meta_category",
            NAMES,
        ),
    ),
    "meta_category_ids": (meta_category_ids, rank("SELECT DISTINCT meta_category FROM reviews")),
    "subcategory_counts": (
        subcategory_counts,
        rank("SELECT meta_category, category, count(*) AS n_reviews FROM reviews GROUP BY meta_category, category"),
    ),
    "product_stats": (product_stats, rank(_STATS)),
    "min_reviews": (min_reviews, rank(_STATS + " HAVING count(rating) >= 30")),
    "cluster_sizes": (
        cluster_sizes,
        points(
            "SELECT cluster, count(*) AS n_categories, round(count(*)::DOUBLE / (SELECT count(*) FROM points), 6) AS share"
            " FROM points WHERE cluster <> -1 GROUP BY cluster"
        ),
    ),
    "noise_report": (
        noise_report,
        points(
            "SELECT count(DISTINCT cluster) FILTER (cluster <> -1) AS n_clusters, count(*) FILTER (cluster = -1) AS n_noise,"
            " round(count(*) FILTER (cluster = -1)::DOUBLE / count(*), 6) AS noise_ratio, NULL::DOUBLE AS stability_score FROM points"
        ),
    ),
    "noise_categories": (noise_categories, points("SELECT category FROM points WHERE cluster = -1")),
    "cluster_probability": (
        cluster_probability,
        points(
            "SELECT cluster, count(*) AS n_categories, round(avg(probability), 6) AS avg_probability,"
            " min(probability) AS min_probability FROM points WHERE cluster <> -1 GROUP BY cluster"
        ),
    ),
    "cluster_probability_members": (
        cluster_probability_members,
        points(
            "SELECT cluster, count(*) OVER w AS n_categories, round(avg(probability) OVER w, 6) AS avg_probability,"
            " min(probability) OVER w AS min_probability, category FROM points WHERE cluster <> -1 WINDOW w AS (PARTITION BY cluster)"
        ),
    ),
    "probability_moments": (
        probability_moments,
        points(
            "SELECT round(avg(probability), 6) AS mean_probability, round(stddev_pop(probability), 6) AS std_probability FROM points"
        ),
    ),
    "class_weights": (
        class_weights,
        guesses(
            "SELECT label, count(*) AS n_rows, round(sum(count(*)) OVER ()::DOUBLE / (count(*) OVER () * count(*)), 6) AS weight"
            " FROM guesses GROUP BY label"
        ),
    ),
    "confusion_matrix": (
        confusion_matrix,
        guesses(
            "SELECT c::INT AS label, count(*) FILTER (prediction = 0) AS pred_0, count(*) FILTER (prediction = 1) AS pred_1,"
            " count(*) FILTER (prediction = 2) AS pred_2 FROM range(3) t(c) LEFT JOIN guesses ON label = c GROUP BY c"
        ),
    ),
    "class_metrics": (
        class_metrics,
        guesses(
            "SELECT class::INT AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM scored",
            _PER_CLASS,
        ),
    ),
    "weighted_metrics": (
        weighted_metrics,
        guesses(
            "SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(precision * support) / sum(support), 6) AS precision,"
            " round(sum(recall * support) / sum(support), 6) AS recall, round(sum(f1 * support) / sum(support), 6) AS f1 FROM scored",
            _PER_CLASS,
        ),
    ),
    "smoothed_loss": (
        smoothed_loss,
        guesses(
            """SELECT count(*) AS n_batches, round(avg(l), 6) AS loss FROM (
  SELECT batch, sum(0.9::DOUBLE * w * -ln(p_own) + 0.1::DOUBLE / 3 * every) / sum(w) AS l FROM rows GROUP BY batch)""",
            """w AS (SELECT label, sum(count(*)) OVER ()::DOUBLE / (count(*) OVER () * count(*)) AS weight FROM guesses GROUP BY label),
wsum AS (SELECT sum(weight) AS total FROM w),
rows AS (SELECT (row_number() OVER (ORDER BY md5('42:' || id), id) - 1) // 64 AS batch, own.weight AS w,
                CASE WHEN g.label = prediction THEN 0.8::DOUBLE ELSE 0.1::DOUBLE END AS p_own,
                guess.weight * -ln(0.8::DOUBLE) + (total - guess.weight) * -ln(0.1::DOUBLE) AS every
         FROM guesses g JOIN w own ON own.label = g.label JOIN w guess ON guess.label = g.prediction, wsum)""",
        ),
    ),
    "category_rollup": (
        category_rollup,
        points(
            "SELECT meta_name, category, count(*) AS n_categories, grouping(meta_name, category)::INT AS level"
            " FROM (SELECT coalesce(name, 'cluster ' || cluster) AS meta_name, category FROM points"
            " LEFT JOIN names ON cluster = meta_category WHERE cluster <> -1) GROUP BY ROLLUP (meta_name, category)",
            NAMES,
        ),
    ),
    "metric_quartiles": (
        metric_quartiles,
        f"WITH {ARTICLES}, {PRODUCTS}, {_OVERLAP}, qs AS (SELECT metric, quantile_cont(value, [0.0, 0.25, 0.5, 0.75, 1.0]) AS v FROM long GROUP BY metric)"
        " SELECT metric, unnest([0.0, 0.25, 0.5, 0.75, 1.0])::DOUBLE AS quantile, round(unnest(v), 6) AS value FROM qs",
    ),
    "probability_density": (
        probability_density,
        points(
            """SELECT cluster, grid::INT AS grid, round(max(x), 6) AS x,
  round(sum(exp(-0.5::DOUBLE * ((x - probability) / h) * ((x - probability) / h))) / (any_value(size) * any_value(h) * sqrt(2 * pi())), 6) AS density
FROM (SELECT points.cluster, probability, h, size, grid,
             (lo - 3 * h) + ((hi + 3 * h) - (lo - 3 * h)) * grid / 199 AS x
      FROM points JOIN shape ON points.cluster = shape.cluster, range(200) g(grid))
GROUP BY cluster, grid""",
            """shape AS (SELECT cluster, count(*)::DOUBLE AS size, stddev_samp(probability) * count(*) ** -0.2 AS h,
  min(probability) AS lo, max(probability) AS hi FROM points WHERE cluster <> -1 GROUP BY cluster HAVING max(probability) > min(probability))""",
        ),
    ),
}
