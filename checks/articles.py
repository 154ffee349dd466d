"""Article scores and report tables."""

from __future__ import annotations

from checks.base import NAMES, PRODUCTS, points, rounded, written
from checks.ingest import DAVIES
from checks.modelling import SOFT
from reviewloom.contracts import META_CATEGORY_NAMES
from reviewloom.operators import articles as scores
from reviewloom.operators import report, stats, validity
from reviewloom.plans import evaluation
from reviewloom.sources import adapters
from pyspark.sql import functions as F

KEEP = ["article_id", "accuracy", "precision", "recall", "f1"]


def section_metrics(spark, sf):
    return rounded(scores.section_metrics(adapters.articles(spark, sf)).select(*KEEP))


def section_metrics_clamped(spark, sf):
    return rounded(scores.section_metrics(adapters.articles(spark, sf), clamp=True).select(*KEEP))


def product_metrics(spark, sf):
    return rounded(scores.product_metrics(adapters.articles(spark, sf)).select(*KEEP))


def _parts(spark, sf):
    vectors = adapters.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return evaluation.score_articles(adapters.articles(spark, sf, heavy=True), vectors, vectors.count())


def evaluation_table(spark, sf):
    return rounded(scores.evaluation_table(_parts(spark, sf)))


def evaluation_long(spark, sf):
    parts = _parts(spark, sf)
    return rounded(scores.evaluation_long({k: parts[k] for k in ("structure", "products")}))


def _points(spark, sf):
    return adapters.category_points(spark, sf)


def metric_bars(spark, sf):
    points_ = _points(spark, sf)
    metrics = stats.noise_report(points_).select(
        "*", validity.davies_bouldin(points_).scalar().alias("davies_bouldin")
    )
    return rounded(report.metric_bars(metrics))


def category_graph(spark, sf):
    return report.category_graph(_points(spark, sf))


def treemap_rows(spark, sf):
    return rounded(report.treemap_rows(_points(spark, sf)))


def cluster_contents(spark, sf):
    # one name more than there are clusters, so that one stays empty
    return report.cluster_contents(_points(spark, sf), {**META_CATEGORY_NAMES, 5: "Sixth", 99: "Empty"})


def _structure(clamp: bool) -> str:
    precision = "CASE WHEN headers > 0 THEN tp / headers ELSE 0 END"
    if clamp:
        precision = f"least(1.0::DOUBLE, {precision})"
    return f"""found AS (SELECT article_id,
  len(list_filter(['title:', 'introduction:', 'top 3 recommended products:', 'worst product warning:', 'final verdict:'],
                  lambda s: contains(lower(generated), s)))::DOUBLE AS tp,
  len(list_filter(string_split(generated, chr(10)), lambda x: ends_with(x, ':'))) AS headers FROM articles),
spr AS (SELECT article_id, tp / 5 AS accuracy, {precision} AS precision, tp / 5 AS recall FROM found),
structure AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM spr)"""


_OVERLAP = """sets AS (SELECT article_id, len(list_intersect(g, s))::DOUBLE AS tp, len(g) AS n_g, len(s) AS n_s FROM named),
ppr AS (SELECT article_id, CASE WHEN n_s > 0 THEN tp / n_s ELSE 0 END AS accuracy, CASE WHEN n_g > 0 THEN tp / n_g ELSE 0 END AS precision,
               CASE WHEN n_s > 0 THEN tp / n_s ELSE 0 END AS recall FROM sets),
products AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM ppr)"""


def _scores(table: str) -> str:
    cells = ", ".join(f"round({c}, 6) AS {c}" for c in KEEP[1:])
    return f"SELECT article_id, {cells} FROM {table}"


def _long(kind: str, measures) -> str:
    return " UNION ALL ".join(
        f"SELECT article_id, '{kind}' AS kind, '{m}' AS metric, {m} AS value FROM {kind}" for m in measures
    )


_LONG = f"long AS ({_long('structure', KEEP[1:])} UNION ALL {_long('products', KEEP[1:])})"
_SOFT_LONG = "softlong AS (" + _long("soft", KEEP[2:]) + ")"

CASES = {
    "section_metrics": (section_metrics, written(_scores("structure"), _structure(False))),
    "section_metrics_clamped": (section_metrics_clamped, written(_scores("structure"), _structure(True))),
    "product_metrics": (product_metrics, written(_scores("products"), PRODUCTS, _OVERLAP)),
    "evaluation_long": (
        evaluation_long,
        written("SELECT article_id, kind, metric, round(value, 6) AS value FROM long", PRODUCTS, _OVERLAP, _structure(False), _LONG),
    ),
    "evaluation_table": (
        evaluation_table,
        written(
            "SELECT metric, round(avg(value) FILTER (kind = 'structure'), 6) AS structure,"
            " round(avg(value) FILTER (kind = 'products'), 6) AS products, round(avg(value) FILTER (kind = 'soft'), 6) AS soft_match"
            " FROM (SELECT * FROM long UNION ALL SELECT * FROM softlong) GROUP BY metric",
            PRODUCTS, _OVERLAP, _structure(False), _LONG, SOFT, _SOFT_LONG,
        ),
    ),
    "metric_bars": (
        metric_bars,
        points(
            "SELECT * FROM (SELECT 'n_clusters' AS metric, count(DISTINCT cluster) FILTER (cluster <> -1)::DOUBLE AS value FROM points"
            " UNION ALL SELECT 'n_noise', count(*) FILTER (cluster = -1)::DOUBLE FROM points"
            " UNION ALL SELECT 'noise_ratio', round(count(*) FILTER (cluster = -1)::DOUBLE / count(*), 6) FROM points"
            " UNION ALL SELECT 'davies_bouldin', davies_bouldin FROM davies)",
            DAVIES,
        ),
    ),
    "category_graph": (
        category_graph,
        points(
            "SELECT 'node' AS kind, name AS source, NULL::VARCHAR AS target, 'meta' AS node_type, 2000 AS size FROM names"
            " UNION ALL SELECT 'node', category, NULL, 'sub', 1000 FROM points JOIN names ON cluster = meta_category"
            " UNION ALL SELECT 'edge', name, category, NULL, NULL FROM points JOIN names ON cluster = meta_category",
            NAMES,
        ),
    ),
    "treemap_rows": (
        treemap_rows,
        points(
            "SELECT name AS meta_name, category, round(sum(probability), 6) AS probability, grouping(name, category)::INT AS level"
            " FROM points JOIN names ON cluster = meta_category GROUP BY ROLLUP (name, category)",
            NAMES,
        ),
    ),
    "cluster_contents": (
        cluster_contents,
        points(
            "SELECT meta_category, name, category FROM names LEFT JOIN points ON cluster = meta_category",
            NAMES.replace("(4, 'Home & Garden')", "(4, 'Home & Garden'), (5, 'Sixth'), (99, 'Empty')"),
        ),
    ),
}
