"""Vectors, clusters, validity measures, models."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from checks.base import POINTS, points, rounded, text, written
from checks.rows import NORMAL
from checks.ingest import DAVIES
from checks.ranking import SILHOUETTE
from reviewloom.operators import articles as scores
from reviewloom.operators import clusters, embedding, hierarchy, projection, quality, sampling, sentiment, validity
from reviewloom.plans import clustering, sentiment as sentiment_plan
from reviewloom.sources import adapters
from reviewloom.staging import fresh_path

FULL = {"min_size": 2, "min_samples": 1, "eps": 1.04, "alpha": 1.0}
FLAT = {"min_size": 2, "min_samples": 1, "eps": 0.25, "alpha": 1.0}
DENSER = {"min_size": 3, "min_samples": 2, "eps": 0.3, "alpha": 1.0}


def _points(spark, sf):
    return adapters.category_points(spark, sf)


# Three projections of all 64 coordinates: the signs are digits of the dimension's md5.
SIGNS = [[1 if hashlib.md5(f"{axis}:{dim}".encode()).hexdigest()[0] < "8" else -1 for dim in range(64)] for axis in range(3)]


def _projected(spark, sf):
    """The vectors on three fixed axes, each a signed sum of all coordinates."""
    def axis(signs):
        products = F.zip_with("vector", F.array(*map(F.lit, signs)), lambda x, s: x * s)
        return F.aggregate(products, F.lit(0.0), lambda a, x: a + x)

    return _points(spark, sf).withColumn("vector", F.array(*map(axis, SIGNS)))


def category_vectors(spark, sf):
    """Mean vector per label, one row per coordinate."""
    rows = adapters.table(spark, sf, "embeddings").select(F.col("label").alias("category"), F.col("embedding").alias("vector"))
    means = clusters.category_vectors(rows)
    return rounded(means.select("category", F.posexplode("vector").alias("dim", "value")))


def category_text_vectors(spark, sf):
    return clusters.category_text_vectors(adapters.text_reviews(spark, sf, heavy=True))


def reduce_dims(spark, sf):
    return clusters.reduce_dims(_points(spark, sf).select("category", "vector"))


def density_cluster(spark, sf):
    return clusters.density_cluster(_points(spark, sf), **FULL)


def density_cluster_flat(spark, sf):
    return clusters.density_cluster(_projected(spark, sf), **FLAT)


def density_cluster_denser(spark, sf):
    return clusters.density_cluster(_projected(spark, sf), **DENSER)


def membership_probability(spark, sf):
    return rounded(clusters.membership_probability(_points(spark, sf), **FULL))


def membership_probability_flat(spark, sf):
    return rounded(clusters.membership_probability(_projected(spark, sf), **FLAT))


def silhouette_samples(spark, sf):
    return rounded(validity.silhouette_samples(_points(spark, sf)))


def silhouette_centroid(spark, sf):
    return rounded(validity.centroid_silhouettes(_points(spark, sf)))


def silhouette_score(spark, sf):
    return rounded(validity.silhouette_score(_points(spark, sf)))


def calinski_harabasz(spark, sf):
    return rounded(validity.calinski_harabasz(_points(spark, sf)))


def davies_bouldin(spark, sf):
    return rounded(validity.davies_bouldin(_points(spark, sf)))


def cluster_categories(spark, sf):
    """The whole clustering job on vectors made from the review texts."""
    reviews = adapters.text_reviews(spark, sf, heavy=True)
    vectors = clusters.category_text_vectors(reviews)
    run = clustering.cluster_categories(reviews, vectors, min_size=2, eps=2.0, alpha=1.0)
    return run.reviews.groupBy("category", "meta_category").agg(F.count("*").alias("n_reviews"))


TREE = {"min_size": 5, "min_samples": 4, "epsilon": 0.1, "alpha": 1.0}
THRESHOLDS = [0.2, 0.25, 0.3]


def cluster_tree(spark, sf):
    """Clusters of most excess of mass in the tree of all density clusters."""
    return rounded(hierarchy.density_hierarchy(_projected(spark, sf), **TREE).labels)


def cluster_tree_validity(spark, sf):
    found = hierarchy.density_hierarchy(_projected(spark, sf), **TREE)
    return rounded(hierarchy.relative_validity(found.labels, found.edges))


def spanning_tree(spark, sf):
    """How many edges of the spanning tree of distances are within each threshold."""
    points_ = _projected(spark, sf).select(F.col("category").alias("key"), "vector", F.lit(0.0).alias("core"))
    edges = hierarchy.condensed_tree(
        points_.select("key", F.lit(1).cast("bigint").alias("n"), "core"), hierarchy.tree_edges(points_)
    ).edges
    within = [F.count_if(F.col("weight") <= t) for t in THRESHOLDS]
    rows = edges.agg(F.array(*within).alias("n")).select(F.posexplode("n").alias("threshold", "n_edges"))
    return rows


def project_categories(spark, sf):
    """The vectors on three coordinates that keep their neighbours."""
    how = projection.Layout(filters=3, degree=4, epochs=2)
    return projection.project(_points(spark, sf).select("category", "vector"), how)


def word_information(spark, sf):
    """Mutual information of the words of all review texts that stand near each other."""
    pairs, names = embedding.coded_pair_counts(adapters.text_reviews(spark, sf, heavy=True), window=2, min_count=200)
    return rounded(embedding.named(embedding.mutual_information(pairs, 1), names))


def category_word_vectors(spark, sf):
    reviews = adapters.text_reviews(spark, sf, heavy=True)
    return embedding.category_word_vectors(reviews, dims=8, window=2, min_count=50)


def apply_saved_model(spark, sf):
    vectors = _points(spark, sf).select("category", "vector")
    model = clusters.fit_reducer(vectors)
    labels = clusters.density_labels(clusters.reduce_with(model, vectors), eps=0.1)
    path = fresh_path(spark, "model")
    clusters.save_clustering(model, labels, path)
    again = clusters.apply_saved_model(vectors, path, eps=0.1)
    _, stored = clusters.load_clustering(spark, path)
    both = again.join(stored.withColumnRenamed("cluster", "stored").select("category", "stored"), "category")
    return both.agg(F.count("*").alias("n"), F.count_if(F.col("cluster") != F.col("stored")).alias("n_different"))


def _splits(spark, sf):
    rows = quality.sentiment_label(adapters.text_reviews(spark, sf, heavy=True)).withColumnRenamed("text", "processed_text")
    out = sampling.balanced_splits(rows, 100, 60, 60)
    return {name: out.where(F.col("split") == name) for name in ("train", "val", "test")}


def train_sentiment(spark, sf):
    model = sentiment.train_sentiment(_splits(spark, sf)["train"], n_features=4096)
    weights = model.stages[-1]
    return spark.createDataFrame(
        [(i, float(x)) for i, x in enumerate(weights.interceptVector)], "label int, intercept double"
    )


def predict_sentiment(spark, sf):
    parts = _splits(spark, sf)
    model = sentiment.train_sentiment(parts["train"], n_features=4096)
    rows = quality.sentiment_label(adapters.text_reviews(spark, sf, heavy=True)).withColumnRenamed("text", "processed_text")
    return sentiment.predict_sentiment(model, rows).select("review_id", "sentiment", "probability", "prediction")


def select_model(spark, sf):
    parts = _splits(spark, sf)
    grid = [{"reg": 0.01, "n_features": 4096}, {"reg": 0.1, "n_features": 4096}]
    return sentiment.select_model(parts["train"], parts["val"], grid)[1]


def sentiment_job(spark, sf):
    """The whole job; its confusion counts and measures must agree with each other on the test rows."""
    rows = adapters.text_reviews(spark, sf, heavy=True).withColumnRenamed("text", "processed_text").drop("split")
    job = sentiment_plan.sentiment_job(rows, fresh_path(spark, "sentiment"), 100, 60, 60, ({"reg": 0.01, "n_features": 4096},))
    return job.confusion.select("label", (F.col("pred_0") + F.col("pred_1") + F.col("pred_2")).alias("n_rows"))


def _soft(spark, sf):
    vectors = adapters.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return scores.soft_match_score(adapters.articles(spark, sf, heavy=True), vectors, vectors.count())


def soft_match_score(spark, sf):
    return rounded(_soft(spark, sf))


def _density(source: str, eps: float, alpha: float, min_size: int, min_samples: int) -> str:
    """Flat density clusters: pairs, core distance, reachability, components."""
    return f"""RECURSIVE {POINTS},
pts AS (SELECT category, {source} AS v FROM points),
d AS (SELECT a.category AS a, b.category AS b, list_distance(a.v, b.v) AS d FROM pts a JOIN pts b ON a.category <> b.category),
core AS (SELECT a, d AS core FROM (SELECT a, d, row_number() OVER (PARTITION BY a ORDER BY d) AS k FROM d) WHERE k = {min_samples}),
reach AS (SELECT d.a, d.b, greatest(x.core, y.core, d.d / {alpha}::DOUBLE) AS r FROM d JOIN core x ON x.a = d.a JOIN core y ON y.a = d.b),
edges AS (SELECT a, b, r FROM reach WHERE r <= {eps}),
walk(a, b) AS (SELECT category, category FROM pts UNION SELECT walk.a, edges.b FROM walk JOIN edges ON walk.b = edges.a),
roots AS (SELECT a AS category, min(b) AS root FROM walk GROUP BY a),
sized AS (SELECT root, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM roots GROUP BY root HAVING count(*) >= {min_size}),
near AS (SELECT a AS category, min(r) AS r FROM edges GROUP BY a),
labels AS (SELECT category, coalesce(cluster, -1)::INT AS cluster, coalesce(min(r) OVER (PARTITION BY cluster) / r, 0.0) AS p
           FROM roots LEFT JOIN sized USING (root) LEFT JOIN near USING (category)),
final AS (SELECT category, cluster, CASE WHEN cluster = -1 THEN 0.0::DOUBLE ELSE p END AS probability FROM labels)"""


def _labels(source: str, setting: dict, column: str) -> str:
    body = _density(source, setting["eps"], setting["alpha"], setting["min_size"], setting["min_samples"])
    return f"WITH {body} SELECT category, {column} FROM final"


PROJECTED = "[" + ", ".join(f"list_dot_product(vector, {signs}::DOUBLE[])" for signs in SIGNS) + "]"
PROBABILITY = "round(probability, 6) AS probability"

SOFT = """tokens AS (
  SELECT article_id, side, ('0x' || substr(md5(w), 1, 8))::BIGINT % (SELECT count(*) FROM embeddings) AS vec_id
  FROM (SELECT article_id, 'g' AS side, unnest(regexp_split_to_array(lower(generated), '\\s+')) AS w FROM articles
        UNION ALL SELECT article_id, 's', unnest(regexp_split_to_array(lower(source), '\\s+')) FROM articles) WHERE w <> ''),
counted AS (SELECT article_id, side, vec_id, count(*) AS n FROM tokens GROUP BY ALL),
cosines AS (SELECT a.vec_id AS i, b.vec_id AS j, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c FROM embeddings a, embeddings b),
best AS (SELECT x.article_id, x.side, x.vec_id, x.n, max(c) AS m FROM counted x JOIN counted y ON x.article_id = y.article_id AND x.side <> y.side
         JOIN cosines ON i = x.vec_id AND j = y.vec_id GROUP BY ALL),
pr AS (SELECT article_id, coalesce(sum(m * n) FILTER (side = 'g') / sum(n) FILTER (side = 'g'), 0) AS precision,
              coalesce(sum(m * n) FILTER (side = 's') / sum(n) FILTER (side = 's'), 0) AS recall FROM articles LEFT JOIN best USING (article_id) GROUP BY article_id),
soft AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pr)"""

def _linked(number: int, threshold: float) -> str:
    """Points less their components: the edges that a spanning forest within the threshold has."""
    return f"""SELECT {number}::INT AS threshold, count(*) - count(DISTINCT root) AS n_edges FROM (
  WITH RECURSIVE {POINTS},
  pts AS (SELECT category, {PROJECTED} AS v FROM points),
  near AS (SELECT a.category AS a, b.category AS b FROM pts a JOIN pts b ON a.category <> b.category AND list_distance(a.v, b.v) <= {threshold}),
  walk(a, b) AS (SELECT category, category FROM pts UNION SELECT walk.a, near.b FROM walk JOIN near ON walk.b = near.a)
  SELECT a, min(b) AS root FROM walk GROUP BY a)"""


INFORMATION = f"""tokens AS (
  SELECT review_id, list_filter(string_split(p, ' '), lambda x: x <> '') AS w FROM (SELECT review_id, {NORMAL} AS p FROM reviews)),
apart AS (SELECT w, unnest([1, 2]) AS d FROM tokens),
near AS (SELECT w[i] AS x, w[i + d] AS y FROM (SELECT w, d, unnest(range(1, len(w) - d + 1)) AS i FROM apart)),
pairs AS (SELECT a, b, count(*) AS n FROM (SELECT x AS a, y AS b FROM near UNION ALL SELECT y, x FROM near) GROUP BY a, b),
often AS (SELECT a AS word FROM pairs GROUP BY a HAVING sum(n) >= 200),
kept AS (SELECT * FROM pairs WHERE a IN (SELECT word FROM often) AND b IN (SELECT word FROM often)),
single AS (SELECT a AS word, sum(n) AS n FROM kept GROUP BY a),
information AS (
  SELECT a, b, log2(kept.n::DOUBLE * (SELECT sum(n) FROM single) / (x.n::DOUBLE * y.n::DOUBLE)) AS weight
  FROM kept JOIN single x ON x.word = a JOIN single y ON y.word = b)"""

CASES = {
    "category_vectors": (
        category_vectors,
        "SELECT label AS category, (dim - 1)::INT AS dim, round(avg(x), 6) AS value FROM"
        " (SELECT label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings) GROUP BY label, dim",
    ),
    "category_text_vectors": (category_text_vectors, None),
    "reduce_dims": (reduce_dims, None),
    "density_cluster": (density_cluster, _labels("vector", FULL, "cluster")),
    "density_cluster_flat": (density_cluster_flat, _labels(PROJECTED, FLAT, "cluster")),
    "density_cluster_denser": (density_cluster_denser, _labels(PROJECTED, DENSER, "cluster")),
    "membership_probability": (membership_probability, _labels("vector", FULL, PROBABILITY)),
    "membership_probability_flat": (membership_probability_flat, _labels(PROJECTED, FLAT, PROBABILITY)),
    "silhouette_samples": (
        silhouette_samples,
        points("SELECT category, cluster, round(silhouette, 6) AS silhouette FROM silhouettes", SILHOUETTE),
    ),
    "silhouette_centroid": (
        silhouette_centroid,
        points(
            "SELECT category, cluster, round(CASE WHEN n = 1 OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END, 6) AS silhouette FROM near",
            """flat AS (SELECT cluster, unnest(vector) AS x, generate_subscripts(vector, 1) AS d FROM points),
mean AS (SELECT cluster, list(c ORDER BY d) AS centroid FROM (SELECT cluster, d, avg(x) AS c FROM flat GROUP BY cluster, d) GROUP BY cluster),
size AS (SELECT cluster, count(*) AS n FROM points GROUP BY cluster),
gaps AS (SELECT p.category, p.cluster, m.cluster AS other, list_distance(p.vector, m.centroid) AS d FROM points p, mean m),
near AS (SELECT category, cluster, any_value(n) AS n, min(d) FILTER (other = cluster) AS a, min(d) FILTER (other <> cluster) AS b
         FROM gaps JOIN size USING (cluster) GROUP BY category, cluster)""",
        ),
    ),
    "silhouette_score": (
        silhouette_score,
        points(
            "SELECT round(avg(silhouette), 6) AS silhouette FROM silhouettes",
            SILHOUETTE.replace("points a JOIN points b ON", "points a JOIN points b ON a.cluster <> -1 AND b.cluster <> -1 AND"),
        ),
    ),
    "calinski_harabasz": (
        calinski_harabasz,
        points(
            "SELECT round((b.v / (k - 1)) / (w.v / (n - k)), 6) AS calinski_harabasz FROM between_sum b, within_sum w, size",
            """real AS (SELECT * FROM points WHERE cluster <> -1),
flat AS (SELECT cluster, unnest(vector) AS x, generate_subscripts(vector, 1) AS d FROM real),
mean AS (SELECT cluster, d, avg(x) AS c, count(*) AS m FROM flat GROUP BY cluster, d),
centre AS (SELECT d, avg(x) AS c FROM flat GROUP BY d),
between_sum AS (SELECT sum(m * (mean.c - centre.c) * (mean.c - centre.c)) AS v FROM mean JOIN centre USING (d)),
within_sum AS (SELECT sum((x - c) * (x - c)) AS v FROM flat JOIN mean USING (cluster, d)),
size AS (SELECT count(DISTINCT cluster) AS k, count(*) AS n FROM real)""",
        ),
    ),
    "davies_bouldin": (davies_bouldin, f"WITH {POINTS}, {DAVIES} SELECT davies_bouldin FROM davies"),
    "cluster_categories": (cluster_categories, None),
    "cluster_tree": (cluster_tree, None),
    "cluster_tree_validity": (cluster_tree_validity, None),
    "spanning_tree": (spanning_tree, " UNION ALL ".join(_linked(i, t) for i, t in enumerate(THRESHOLDS))),
    "project_categories": (project_categories, None),
    "word_information": (word_information, text("SELECT a, b, round(weight, 6) AS weight FROM information WHERE weight > 0", INFORMATION)),
    "category_word_vectors": (category_word_vectors, None),
    "apply_saved_model": (apply_saved_model, "SELECT count(*) AS n, 0::BIGINT AS n_different FROM embeddings"),
    "train_sentiment": (train_sentiment, None),
    "predict_sentiment": (predict_sentiment, None),
    "select_model": (select_model, None),
    "sentiment_job": (
        sentiment_job,
        text(
            """SELECT label, greatest(0, least(20, n - 120))::BIGINT AS n_rows FROM (VALUES (0), (1), (2)) v(label)
LEFT JOIN (SELECT CASE WHEN rating IN (1, 2) THEN 0 WHEN rating = 3 THEN 1 ELSE 2 END AS label, count(*) AS n
           FROM reviews WHERE rating BETWEEN 1 AND 5 GROUP BY 1) USING (label)"""
        ),
    ),
    "soft_match_score": (
        soft_match_score,
        written(
            "SELECT article_id, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM soft", SOFT
        ),
    ),
}
