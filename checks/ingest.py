"""Sources, sinks and ingest state."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from checks.base import POINTS, rank, rounded, text
from reviewloom.operators import validity
from reviewloom.sources import adapters, examples, ledger, reviews, sinks
from reviewloom.staging import fresh_path

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def scan_reviews(spark, sf):
    return reviews.scan_reviews(spark, [f"{sf}/documents.parquet"], DOCUMENT)


def ingest_category(spark, sf):
    docs = scan_reviews(spark, sf).withColumn("rating", (F.length("text") % 6).cast("double"))
    return reviews.ingest_category(docs, reviews.category_of_file(), ["text", "rating", "asin"])


def _configs(spark, sf):
    source = adapters.table(spark, sf, "documents").select("source").distinct()
    both = F.array(F.concat(F.lit("raw_review_"), "source"), F.concat(F.lit("raw_meta_"), "source"))
    return source.select(F.explode(both).alias("config_name"))


def list_categories(spark, sf):
    return reviews.list_categories(_configs(spark, sf))


def write_table(spark, sf):
    rows = adapters.text_reviews(spark, sf)
    back = sinks.write_table(rows, fresh_path(spark, "write"), ["split", "category"])
    return back.select("review_id", "split", "category", "rating", "text")


def write_table_again(spark, sf):
    """A second table over a first one with other partitions: nothing of the first stays."""
    rows = adapters.text_reviews(spark, sf)
    path = fresh_path(spark, "write")
    sinks.write_table(rows, path, ["split", "category"])
    back = sinks.write_table(rows.where("split <> 'val'"), path, ["split", "category"])
    return back.select("review_id", "split", "category")


def write_metrics(spark, sf):
    metrics = rounded(validity.davies_bouldin(adapters.category_points(spark, sf)))
    as_csv = sinks.write_metrics(metrics, fresh_path(spark, "csv"), "csv")
    as_json = sinks.write_metrics(metrics, fresh_path(spark, "json"), "json")
    return as_csv.withColumn("fmt", F.lit("csv")).unionByName(as_json.withColumn("fmt", F.lit("json")))


def _names(spark, sf):
    return adapters.table(spark, sf, "documents").select(F.col("source").alias("name"))


def _done(names):
    """Names that count as processed, chosen by digest."""
    return names.distinct().where(F.substring(F.md5("name"), 1, 1) < "8")


def pending_files(spark, sf):
    names = _names(spark, sf)
    return ledger.pending_files(names, _done(names))


def ledger_totals(spark, sf):
    path = fresh_path(spark, "ledger")
    counts = _names(spark, sf).groupBy("name").agg(F.count("*").alias("n_rows"))
    ledger.record_progress(spark, path, counts.join(_done(_names(spark, sf)), "name", "left_semi"))
    book = ledger.record_progress(spark, path, counts)
    return ledger.ledger_summary(book).drop("last_updated")


def _places(spark, sf):
    name = _names(spark, sf).distinct().select(F.col("name").alias("category"))
    digit = F.substring(F.md5("category"), 1, 1)
    return name, name.where(digit < "a"), name.where(digit > "4"), name.where(digit < "8")


def reconcile_categories(spark, sf):
    return ledger.reconcile_categories(*_places(spark, sf))


def reconcile_counts(spark, sf):
    return ledger.reconcile_counts(reconcile_categories(spark, sf))


def publish_validated(spark, sf):
    rows = adapters.text_reviews(spark, sf)
    # copies without text make one category unfit
    spoiled = rows.withColumn("text", F.when((F.col("category") == "de") & (F.col("rating") == 0), "").otherwise(F.col("text")))
    target = fresh_path(spark, "published")
    report = sinks.publish_validated(spoiled, target)
    stored = spark.read.parquet(target).groupBy("category").agg(F.count("*").alias("n_stored"))
    return report.join(stored, "category", "left").na.fill(0, ["n_stored"])


def publish_null_key(spark, sf):
    """Rows without a category are rejected, and said to be."""
    rows = adapters.text_reviews(spark, sf).withColumn("category", F.when(F.col("category") != "fr", F.col("category")))
    target = fresh_path(spark, "published")
    report = sinks.publish_validated(rows, target)
    stored = spark.read.parquet(target).groupBy("category").agg(F.count("*").alias("n_stored"))
    return report.join(stored, "category", "left").na.fill(0, ["n_stored"]).select("category", "n_rows", "published", "n_stored")


def ingest_totals(spark, sf):
    return reviews.ingest_totals(adapters.text_reviews(spark, sf))


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def file_row_report(spark, sf):
    return reviews.file_row_report(spark, sf)


_PLACE = """docs AS (SELECT DISTINCT source AS category, substr(md5(source), 1, 1) AS d FROM documents),
state AS (SELECT category, true AS in_all, d < 'a' AS in_backup, d > '4' AS in_local, d < '8' AS in_ledger FROM docs),
flags AS (SELECT *, in_all AND NOT in_backup AS remaining, in_local AND NOT in_backup AS local_only,
                 in_backup AND NOT in_ledger AS unlisted FROM state)"""


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_EXAMPLES = "examples(meta_category, output) AS (VALUES " + ", ".join(
    f"({meta}, {_quoted(output)})" for meta, output in examples.example_rows()
) + ")"

_SPOILED = """spoiled AS (SELECT category, CASE WHEN category = 'de' AND rating = 0 THEN '' ELSE text END AS text FROM reviews),
checked AS (SELECT category, count(*) AS n_rows,
                   sum(CASE WHEN text IS NULL OR text = '' THEN 1 ELSE 0 END)::BIGINT AS n_bad_text
            FROM spoiled GROUP BY category)"""

DAVIES = """real AS (SELECT * FROM points WHERE cluster <> -1),
flat AS (SELECT cluster, category, unnest(vector) AS x, generate_subscripts(vector, 1) AS d FROM real),
mean AS (SELECT cluster, d, avg(x) AS c FROM flat GROUP BY cluster, d),
gap AS (SELECT f.cluster, f.category, sqrt(sum((x - c) * (x - c))) AS r
        FROM flat f JOIN mean m ON f.cluster = m.cluster AND f.d = m.d GROUP BY f.cluster, f.category),
scatter AS (SELECT cluster, avg(r) AS s FROM gap GROUP BY cluster),
apart AS (SELECT a.cluster AS i, b.cluster AS j, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS m
          FROM mean a JOIN mean b ON a.d = b.d AND a.cluster <> b.cluster GROUP BY i, j),
worst AS (SELECT i, max((x.s + y.s) / m) AS w FROM apart JOIN scatter x ON x.cluster = i JOIN scatter y ON y.cluster = j GROUP BY i),
davies AS (SELECT round(avg(w), 6) AS davies_bouldin FROM worst)"""

CASES = {
    "scan_reviews": (scan_reviews, "SELECT doc_id, text, lang, source, n_chars FROM documents"),
    "ingest_category": (
        ingest_category,
        "SELECT text, (length(text) % 6)::DOUBLE AS rating, 'documents' AS category FROM documents",
    ),
    "list_categories": (list_categories, "SELECT DISTINCT source AS category FROM documents"),
    "write_table": (write_table, text("SELECT review_id, split, category, rating, text FROM reviews")),
    "write_metrics": (
        write_metrics,
        f"WITH {POINTS}, {DAVIES} SELECT davies_bouldin, 'csv' AS fmt FROM davies UNION ALL SELECT davies_bouldin, 'json' FROM davies",
    ),
    "pending_files": (
        pending_files,
        "SELECT DISTINCT source AS name FROM documents WHERE NOT substr(md5(source), 1, 1) < '8'",
    ),
    "ledger_totals": (
        ledger_totals,
        "SELECT count(DISTINCT source) AS n_completed, count(*) AS total_rows FROM documents",
    ),
    "reconcile_categories": (reconcile_categories, f"WITH {_PLACE} SELECT * FROM flags"),
    "reconcile_counts": (
        reconcile_counts,
        f"WITH {_PLACE} SELECT "
        + ", ".join(
            f"count(*) FILTER ({c}) AS n_{c}"
            for c in ["in_all", "in_backup", "in_local", "in_ledger", "remaining", "local_only", "unlisted"]
        )
        + " FROM flags",
    ),
    "publish_validated": (
        publish_validated,
        text(
            "SELECT category, n_rows, n_bad_text, n_bad_text = 0 AS published,"
            " CASE WHEN n_bad_text = 0 THEN n_rows ELSE 0 END AS n_stored FROM checked",
            _SPOILED,
        ),
    ),
    "publish_null_key": (
        publish_null_key,
        text(
            "SELECT nullif(category, 'fr') AS category, count(*) AS n_rows, bool_and(category <> 'fr') AS published,"
            " count(*) FILTER (category <> 'fr') AS n_stored FROM reviews GROUP BY 1"
        ),
    ),
    "write_table_again": (
        write_table_again,
        text("SELECT review_id, split, category FROM reviews WHERE split <> 'val'"),
    ),
    "ingest_totals": (
        ingest_totals,
        text(
            "SELECT category, count(*) AS n_reviews,"
            " (sum(count(*)) OVER (ORDER BY category))::BIGINT AS running_total FROM reviews GROUP BY category"
        ),
    ),
    "file_row_report": (
        file_row_report,
        " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name, count(*) AS n_rows FROM {t}" for t in TABLES),
    ),
}
