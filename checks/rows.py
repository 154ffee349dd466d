"""Row filters, labels, checks and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import PRODUCTS, rank, rounded, text, written
from reviewloom import functions as fn
from reviewloom.functions.text import computed_once
from reviewloom.operators import quality
from reviewloom.operators.stats import product_stats
from reviewloom.plans import prepare as plans
from reviewloom.sources import adapters

ID = ["review_id", "split", "category", "rating"]


def reviews(spark, sf):
    return adapters.text_reviews(spark, sf)


def long_texts(spark, sf):
    """The same rows, spread over all cores for costly work on their texts."""
    return adapters.text_reviews(spark, sf, heavy=True)


def valid_reviews(spark, sf):
    return quality.valid_reviews(reviews(spark, sf)).select(*ID)


def clean_raw(spark, sf):
    return quality.clean_raw(reviews(spark, sf)).select(*ID)


def drop_empty_processed(spark, sf):
    rows = computed_once(long_texts(spark, sf), "processed_text", fn.normalize_text(F.col("text")))
    return quality.drop_empty_processed(rows).select("review_id", "processed_text")


def min_words(spark, sf):
    rows = computed_once(long_texts(spark, sf), "processed_text", fn.normalize_text(F.col("text")))
    return quality.min_words(rows, 40).select("review_id", fn.count_words(F.col("processed_text")).cast("bigint").alias("n_words"))


def dedup_reviews(spark, sf):
    return quality.dedup_reviews(reviews(spark, sf)).select(*ID)


def relabel_unknown(spark, sf):
    return quality.relabel_unknown(reviews(spark, sf)).select("review_id", "category")


def sentiment_label(spark, sf):
    return quality.sentiment_label(reviews(spark, sf)).select("review_id", "rating", "sentiment")


def encode_label(spark, sf):
    return quality.encode_label(quality.sentiment_label(reviews(spark, sf))).select("review_id", "sentiment", "label")


def check_integrity(spark, sf):
    rows = reviews(spark, sf)
    strict = quality.check_integrity(rows, "strict").withColumn("mode", F.lit("strict"))
    loose = quality.check_integrity(rows.drop("category"), "rowcount").withColumn("mode", F.lit("rowcount"))
    return strict.unionByName(loose)


def verify_splits(spark, sf):
    rows = computed_once(long_texts(spark, sf), "processed_text", fn.redact_text(F.col("text")))
    return rounded(quality.verify_splits(rows))


def preprocess_dataset(spark, sf):
    pages = adapters.page_reviews(spark, sf, heavy=True)
    return quality.preprocess_dataset(pages).select("review_id", "processed_text")


def normalize_text(spark, sf):
    return long_texts(spark, sf).select("review_id", fn.normalize_text(F.col("text")).alias("processed_text"))


def redact_text(spark, sf):
    pages = adapters.page_reviews(spark, sf, heavy=True)
    return pages.select("review_id", fn.redact_text(F.col("text")).alias("processed_text"))


SELECTORS = (("h1", None), ("title", None))


def product_title(spark, sf):
    pages = adapters.page_reviews(spark, sf, heavy=True)
    return pages.select("asin", fn.product_title(F.col("text"), F.col("asin"), SELECTORS).alias("name"))


def extract_products(spark, sf):
    found = fn.extract_products(F.col("generated"))
    return adapters.articles(spark, sf).select("article_id", F.array_join(F.array_sort(found), "|").alias("products"))


def encode_tokens(spark, sf):
    ids, mask = fn.encode_tokens(F.col("text"), 256)
    return long_texts(spark, sf).select(
        "review_id", F.array_join(ids, ",").alias("input_ids"), F.array_join(mask, ",").alias("attention_mask")
    )


def required_sections(spark, sf):
    return adapters.articles(spark, sf).select(
        "article_id", F.array_join(fn.required_sections(F.col("generated")), "|").alias("sections")
    )


def header_lines(spark, sf):
    return adapters.articles(spark, sf).select(
        "article_id", fn.header_lines(F.col("generated")).cast("bigint").alias("n_headers")
    )


def number_formats(spark, sf):
    stats = product_stats(adapters.ranked_reviews(spark, sf))
    return stats.select(
        "asin",
        fn.one_decimal(F.col("mean_rating")).alias("mean_text"),
        fn.thousands(F.col("helpful_votes") * 100).alias("votes_text"),
        fn.percent(F.col("mean_rating") / 5, 1).alias("share_text"),
        F.round("mean_rating", 6).alias("mean_rating"),
    )


def prepare_normalized(spark, sf):
    return plans.prepare(long_texts(spark, sf).drop("split"), "normalized", frac=None).select(*ID, "processed_text")


def prepare_redacted(spark, sf):
    return plans.prepare(long_texts(spark, sf).drop("split"), "redacted", frac=None).select(*ID, "processed_text", "sentiment")


NORMAL = (
    "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text),"
    " '<[^>]+>', ' ', 'g'), '(http|www)\\S+', '', 'g'), '\\S+@\\S+', '', 'g'),"
    " '[^a-zA-Z\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
)


def redacted(column: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({column},"
        " '<[^>]+>', ' ', 'g'), 'https?://\\S+', '[URL]', 'g'),"
        " '[\\pL\\pN_.-]+@[\\pL\\pN_.-]+', '[EMAIL]', 'g'), '\\s+', ' ', 'g'))"
    )


def heading(tag: str) -> str:
    inner = f"regexp_replace(regexp_extract(html, '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}\\s*>', 1), '<[^>]+>', '', 'g')"
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")]:
        inner = f"replace({inner}, '{entity}', '{char}')"
    return f"nullif(regexp_replace({inner}, '^\\s+|\\s+$', '', 'g'), '')"


SENTIMENT = (
    "CASE WHEN rating IN (1, 2) THEN 'Negative' WHEN rating = 3 THEN 'Neutral'"
    " WHEN rating IN (4, 5) THEN 'Positive' END"
)
WORDS = "list_filter(regexp_split_to_array({}, '\\s+'), lambda w: w <> '')"
KEYS = "review_id, split, category, rating"

# Parts of a stratified split: sizes, then quotas by largest remainder, then ranks.
SPLIT = """sizes AS (SELECT rating, count(*) AS n FROM pool GROUP BY rating),
whole AS (SELECT sum(n)::DOUBLE AS total FROM sizes),
test_exact AS (SELECT rating, n, total, n * ceil(greatest(0.1::DOUBLE, 3.0::DOUBLE / total) * total) / total AS e FROM sizes, whole),
test_floor AS (SELECT *, floor(e) AS f, e - floor(e) AS r FROM test_exact),
test_rank AS (SELECT *, row_number() OVER (ORDER BY r DESC, rating) AS k,
                     ceil(greatest(0.1::DOUBLE, 3.0::DOUBLE / total) * total) - sum(f) OVER () AS spare FROM test_floor),
test_quota AS (SELECT rating, n, total, (f + CASE WHEN k <= spare THEN 1 ELSE 0 END)::BIGINT AS n_test FROM test_rank),
rest AS (SELECT *, n - n_test AS l, sum(n - n_test) OVER ()::DOUBLE AS left_all FROM test_quota),
val_want AS (SELECT *, ceil(greatest(0.1::DOUBLE, 3.0::DOUBLE / total) / (1.0::DOUBLE - greatest(0.1::DOUBLE, 3.0::DOUBLE / total)) * left_all) AS want FROM rest),
val_floor AS (SELECT *, floor(l * want / left_all) AS f, l * want / left_all - floor(l * want / left_all) AS r FROM val_want),
val_rank AS (SELECT *, row_number() OVER (ORDER BY r DESC, rating) AS k, want - sum(f) OVER () AS spare FROM val_floor),
quota AS (SELECT rating, n_test, (f + CASE WHEN k <= spare THEN 1 ELSE 0 END)::BIGINT AS n_val FROM val_rank),
ranked AS (SELECT pool.*, row_number() OVER (PARTITION BY rating ORDER BY md5('42:' || review_id), review_id) AS pos FROM pool),
parted AS (SELECT ranked.* EXCLUDE (pos), CASE WHEN pos <= n_test THEN 'test' WHEN pos <= n_test + n_val THEN 'val' ELSE 'train' END AS split
           FROM ranked JOIN quota USING (rating))"""

_BARE = "bare AS (SELECT * EXCLUDE (split) FROM reviews)"
_VALID = "rating BETWEEN 1 AND 5 AND text IS NOT NULL AND length(text) > 0"

CASES = {
    "valid_reviews": (valid_reviews, text(f"SELECT {KEYS} FROM reviews WHERE {_VALID}")),
    "clean_raw": (
        clean_raw,
        text(f"SELECT {KEYS} FROM reviews WHERE (split <> 'train' OR rating > 0) AND text IS NOT NULL AND length(text) > 4"),
    ),
    "drop_empty_processed": (
        drop_empty_processed,
        text(f"SELECT * FROM (SELECT review_id, {NORMAL} AS processed_text FROM reviews) WHERE length(processed_text) > 0"),
    ),
    "min_words": (
        min_words,
        text(f"SELECT * FROM (SELECT review_id, len({WORDS.format(NORMAL)})::BIGINT AS n_words FROM reviews) WHERE n_words >= 40"),
    ),
    "dedup_reviews": (
        dedup_reviews,
        text(
            f"SELECT {KEYS} FROM (SELECT *, row_number() OVER (PARTITION BY split, text, rating, category"
            " ORDER BY review_id) AS rn FROM reviews) WHERE rn = 1"
        ),
    ),
    "relabel_unknown": (
        relabel_unknown,
        text("SELECT review_id, CASE WHEN category = 'Unknown' THEN '[UNKNOWN]' ELSE category END AS category FROM reviews"),
    ),
    "sentiment_label": (sentiment_label, text(f"SELECT review_id, rating, {SENTIMENT} AS sentiment FROM reviews")),
    "encode_label": (
        encode_label,
        text(
            "SELECT review_id, sentiment, CASE sentiment WHEN 'Negative' THEN 0 WHEN 'Neutral' THEN 1"
            f" WHEN 'Positive' THEN 2 END AS label FROM (SELECT review_id, {SENTIMENT} AS sentiment FROM reviews)"
        ),
    ),
    "check_integrity": (
        check_integrity,
        text(
            "SELECT count(*) AS n_rows, sum(CASE WHEN text IS NULL OR text = '' THEN 1 ELSE 0 END)::BIGINT AS n_bad_text,"
            " count(*) > 0 AND sum(CASE WHEN text IS NULL OR text = '' THEN 1 ELSE 0 END) = 0 AS ok, 'strict' AS mode FROM reviews"
            " UNION ALL SELECT count(*), sum(CASE WHEN text IS NULL OR text = '' THEN 1 ELSE 0 END)::BIGINT, count(*) > 0, 'rowcount' FROM reviews"
        ),
    ),
    "verify_splits": (
        verify_splits,
        text(
            "SELECT split, count(*) AS n_rows, sum(CASE WHEN p = '' THEN 1 ELSE 0 END)::BIGINT AS n_empty,"
            " round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share, sum(CASE WHEN p = '' THEN 1 ELSE 0 END) = 0 AS ok"
            f" FROM (SELECT split, {redacted('text')} AS p FROM reviews) GROUP BY split"
        ),
    ),
    "preprocess_dataset": (
        preprocess_dataset,
        f"SELECT * FROM (SELECT page_id AS review_id, {NORMAL.replace('text', 'html')} AS processed_text FROM pages)"
        f" WHERE len({WORDS.format('processed_text')}) >= 3",
    ),
    "normalize_text": (normalize_text, text(f"SELECT review_id, {NORMAL} AS processed_text FROM reviews")),
    "redact_text": (redact_text, f"SELECT page_id AS review_id, {redacted('html')} AS processed_text FROM pages"),
    "product_title": (
        product_title,
        f"SELECT page_id::VARCHAR AS asin, coalesce({heading('h1')}, {heading('title')}, 'Product ' || page_id) AS name FROM pages",
    ),
    "extract_products": (
        extract_products,
        written(
            "SELECT article_id, array_to_string(list_sort(g), '|') AS products FROM named",
            PRODUCTS,
        ),
    ),
    "encode_tokens": (
        encode_tokens,
        text(
            f"""SELECT review_id,
  array_to_string(list_concat(list_transform(kept, lambda w: ('0x' || substr(md5(w), 1, 8))::BIGINT % 50000 + 1),
                              list_transform(range(256 - len(kept)), lambda x: 0::BIGINT)), ',') AS input_ids,
  array_to_string(list_concat(list_transform(kept, lambda w: 1), list_transform(range(256 - len(kept)), lambda x: 0)), ',') AS attention_mask
FROM (SELECT review_id, {WORDS.format('text')}[1:256] AS kept FROM reviews)"""
        ),
    ),
    "required_sections": (
        required_sections,
        written(
            "SELECT article_id, array_to_string(list_filter(['Title:', 'Introduction:', 'TOP 3 RECOMMENDED PRODUCTS:',"
            " 'WORST PRODUCT WARNING:', 'Final Verdict:'], lambda s: contains(lower(generated), lower(s))), '|') AS sections FROM articles"
        ),
    ),
    "header_lines": (
        header_lines,
        written(
            "SELECT article_id, len(list_filter(string_split(generated, chr(10)), lambda x: ends_with(x, ':')))::BIGINT AS n_headers FROM articles"
        ),
    ),
    "number_formats": (
        number_formats,
        rank(
            "SELECT asin, printf('%.1f', round(avg(rating), 1)) AS mean_text,"
            " format('{:,}', (sum(helpful_vote) * 100)::BIGINT) AS votes_text,"
            " printf('%.1f%%', round(avg(rating) / 5 * 100, 1)) AS share_text,"
            " round(avg(rating), 6) AS mean_rating FROM reviews GROUP BY asin"
        ),
    ),
    "prepare_normalized": (
        prepare_normalized,
        text(
            f"SELECT {KEYS}, processed_text FROM parted",
            _BARE,
            f"pool AS (SELECT * FROM (SELECT *, {NORMAL} AS processed_text FROM bare WHERE {_VALID})"
            f" WHERE len({WORDS.format('processed_text')}) >= 3)",
            SPLIT,
        ),
    ),
    "prepare_redacted": (
        prepare_redacted,
        text(
            "SELECT review_id, split, CASE WHEN category = 'Unknown' THEN '[UNKNOWN]' ELSE category END AS category, rating,"
            f" processed_text, {SENTIMENT} AS sentiment FROM (SELECT *, {redacted('text')} AS processed_text,"
            " row_number() OVER (PARTITION BY split, text, rating, category ORDER BY review_id) AS rn"
            " FROM parted WHERE (split <> 'train' OR rating > 0) AND length(text) > 4)"
            " WHERE rn = 1 AND length(processed_text) > 0",
            _BARE,
            f"pool AS (SELECT * FROM bare WHERE {_VALID})",
            SPLIT,
        ),
    ),
}
