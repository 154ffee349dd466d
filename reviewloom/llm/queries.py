"""One query per operator over its whole table, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewloom.llm import (
    balltree, crossparse, density, fertility, laesa, minhash, mixing, rans, recurrent, toxicity, urlrules, warc, winnow, wordids,
)
from reviewloom.llm.common import held_out, table


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(table(spark, folder, "pages"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    held = held_out(F.col("doc_id"), 4, 2)
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), held)


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"))


def op4_fertility(spark: SparkSession, folder: str) -> DataFrame:
    measured = fertility.fertility(table(spark, folder, "documents"), wordids.vocabulary("piece_bpe_32k.model"))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", "n_byte_tokens", "chars_per_token", "byte_share", "entropy", "script",
    )


def op5_crossparse(spark: SparkSession, folder: str) -> DataFrame:
    return crossparse.identify(table(spark, folder, "documents"), held_out(F.col("doc_id"), 4, 2))


def op6_winnow(spark: SparkSession, folder: str) -> DataFrame:
    return winnow.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_rans(spark: SparkSession, folder: str) -> DataFrame:
    return rans.token_files(table(spark, folder, "documents"), wordids.vocabulary("word_bpe_49k.json"))


def op7_urlrules(spark: SparkSession, folder: str) -> DataFrame:
    return urlrules.judge_urls(table(spark, folder, "pages"), table(spark, folder, "labels"))


def op8_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), minhash.MinHash(shingle=4, percent=80))


def op10_recurrent(spark: SparkSession, folder: str) -> DataFrame:
    return recurrent.score_texts(table(spark, folder, "documents"), held_out(F.col("doc_id"), 10, 0))


def op11_laesa(spark: SparkSession, folder: str) -> DataFrame:
    return laesa.vector_codes(table(spark, folder, "embeddings"))


def op12_balltree(spark: SparkSession, folder: str) -> DataFrame:
    return balltree.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_density(spark: SparkSession, folder: str) -> DataFrame:
    return density.extract_pages(table(spark, folder, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_fertility": op4_fertility,
    "op5_crossparse": op5_crossparse,
    "op6_winnow": op6_winnow,
    "op7_urlrules": op7_urlrules,
    "op8_minhash": op8_minhash,
    "op9_rans": op9_rans,
    "op10_recurrent": op10_recurrent,
    "op11_laesa": op11_laesa,
    "op12_balltree": op12_balltree,
    "op13_density": op13_density,
}

OP8_SQL = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words),
grams AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)"""

OP6_SQL = r"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
items AS MATERIALIZED (
  SELECT item_id, w, least(len(w), 10) AS m FROM (
    SELECT item_id, list_filter(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark) WHERE len(w) > 0),
passages AS MATERIALIZED (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS p
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM items)),
places AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS p
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM docs, (SELECT DISTINCT m FROM items) WHERE len(w) >= m)),
hits AS MATERIALIZED (SELECT doc_id, m, i, item_id FROM places JOIN passages USING (m, p)),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM hits) GROUP BY 1),
listed AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS l FROM hits GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_hit, coalesce(len(l), 0) AS n_items,
       sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)"""

OP1_SQL = """
WITH rows AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages),
digests AS (
  SELECT page_id, url, payload_bytes,
         array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '')
           AS payload_digest
  FROM rows)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to, url
FROM (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM digests)"""

OP7_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
addresses AS MATERIALIZED (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query
  FROM cut),
tokens AS MATERIALIZED (
  SELECT page_id, list_distinct(
           list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x)
           || list_transform(list_filter(string_split(regexp_replace(path, '[0-9]+', '0', 'g'), '/'), lambda x: x <> ''), lambda x: 'p:' || x)
           || list_transform(list_filter(list_transform(string_split(query, '&'), lambda x: string_split(x, '=')[1]), lambda x: x <> ''), lambda x: 'q:' || x)
         ) AS t
  FROM addresses),
marked AS (SELECT doc_id AS page_id, max((coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0)::INT) AS bad FROM labels GROUP BY 1),
baskets AS MATERIALIZED (SELECT page_id, bad, t FROM tokens JOIN marked USING (page_id) WHERE len(t) > 0 OR bad = 1),
least AS (SELECT ceil(0.01 * count(*)) AS n FROM baskets),
single AS MATERIALIZED (SELECT page_id, bad, unnest(t) AS x FROM baskets),
ones AS (SELECT x AS a, x AS b FROM single GROUP BY x
  HAVING sum(bad) >= (SELECT n FROM least) AND sum(bad) > 0 AND 2 * sum(bad) >= count(*) + 10),
twos AS (SELECT p.x AS a, q.x AS b FROM single p JOIN single q ON p.page_id = q.page_id AND p.x < q.x
  GROUP BY p.x, q.x HAVING sum(p.bad) >= (SELECT n FROM least) AND sum(p.bad) > 0 AND 2 * sum(p.bad) >= count(*) + 10),
rules AS (SELECT * FROM ones UNION ALL SELECT * FROM twos WHERE a NOT IN (SELECT a FROM ones) AND b NOT IN (SELECT a FROM ones)),
fired AS (SELECT DISTINCT page_id FROM tokens JOIN rules ON list_contains(t, a) AND list_contains(t, b)),
given(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                          ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fixed AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM addresses JOIN given ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN fired.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM addresses LEFT JOIN fixed USING (page_id) LEFT JOIN fired USING (page_id)"""


def _op11_sql(rounds: int = 6) -> str:
    """Every round as two more tables: parts with their nearest entry, and the new codebooks."""
    near = """n{k} AS MATERIALIZED (
  SELECT vec_id, label, p, x, min(struct_pack(d := d, e := e)) AS best FROM (
    SELECT vec_id, label, p, x, e, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d
    FROM parts JOIN b{k} USING (p)) GROUP BY ALL)"""
    book = """b{next} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(list(m ORDER BY i) FILTER (m IS NOT NULL), any_value(b.c)) AS c
  FROM b{k} b LEFT JOIN (
    SELECT p, e, i, (s - ((s % n) + n) % n) // n AS m FROM (
      SELECT p, best.e AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n
      FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i FROM n{k}) GROUP BY ALL)) USING (p, e)
  GROUP BY b.p, b.e)"""
    steps = [near.format(k=0)]
    for k in range(rounds):
        steps += [book.format(k=k, next=k + 1), near.format(k=k + 1)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS x FROM kept, range(8) AS t(p)),
b0 AS MATERIALIZED (
  SELECT p, e, c FROM (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts) WHERE e < 16),
{", ".join(steps)},
coded AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
  FROM n{rounds} GROUP BY vec_id, label),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, book"""


OP12_SQL = r"""
WITH terms AS MATERIALIZED (
  SELECT doc_id, unnest(list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS t
  FROM documents),
wanted AS MATERIALIZED (
  SELECT item_id, t, count(*) AS qf FROM (
    SELECT item_id, unnest(list_filter(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS t
    FROM benchmark) GROUP BY ALL),
lengths AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths),
freq AS MATERIALIZED (SELECT doc_id, t, count(*) AS tf FROM terms SEMI JOIN wanted USING (t) GROUP BY ALL),
weight AS (
  SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM freq GROUP BY t), total),
impact AS (
  SELECT doc_id, t, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // words))) AS v
  FROM freq JOIN lengths USING (doc_id), total),
scores AS (
  SELECT item_id, doc_id, sum(qf * w * v)::BIGINT AS score
  FROM wanted JOIN weight USING (t) JOIN impact USING (t) GROUP BY ALL HAVING sum(qf * w * v) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores QUALIFY rank <= 20"""

ORACLE_SQL: dict[str, str] = {
    "op1_warc": OP1_SQL, "op6_winnow": OP6_SQL, "op7_urlrules": OP7_SQL, "op8_minhash": OP8_SQL,
    "op11_laesa": _op11_sql(), "op12_balltree": OP12_SQL,
}
