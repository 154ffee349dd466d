"""SQL of the adapters and small helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, so that summation order does not show."""
    return df.select([F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


TEXT = """reviews AS (
  SELECT doc_id AS review_id,
         CASE WHEN source = 'src0' THEN 'Unknown' ELSE lang END AS category,
         'P' || (doc_id % 40) AS asin,
         (length(text) % 6)::DOUBLE AS rating,
         n_chars % 50 AS helpful_vote,
         text,
         CASE doc_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'val' ELSE 'train' END AS split
  FROM documents)"""

RANK = """reviews AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::DATE - DATE '1970-01-01') AS review_id,
         CASE WHEN p_type = 'ECONOMY' THEN '[UNKNOWN]' ELSE p_type END AS category,
         l_partkey AS asin,
         p_size % 5 AS meta_category,
         (l_quantity::INT % 5 + 1)::DOUBLE AS rating,
         floor(l_extendedprice)::BIGINT % 100 AS helpful_vote,
         'order ' || l_orderkey || ' line ' || l_linenumber || ' ' || l_returnflag || l_linestatus AS text
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

POINTS = """points AS (
  SELECT 'cat' || lpad(vec_id::VARCHAR, 9, '0') AS category,
         embedding::DOUBLE[] AS vector,
         CASE WHEN embedding[1]::DOUBLE < -0.15 THEN -1 ELSE label % 7 END AS cluster,
         round(least(1.0::DOUBLE, abs(embedding[2]::DOUBLE) * 6), 4) AS probability
  FROM embeddings)"""

PREDICTIONS = """guesses AS (
  SELECT id, label, CASE WHEN id % 5 = 0 THEN (label + 1) % 3 ELSE label END AS prediction
  FROM (SELECT doc_id AS id, CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 ELSE 2 END AS label
        FROM labels JOIN documents USING (doc_id)))"""

ARTICLES = """articles AS (
  SELECT u.conv_id || '-' || u.turn AS article_id,
         (u.conv_id % 5)::INT AS meta_category,
         CASE WHEN u.conv_id % 4 <> 0 THEN 'Title:' || chr(10) ELSE '' END
         || CASE WHEN (u.conv_id + 1) % 4 <> 0 THEN 'Introduction: as follows' || chr(10) ELSE '' END
         || CASE WHEN (u.conv_id + 2) % 4 <> 0 THEN 'TOP 3 RECOMMENDED PRODUCTS:' || chr(10) ELSE '' END
         || CASE WHEN (u.conv_id + 3) % 4 <> 0 THEN 'WORST PRODUCT WARNING: as follows' || chr(10) ELSE '' END
         || CASE WHEN (u.conv_id + 4) % 4 <> 0 THEN 'Final Verdict:' || chr(10) ELSE '' END
         || '1. Item ' || (u.conv_id % 3) || ' Key Strengths: solid' || chr(10)
         || 'Product: P' || (u.conv_id % 7) || chr(10)
         || 'Product: P' || (u.conv_id % 5) || chr(10)
         || '• Extra ' || u.turn || ' Key Strengths: light' || chr(10)
         || a.text AS generated,
         'Product: P' || (u.conv_id % 7) || chr(10)
         || '1. Item ' || (u.conv_id % 3) || ' Key Strengths: solid' || chr(10)
         || u.text AS source
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

NAMES = """names(meta_category, name) AS (VALUES
  (0, 'Entertainment & General Retail'), (1, 'Technology & Automotive'), (2, 'Industrial & DIY'),
  (3, 'Health & Beauty'), (4, 'Home & Garden'))"""

PRODUCTS = """named AS (
  SELECT article_id, list_distinct(list_concat(
           list_transform(regexp_extract_all(generated, '(?i)\\d\\.\\s*([^.]+?)\\s*Key Strengths:', 1), lambda x: trim(x)),
           list_transform(regexp_extract_all(generated, '(?i)Product:\\s*([^\\n]+)', 1), lambda x: trim(x)),
           list_transform(regexp_extract_all(generated, '(?i)•\\s*([^.]+?)\\s*Key Strengths:', 1), lambda x: trim(x)))) AS g,
         list_distinct(list_concat(
           list_transform(regexp_extract_all(source, '(?i)\\d\\.\\s*([^.]+?)\\s*Key Strengths:', 1), lambda x: trim(x)),
           list_transform(regexp_extract_all(source, '(?i)Product:\\s*([^\\n]+)', 1), lambda x: trim(x)),
           list_transform(regexp_extract_all(source, '(?i)•\\s*([^.]+?)\\s*Key Strengths:', 1), lambda x: trim(x)))) AS s
  FROM articles)"""


def text(select: str, *more: str) -> str:
    return "WITH " + ",\n".join([TEXT, *more]) + "\n" + select


def rank(select: str, *more: str) -> str:
    return "WITH " + ",\n".join([RANK, *more]) + "\n" + select


def points(select: str, *more: str) -> str:
    return "WITH " + ",\n".join([POINTS, *more]) + "\n" + select


def guesses(select: str, *more: str) -> str:
    return "WITH " + ",\n".join([PREDICTIONS, *more]) + "\n" + select


def written(select: str, *more: str) -> str:
    return "WITH " + ",\n".join([ARTICLES, *more]) + "\n" + select
