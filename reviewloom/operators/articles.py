"""Scores of generated articles. One article is one row; nothing is grouped across
articles before its score is known."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.contracts import ARTICLE_SECTIONS
from reviewloom.functions.hashing import hash_bucket
from reviewloom.functions.text import extract_products, header_lines, required_sections, words
from reviewloom.operators.joins import product_overlap

MEASURES = ["accuracy", "precision", "recall", "f1"]


def _safe(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _safe(2 * precision * recall, precision + recall)


def section_metrics(
    articles: DataFrame, text: str = "generated", sections=ARTICLE_SECTIONS, clamp: bool = False
) -> DataFrame:
    """How well an article keeps to the required sections.

    Precision divides the sections found by the number of lines ending in a colon.
    It can exceed 1, because a section line may go on after its colon; ``clamp``
    limits it to 1.
    """
    found = F.size(required_sections(F.col(text), sections)).cast("double")
    headers = header_lines(F.col(text)).cast("double")
    recall = found / F.lit(float(len(sections)))
    precision = _safe(found, headers)
    if clamp:
        precision = F.least(F.lit(1.0), precision)
    scored = articles.withColumn("accuracy", recall).withColumn("precision", precision).withColumn("recall", recall)
    return scored.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def product_metrics(articles: DataFrame, generated: str = "generated", source: str = "source") -> DataFrame:
    """Agreement of the products named in an article with those of its source."""
    named = articles.withColumn("_g", extract_products(F.col(generated))).withColumn(
        "_s", extract_products(F.col(source))
    )
    sets = product_overlap(named, "_g", "_s")
    tp, fp, fn = (F.size(c).cast("double") for c in ("shared", "only_generated", "only_source"))
    scored = (
        sets.withColumn("accuracy", _safe(tp, tp + fn))
        .withColumn("precision", _safe(tp, tp + fp))
        .withColumn("recall", _safe(tp, tp + fn))
    )
    out = scored.withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    return out.drop("_g", "_s", "shared", "only_generated", "only_source")


def token_vectors(
    articles: DataFrame, vectors: DataFrame, buckets: int, key: str = "article_id",
    generated: str = "generated", source: str = "source",
) -> DataFrame:
    """Distinct tokens of both sides of each article with their counts and vectors.

    A token's vector is the one at the bucket its digest falls into. Tokens are
    counted before the vectors join, so each vector travels once per article.
    """

    def side(column: str, name: str) -> Column:
        tokens = words(F.lower(F.col(column)))
        pair = F.transform(tokens, lambda t: F.struct(F.lit(name).alias("side"), hash_bucket(t, buckets).alias("vec_id")))
        return pair

    both = F.concat(side(generated, "generated"), side(source, "source"))
    long = articles.select(key, F.explode(both).alias("t")).select(key, "t.side", "t.vec_id")
    counts = long.groupBy(key, "side", "vec_id").agg(F.count("*").alias("n"))
    return counts.join(vectors.select("vec_id", "vector"), "vec_id")


def _match_block(tokens: pa.Table) -> pa.Table:
    """Greedy cosine matching inside one article, in slices of the longer side."""
    flat = tokens["vector"].combine_chunks().flatten().to_numpy().astype(np.float64)
    vec = flat.reshape(tokens.num_rows, -1)
    norm = np.linalg.norm(vec, axis=1, keepdims=True)
    unit = vec / np.where(norm == 0, 1.0, norm)
    is_gen = tokens["generated"].to_numpy()
    n = tokens["n"].to_numpy().astype(np.float64)
    gen, src = unit[is_gen], unit[~is_gen]
    precision = recall = 0.0
    if len(gen) and len(src):
        best_src = np.full(len(src), -np.inf)
        best_gen = np.empty(len(gen))
        step = max(1, 4_000_000 // len(src))
        for at in range(0, len(gen), step):
            cosine = gen[at : at + step] @ src.T
            best_gen[at : at + step] = cosine.max(axis=1)
            best_src = np.maximum(best_src, cosine.max(axis=0))
        precision = float(best_gen @ n[is_gen] / n[is_gen].sum())
        recall = float(best_src @ n[~is_gen] / n[~is_gen].sum())
    return pa.table({"key": tokens["key"].slice(0, 1), "precision": [precision], "recall": [recall]})


def soft_match_score(
    articles: DataFrame, vectors: DataFrame, buckets: int, key: str = "article_id",
    generated: str = "generated", source: str = "source",
) -> DataFrame:
    """Mean best cosine of generated tokens (precision) and of source tokens (recall).

    The vocabulary bounds one article's matching: it has at most ``buckets`` distinct
    tokens per side. An article without tokens on one side scores 0.
    """
    tokens = token_vectors(articles, vectors, buckets, key, generated, source)
    kind = dict(articles.dtypes)[key]
    scored = (
        tokens.select(F.col(key).alias("key"), (F.col("side") == "generated").alias("generated"), "n", "vector")
        .groupBy("key")
        .applyInArrow(_match_block, f"key {kind}, precision double, recall double")
        .withColumnRenamed("key", key)
    )
    full = articles.select(key).join(scored, key, "left").na.fill(0.0, ["precision", "recall"])
    return full.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def evaluation_long(parts: dict[str, DataFrame], key: str = "article_id") -> DataFrame:
    """Scores of several kinds in long form: ``key, kind, metric, value``."""
    out = None
    for kind, df in parts.items():
        measures = [m for m in MEASURES if m in df.columns]
        long = df.unpivot([key], measures, "metric", "value").withColumn("kind", F.lit(kind))
        out = long if out is None else out.unionByName(long)
    return out.select(key, "kind", "metric", "value")


def evaluation_table(parts: dict[str, DataFrame], key: str = "article_id") -> DataFrame:
    """Mean scores as a matrix: one row per metric, one column per kind."""
    long = evaluation_long(parts, key)
    cells = [F.avg(F.when(F.col("kind") == k, F.col("value"))).alias(k) for k in parts]
    return long.groupBy("metric").agg(*cells)
