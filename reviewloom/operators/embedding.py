"""Vectors from text: words by the company they keep, categories by their words.

Words that stand within a few words of each other are counted as pairs; the positive pointwise mutual
information of the pairs is a sparse symmetric matrix; its leading eigenvectors, found by
random projection, are the word vectors. A category's vector is the mean of its words'.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.functions.text import normalized_words
from reviewloom.operators.spectra import column_names, leading_eigenvectors
from reviewloom.operators.wordpairs import count_pairs
from reviewloom.staging import settle

EARLY = 500_000  # up to so many words, pairs are sifted before they are counted
KNOWN = 4_000_000  # up to so many words, every task can hold the codes of all

def neighbor_pairs(tokens: Column, window: int) -> Column:
    """All pairs of words at most ``window`` apart, each with the lesser word first."""

    def apart(by: int) -> Column:
        count = F.greatest(F.size(tokens) - by, F.lit(0))
        pair = lambda x, y: F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
        return F.zip_with(F.slice(tokens, 1, count), F.slice(tokens, 1 + by, count), pair)

    return F.concat(*[apart(by) for by in range(1, window + 1)])


def word_totals(tokens: DataFrame, window: int) -> tuple[DataFrame, Callable[[Column], Column]]:
    """``word, code, n`` of all words in the lists ``tokens``, with 64-bit codes and in how many pairs each stands,
    and the code of a list's item as a function of it.

    Codes are hashes; a seed is used under which no two words share one.
    """
    at = tokens.select(F.size("tokens").alias("size"), F.posexplode("tokens").alias("i", "word"))
    slots = F.least(F.lit(window), F.col("i")) + F.least(F.lit(window), F.col("size") - 1 - F.col("i"))
    totals = settle(at.groupBy("word").agg(F.sum(slots).alias("n")), "totals", compact=True)
    seed, count = 0, totals.count()
    while totals.select(F.xxhash64(F.lit(seed), "word")).distinct().count() < count:
        seed += 1
    code = lambda word: F.xxhash64(F.lit(seed), word)
    return totals.withColumn("code", code(F.col("word"))), code


def coded_pair_counts(reviews: DataFrame, text: str = "text", window: int = 5, min_count: int = 1) -> tuple[DataFrame, DataFrame]:
    """:func:`pair_counts` with the words as 64-bit codes, and ``word, code`` of the words.

    Only words that stand in ``min_count`` pairs or more are kept; the pairs of the others are not
    counted one by one.
    """
    tokens = listed_words(reviews, text)
    return _coded_counts(tokens, *word_totals(tokens, window), window, min_count)


def _coded_counts(tokens: DataFrame, totals: DataFrame, code: Callable[[Column], Column], window: int, min_count: int) -> tuple[DataFrame, DataFrame]:
    names = settle(totals.where(F.col("n") >= min_count).select("word", "code"), "words")
    pairs = tokens.select(F.explode(neighbor_pairs(F.transform("tokens", code), window)).alias("p")).select("p.a", "p.b")
    count = lambda rows: rows.groupBy("a", "b")
    often = lambda rows: rows.join(names.select(F.col("code").alias("a")), "a", "left_semi").join(
        names.select(F.col("code").alias("b")), "b", "left_semi"
    )
    if min_count <= 1:
        counted = count(pairs).agg(F.count("*").alias("n"))
    elif names.count() <= EARLY:
        counted = count(often(pairs)).agg(F.count("*").alias("n"))
    else:
        counted = often(count(pairs).agg(F.count("*").alias("n")))
    once = settle(counted.select("a", "b", "n"), "pairs")
    both = once.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "n")
    # a word beside itself is its neighbour in both directions
    own = F.when(F.col("a") == F.col("b"), 2 * F.col("n")).otherwise(F.col("n")).alias("n")
    return once.select("a", "b", own).unionByName(both), names


def named(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Replace the codes of ``a`` and ``b`` by their words."""
    word = lambda end: names.select(F.col("code").alias(end), F.col("word").alias(f"{end}_word"))
    both = rows.join(word("a"), "a").join(word("b"), "b")
    return both.select([F.col(f"{c}_word").alias(c) if c in ("a", "b") else F.col(c) for c in rows.columns])


def pair_counts(reviews: DataFrame, text: str = "text", window: int = 5) -> DataFrame:
    """``a, b, n`` in both directions: how often two words stand near each other.

    Null texts have no words. Counts are combined on the map side, so frequent pairs are few rows.
    """
    return named(*coded_pair_counts(reviews, text, window))


def mutual_information(pairs: DataFrame, min_count: int = 5) -> DataFrame:
    """``a, b, weight``: positive pointwise mutual information (bits) of words seen ``min_count`` times.

    Probabilities are taken over the pairs that are left without the rare words.
    """
    kept = pairs
    if min_count > 1:
        often = pairs.groupBy(F.col("a").alias("word")).agg(F.sum("n").alias("n")).where(F.col("n") >= min_count).select("word")
        often = settle(often, "words")
        kept = pairs.join(often.withColumnRenamed("word", "a"), "a", "left_semi").join(often.withColumnRenamed("word", "b"), "b", "left_semi")
        kept = settle(kept.select("a", "b", "n"), "kept")
    single = settle(kept.groupBy("a").agg(F.sum("n").alias("na")), "single")
    total = single.agg(F.sum("na")).scalar()
    rows = kept.join(single, "a").join(single.select(F.col("a").alias("b"), F.col("na").alias("nb")), "b")
    weight = F.log2(F.col("n").cast("double") * total / (F.col("na").cast("double") * F.col("nb")))
    return rows.select("a", "b", weight.alias("weight")).where("weight > 0")


def listed_words(reviews: DataFrame, text: str, *columns: Column) -> DataFrame:
    """``tokens``, the words of each text that is not null, beside the given columns."""
    return settle(reviews.where(F.col(text).isNotNull()).select(*columns, normalized_words(F.col(text)).alias("tokens")), "tokens", compact=True)


def word_vectors(reviews: DataFrame, text: str = "text", dims: int = 32, window: int = 5, min_count: int = 5) -> DataFrame:
    """``word, vector``: leading eigenvectors scaled by the roots of their eigenvalues."""
    return _vectors_of(listed_words(reviews, text), dims, window, min_count)


def _vectors_of(tokens: DataFrame, dims: int, window: int, min_count: int) -> DataFrame:
    totals, code = word_totals(tokens, window)
    often = settle(totals.where(F.col("n") >= min_count).select("word", "code", "n"), "words", compact=True)
    count, ends = often.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if count <= KNOWN:
        matrix = count_pairs(tokens, code, often.select("word", "code"), window, ends // 2)
        names = matrix.words
    else:
        pairs, names = _coded_counts(tokens, totals, code, window, min_count)
        matrix = settle(mutual_information(pairs, 1), "information", compact=True)
        names = names.select(F.col("code").alias("key"), "word")
    vectors, values = leading_eigenvectors(matrix, dims, names=names)
    scale = np.sqrt(np.abs(values))
    return vectors.join(names, "key").select("word", F.array(*[F.col(c) * float(s) for c, s in zip(column_names("x", dims), scale)]).alias("vector"))


def category_word_vectors(
    reviews: DataFrame, text: str = "text", group: str = "category", dims: int = 32, window: int = 5, min_count: int = 5
) -> DataFrame:
    """Mean vector of the known words of each category, each word as often as it occurs.

    Words are counted per category before they meet their vectors. A category without known
    words has a null vector.
    """
    tokens = listed_words(reviews, text, F.col(group).alias("_group"))
    vectors = settle(_vectors_of(tokens, dims, window, min_count), "word_vectors", compact=True)
    counted = tokens.select("_group", F.explode("tokens").alias("word")).groupBy("_group", "word").agg(F.count("*").alias("n"))
    parts = counted.join(vectors, "word")
    sums = [F.sum(F.col("n") * F.get("vector", F.lit(i))) / F.sum("n") for i in range(dims)]
    means = settle(parts.groupBy("_group").agg(F.array(*sums).alias("vector")), "means", compact=True)
    groups = reviews.select(group).distinct()
    return groups.join(means, F.col(group).eqNullSafe(F.col("_group")), "left").select(group, "vector")
