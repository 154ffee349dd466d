"""Products of a sparse matrix with a few dense columns, and their small Gram matrices.

A matrix is a table ``a, b, weight``, or :class:`PairTiles`; columns are doubles of a table with one
row per ``key``. A product is a join and a sum per row. Only numbers counted by columns reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.operators.wordpairs import PairTiles
from reviewloom.staging import settle


def column_names(prefix: str, n: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(n)]


def product(matrix: DataFrame | PairTiles, vectors: DataFrame, columns: list[str]) -> DataFrame:
    """The matrix times the columns; rows of the matrix without an entry are absent."""
    if isinstance(matrix, PairTiles):
        return matrix.times(vectors, columns)
    ends = matrix.join(vectors.select(F.col("key").alias("b"), *columns), "b")
    return ends.groupBy(F.col("a").alias("key")).agg(*[F.sum(F.col("weight") * F.col(c)).alias(c) for c in columns])


def gram(rows: DataFrame, one: list[str], two: list[str]) -> np.ndarray:
    """Inner products of columns."""
    row = rows.agg(*[F.sum(F.col(a) * F.col(b)) for a in one for b in two]).first()
    return np.array([x or 0.0 for x in row]).reshape(len(one), len(two))


def mixed(columns: list[str], weights: np.ndarray) -> list[Column]:
    """New columns of the same names, each a weighted sum of all."""
    names = columns[: weights.shape[1]]
    return [sum((F.col(c) * float(w) for c, w in zip(columns, weights[:, i])), F.lit(0.0)).alias(name) for i, name in enumerate(names)]


def orthonormal(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Make the columns orthonormal; directions that the columns do not span become 0."""
    scale = np.sqrt(np.maximum(np.diag(gram(rows, columns, columns)), 1e-300))
    rows = rows.select("key", *[(F.col(c) / float(s)).alias(c) for c, s in zip(columns, scale)])
    size, turn = np.linalg.eigh(gram(rows, columns, columns))
    good = size > max(size.max(), 1e-300) * 1e-12
    return rows.select("key", *mixed(columns, np.where(good, turn / np.sqrt(np.where(good, size, 1.0)), 0.0)))


def eigenpairs(matrix: DataFrame | PairTiles, rows: DataFrame, columns: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix within the span of orthonormal columns, and the weights of
    the columns that give the eigenvectors."""
    image = product(matrix, rows, columns).select("key", *[F.col(c).alias(f"i_{c}") for c in columns])
    small = gram(rows.join(image, "key"), columns, [f"i_{c}" for c in columns])
    return np.linalg.eigh((small + small.T) / 2)


def random_columns(rows: DataFrame, columns: list[str], seed: int, name: str = "key") -> DataFrame:
    """Reproducible columns of random numbers in -1 to 1, drawn by ``name``."""
    draw = lambda c: F.xxhash64(F.lit(f"{seed}:{c}"), name) / F.lit(float(1 << 63))
    return rows.select("key", *[draw(c).alias(c) for c in columns])


def leading_eigenvectors(
    matrix: DataFrame | PairTiles, rank: int, spare: int = 6, rounds: int = 3, seed: int = 42, names: DataFrame | None = None
) -> tuple[DataFrame, np.ndarray]:
    """``key, x0..`` and the eigenvalues of largest size of a symmetric matrix, by random projection.

    Random columns are multiplied by the matrix twice in each round, which favours what is
    large, and made orthonormal; the small matrix in their span gives the eigenvectors.
    ``names`` (``key, word``) tells what the random numbers of a coded key are drawn by.
    """
    columns = column_names("x", rank + spare)
    if isinstance(matrix, PairTiles):
        drawn = random_columns(matrix.words, columns, seed, "word")
    else:
        keys = settle(matrix.select(F.col("a").alias("key")).distinct(), "keys")
        drawn = random_columns(keys, columns, seed) if names is None else random_columns(keys.join(names, "key"), columns, seed, "word")
    step = lambda rows: settle(rows, "range", compact=True)
    now = step(orthonormal(step(product(matrix, drawn, columns)), columns))
    for _ in range(rounds):
        once = step(product(matrix, now, columns))
        now = step(orthonormal(step(product(matrix, once, columns)), columns))
    values, turn = eigenpairs(matrix, now, columns)
    order = np.argsort(-np.abs(values))[:rank]
    return now.select("key", *mixed(columns, turn[:, order])), values[order]
