"""Vector codes by product quantisation, with LAESA pivots in every assignment.

A vector is cut into equal parts; each part position has a codebook, and a vector's code
names the nearest entry of every part. The distances of each part to a few fixed pivots are
computed once and stored. In each round only the distances between pivots and entries are
new: by the triangle inequality their differences are lower bounds, which order the entries
of a part and prune most of the exact integer evaluations. A task returns sums per entry, so
nothing but the codebooks passes through the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewloom.shipping import ship
from reviewloom.staging import settle

HEAVY = 1000  # a label with over 1/HEAVY of all rows is frequent; so there are fewer than HEAVY


@dataclass(frozen=True)
class Codes:
    """Parameters: parts of a vector, entries of a codebook (256 at most), rounds, pivots, scale."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    pivots: int = 8
    scale: int = 4096


def integer_vectors(embeddings: DataFrame, how: Codes, vector: str = "embedding") -> DataFrame | None:
    """vec_id, label and ``ints``, of equal lengths; None if no row has a usable vector.

    Rows whose vector is null or holds a null or non-finite component go. Shorter vectors,
    and lengths that the parts do not divide, are filled up with zeros at the end. Components
    so large that squared distances could leave 64 bits count as the largest allowed (beyond
    8,000 even for 1,000 dimensions).
    """
    value = F.col(vector).cast("array<double>")
    usable = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = embeddings.select("vec_id", "label", value.alias("ints")).where(F.col("ints").isNotNull() & usable)
    longest = rows.agg(F.max(F.size("ints"))).first()[0]
    if longest is None:
        return None
    length = max(1, -(-longest // how.parts)) * how.parts
    most = float(math.isqrt((1 << 62) // length) // 2)
    whole = F.transform("ints", lambda x: F.floor(F.greatest(F.least(x * how.scale, F.lit(most)), F.lit(-most))))
    filled = F.slice(F.concat(whole, F.array_repeat(F.lit(0).cast("bigint"), length)), 1, length)
    return rows.select("vec_id", "label", filled.alias("ints"))


def first_entries(vectors: DataFrame, how: Codes) -> np.ndarray:
    """The parts of the least vec_ids, as (part, entry, place); null ids come last, ties by vector."""
    few = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(how.entries).collect()
    rows = np.array([r["ints"] for r in few], np.int64).reshape(len(few), how.parts, -1)
    return np.ascontiguousarray(rows.transpose(1, 0, 2))


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Per part, entries far from each other: each next pivot is the farthest from those before."""
    out = []
    for part in entries:
        chosen = [0]
        gap = np.full(len(part), np.inf)
        while len(chosen) < min(count, len(part)):
            gap = np.minimum(gap, np.square((part - part[chosen[-1]]).astype(float)).sum(axis=1))
            chosen.append(int(gap.argmax()))
        out.append(part[chosen])
    return np.stack(out)


def squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``left`` to all rows of ``right``."""
    out = np.empty((len(left), len(right)), np.int64)
    for column, one in enumerate(right):
        gap = left - one
        out[:, column] = np.einsum("ij,ij->i", gap, gap)
    return out


def nearest(part: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, from_pivots: np.ndarray):
    """Nearest entry of each row (ties: lower index), its squared distance, and evaluations made.

    ``to_pivots`` (rows, pivots) and ``from_pivots`` (pivots, entries) are distances. Entries
    are tried by rising lower bound; a row stops at the first bound that is above its best
    distance by more than rounding can explain.
    """
    low = np.abs(to_pivots[:, :1] - from_pivots[:1])
    for pivot in range(1, len(from_pivots)):
        np.maximum(low, np.abs(to_pivots[:, pivot : pivot + 1] - from_pivots[pivot]), out=low)
    order = low.argsort(axis=1, kind="stable")
    slack = 1e-9 + 1e-12 * (to_pivots.max(axis=1) + from_pivots.max())
    best = np.full(len(part), np.iinfo(np.int64).max)
    who = np.zeros(len(part), np.int64)
    alive, made = np.arange(len(part)), 0
    for step in range(len(entries)):
        entry = order[alive, step]
        go = low[alive, entry] - slack[alive] <= np.sqrt(best[alive].astype(float))
        alive, entry = alive[go], entry[go]
        if not len(alive):
            break
        gap = part[alive] - entries[entry]
        value = np.einsum("ij,ij->i", gap, gap)
        made += len(alive)
        better = (value < best[alive]) | ((value == best[alive]) & (entry < who[alive]))
        best[alive[better]], who[alive[better]] = value[better], entry[better]
    return who, best, made


def _rows(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """An array column whose rows have one length, as a matrix."""
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _measure(pivots: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Add the squared distances to the pivots: the only time a part meets them."""
    parts, count, _ = pivots.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cut = _rows(batch, "ints").reshape(batch.num_rows, parts, -1)
            gaps = np.hstack([squared(cut[:, p], pivots[p]) for p in range(parts)])
            at = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * (parts * count))
            columns = [*batch.columns, pa.ListArray.from_arrays(at, pa.array(gaps.reshape(-1)))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "ints", "pivots"])

    return run


def _assigned(batch: pa.RecordBatch, entries: np.ndarray, pivots: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per part: its number, the rows' parts, their entries and squared distances."""
    parts, count, _ = pivots.shape
    cut = _rows(batch, "ints").reshape(batch.num_rows, parts, -1)
    gaps = np.sqrt(_rows(batch, "pivots").reshape(batch.num_rows, parts, count).astype(float))
    for p in range(parts):
        between = np.sqrt(squared(pivots[p], entries[p]).astype(float))
        who, best, _ = nearest(cut[:, p], gaps[:, p], entries[p], between)
        yield p, cut[:, p], who, best


def _sums(entries: np.ndarray, pivots: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums and counts of the parts that go to each entry: a few rows for a whole task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, used = np.zeros_like(entries), np.zeros(entries.shape[:2], np.int64)
        for batch in batches:
            for p, rows, who, _ in _assigned(batch, entries, pivots) if batch.num_rows else ():
                np.add.at(total[p], who, rows)
                used[p] += np.bincount(who, minlength=len(used[p]))
        part, entry, place = np.indices(entries.shape).reshape(3, -1)
        seen = used[part, entry] > 0
        columns = [x[seen].astype(np.int32) for x in (part, entry, place)]
        columns += [total.reshape(-1)[seen], used[part, entry][seen]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "place", "total", "used"])

    return run


def _codes(entries: np.ndarray, pivots: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    digits = np.array([f"{i:02x}" for i in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code, error = np.full(batch.num_rows, "", dtype=f"U{2 * len(entries)}"), np.zeros(batch.num_rows, np.int64)
            for _, _, who, best in _assigned(batch, entries, pivots):
                code = np.char.add(code, digits[who])
                error += best
            columns = [batch.column(0), batch.column(1), pa.array(code.tolist(), pa.string()), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return run


def refine(points: DataFrame, entries: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floored mean of its parts; unused entries stay."""
    sums = points.mapInArrow(_sums(entries, pivots), "part int, entry int, place int, total bigint, used bigint")
    means = sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("used").alias("used"))
    new = entries.copy()
    for r in means.collect():  # as many rows as the codebooks have numbers
        new[r["part"], r["entry"], r["place"]] = r["total"] // r["used"]
    return new


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Add the errors summed over equal labels, nulls together.

    Sums of frequent labels (fewer than a thousand, whatever the table) are broadcast, so
    that their rows are not shuffled; the others are joined.
    """
    sums = coded.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"), F.count("*").alias("__rows"))
    sums = settle(sums, "label_errors")
    least = (sums.agg(F.sum("__rows")).first()[0] or 0) / HEAVY
    frequent = F.broadcast(sums.where(F.col("__rows") > least).drop("__rows"))
    same = F.col("label").eqNullSafe(F.col("__label"))
    rest = coded.join(frequent, same, "left_anti").join(sums.where(F.col("__rows") <= least).drop("__rows"), same)
    return coded.join(frequent, same).unionByName(rest).drop("__label")


def digest(entries: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, entries.reshape(-1).tolist())).encode()).hexdigest()


def compress(embeddings: DataFrame, how: Codes = Codes()) -> tuple[DataFrame, np.ndarray]:
    """Codes of all usable vectors (vec_id, label, code, error) and the final codebooks.

    Every usable row counts, repeated rows and null ids too. With fewer vectors than entries
    the codebooks are as long as there are vectors. Other columns are ignored; without a
    usable vector the result and the codebooks are empty.
    """
    spark = embeddings.sparkSession
    kinds = dict(embeddings.dtypes)
    head = f"vec_id {kinds['vec_id']}, label {kinds['label']}"
    vectors = integer_vectors(embeddings, how)
    if vectors is None:
        return spark.createDataFrame([], f"{head}, code string, error bigint"), np.zeros((how.parts, 0, 0), np.int64)
    ship(spark)
    entries = first_entries(vectors, how)
    pivots = choose_pivots(entries, how.pivots)
    measured = vectors.mapInArrow(_measure(pivots), f"{head}, ints array<bigint>, pivots array<bigint>")
    points = settle(measured, "measured")
    for _ in range(how.rounds):
        new = refine(points, entries, pivots)
        if (new == entries).all():
            break
        entries = new
    coded = points.mapInArrow(_codes(entries, pivots), f"{head}, code string, error bigint")
    return settle(coded, "codes"), entries


def vector_codes(embeddings: DataFrame, how: Codes = Codes()) -> DataFrame:
    """vec_id, code, error, label_error and the digest of the codebooks; see :func:`compress`."""
    coded, entries = compress(embeddings, how)
    out = with_label_errors(coded).select("vec_id", "code", "error", "label_error")
    return out.withColumn("codebooks_sha256", F.lit(digest(entries)))
