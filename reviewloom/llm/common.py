"""Vectorised text helpers shared by the operators: words, hashes, shingles, splits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word is a longest run of characters other than these six; as a Java pattern.
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
_BASE, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPAN = 1 << 20
_powers: list[np.ndarray] = []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(text, UPPER, LOWER)


def held_out(key: Column, modulus: int, remainder: int) -> Column:
    """True for rows that no model may learn from; a null id is hashed as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(modulus)) == remainder


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a whole string column and the offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def pieces(offsets: np.ndarray, limit: int = _SPAN) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes; a longer row stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = max(first + 1, min(last, n))
        yield first, last
        first = last


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, _SPAN + 4096)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        up, down = np.full(size, _BASE), np.full(size, inverse)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up), np.cumprod(down)]
    return _powers[0], _powers[1]


def word_spans(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and per row the number of words before it.

    ``between`` marks the byte values that separate words.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~between[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: a polynomial over random byte values, finalised."""
    out, first = np.empty(len(starts), np.uint64), 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + _SPAN, "right")))
        high = ends[last - 1]
        up, down = _power_tables(int(high - low) + 1)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTES[data[low:high]] * up[: high - low], out=total[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased if ``fold``) and the word offsets of the rows."""
    data = FOLD[data] if fold else data
    starts, ends, at = word_spans(data, offsets)
    return hash_spans(data, starts, ends), at


def windows(hashes: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``k`` words from each position; True where they lie in one row."""
    n = len(hashes)
    padded = np.concatenate([hashes, np.zeros(k - 1, np.uint64)])
    value = padded[:n].copy()
    for i in range(1, k):
        value = value * _BASE + padded[i : n + i]
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    return mix(value + np.uint64(k)), np.arange(n) + k <= at[1:][row]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct ``k``-word shingles of each row, as 64-bit hashes with offsets.

    A row of fewer words, but not none, has one shingle: its whole sequence.
    """
    hashes, at = word_hashes(data, offsets)
    value, whole = windows(hashes, at, k)
    counts = np.diff(at)
    for row in np.flatnonzero((counts > 0) & (counts < k)):
        one, _ = windows(hashes[at[row] : at[row + 1]], np.array([0, counts[row]]), int(counts[row]))
        value[at[row]], whole[at[row]] = one[0], True
    bounds = np.concatenate([[0], np.cumsum(whole)])[at]
    value = value[whole]
    for a, b in zip(bounds[:-1], bounds[1:]):
        value[a:b].sort()
    fresh = np.ones(len(value), bool)
    fresh[1:] = value[1:] != value[:-1]
    fresh[bounds[:-1][counts > 0]] = True
    return value[fresh], np.concatenate([[0], np.cumsum(fresh)])[bounds]


def binaries(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """One binary value per row from a flat array and its offsets."""
    raw = np.ascontiguousarray(values).view(np.uint8)
    offsets = pa.py_buffer((at * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, offsets, pa.py_buffer(raw)])


def longs(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit hashes as the signed type that Spark knows."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))
