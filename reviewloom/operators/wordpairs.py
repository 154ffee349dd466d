"""Counts of words that stand near each other, packed in tiles, and products with their mutual information.

Known words are numbered in the order of their codes, and the numbers are cut into blocks. All pairs
of the words of two blocks lie in one tile, each pair once, as sorted offsets and counts of a few
bytes together. Each task sums its pairs before they move. A product hands every tile the rows of its
two blocks and gets one row per word and tile back; weights are taken from the counts each time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.staging import settle

BLOCK = 1 << 15  # words of a block at most; an offset within a tile has twice as many bits
LOAD = 16_000_000  # neighbours counted in one tile, about
HELD = 4_000_000  # pairs a task holds before it sums them
CHUNK = 1_000_000  # pairs of one packed value
STRETCH = 256  # words of a text that are looked at together


def pack(offsets: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising offsets below 2^32 and their counts, as planes of bytes."""
    gaps = np.diff(offsets, prepend=0).astype("<u4")
    planes = [x.view(np.uint8).reshape(len(x), -1).T.tobytes() for x in (gaps, counts.astype("<u8"))]
    return len(gaps).to_bytes(8, "little") + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=12 * n, codec="zstd", asbytes=True), np.uint8)
    gaps, counts = (x.reshape(-1, n).T.copy().view(kind).ravel() for x, kind in ((planes[: 4 * n], "<u4"), (planes[4 * n :], "<u8")))
    return np.cumsum(gaps, dtype=np.int64), counts.astype(np.int64)


def _packed(tile: int, offsets: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    for at in range(0, len(offsets), CHUNK):
        yield tile, pack(offsets[at : at + CHUNK], counts[at : at + CHUNK])


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[first], np.add.reduceat(counts[order], first)


def _rows(rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({"tile": pa.array([t for t, _ in rows], pa.int32()), "data": pa.array([x for _, x in rows], pa.binary())})


def _near(codes: pa.ListArray, known: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of known words at most ``window`` apart, the lesser first, a few stretches at a time.

    A pair belongs to the stretch in whose first ``STRETCH`` words it begins.
    """
    for at in range(0, len(codes), 2048):
        part = codes.slice(at, 2048)
        value = part.flatten().to_numpy(zero_copy_only=False)
        number = np.minimum(np.searchsorted(known, value), len(known) - 1)
        number = np.where(known[number] == value, number, -1)
        size = part.value_lengths().to_numpy(zero_copy_only=False)
        row, place = np.repeat(np.arange(len(size)), size), np.arange(len(value)) - np.repeat(np.cumsum(size) - size, size)
        for by in range(1, window + 1):
            one, two = number[:-by], number[by:]
            kept = (row[:-by] == row[by:]) & (place[:-by] < STRETCH) & (one >= 0) & (two >= 0)
            one, two = one[kept], two[kept]
            yield np.minimum(one, two), np.maximum(one, two)


class PairTiles:
    """The positive mutual information of known words as a symmetric matrix; see :func:`count_pairs`.

    ``words`` has ``key, word``, the numbers of the words; ``tiles`` the counts and, in a row of its
    own, what the words of a tile sum up to.
    """

    def __init__(self, words: DataFrame, tiles: DataFrame, width: int, side: int, total: int):
        self.words, self.tiles, self.width, self.side, self.total = words, tiles, width, side, total

    def times(self, vectors: DataFrame, columns: list[str]) -> DataFrame:
        """The matrix times the columns; rows of the matrix without an entry are absent."""
        width, side, total, rank = self.width, self.side, float(self.total), len(columns)

        def product(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            tile = key[0].as_py()
            bases = [tile // side * width, tile % side * width]
            same = bases[0] == bases[1]
            keys = right.column("key").to_numpy()
            given = np.stack([right.column(c).to_numpy() for c in columns], axis=1)
            value, there, out, met = ([np.zeros(shape, kind) for _ in bases] for shape, kind in (((rank, width), float), (width, bool), ((rank, width), float), (width, bool)))
            for base, x, has in zip(bases, value, there):
                inside = (keys >= base) & (keys < base + width)
                x[:, keys[inside] - base] = given[inside].T
                has[keys[inside] - base] = True
            chunks, sums = [], None
            for row, data in zip(left.column("sums").to_pylist(), left.column("data")):
                if row:
                    sums = np.frombuffer(pa.decompress(data.as_py(), decompressed_size=16 * width, codec="zstd", asbytes=True), "<i8").reshape(2, width)
                else:
                    chunks.append(data)
            for data in chunks:
                offsets, counts = unpack(data.as_py())
                ends = np.divmod(offsets, width)
                own = (ends[0] == ends[1]) & same
                counts[own] *= 2  # a word beside itself is its neighbour in both directions, but one entry
                singles = sums[0][ends[0]].astype(float) * sums[1][ends[1]].astype(float)
                weight = np.log2(counts.astype(float) * total / singles)
                kept = weight > 0
                ends, weight, own = [x[kept] for x in ends], weight[kept], own[kept]
                for to, by in ((0, 1), (1, 0)):
                    use = there[by][ends[by]] & ~(own & (to == 1))
                    a, b, w = ends[to][use], ends[by][use], weight[use]
                    met[to][a] = True
                    for x, y in zip(value[by], out[to]):
                        y += np.bincount(a, w * x[b], width)
            ids = [base + np.flatnonzero(x) for base, x in zip(bases, met)]
            found = np.concatenate([y[:, x] for y, x in zip(out, met)], axis=1)
            return pa.table({"key": pa.array(np.concatenate(ids), pa.int64()), **{c: pa.array(y) for c, y in zip(columns, found)}})

        ends = vectors.select("key", *columns).withColumn("tile", F.explode(_tiles_of(F.col("key"), width, side)))
        schema = ", ".join(["key bigint", *[f"{c} double" for c in columns]])
        parts = self.tiles.groupBy("tile").cogroup(ends.groupBy("tile")).applyInArrow(_where_both(product, schema), schema)
        return parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in columns])


def _tiles_of(key: Column, width: int, side: int) -> Column:
    """The tiles that the block of a number lies in."""
    own = F.floor(key / width).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(side - 1)), lambda j: F.least(own, j) * side + F.greatest(own, j))


def _where_both(block: Callable, schema: str) -> Callable:
    names = [x.split()[0] for x in schema.split(", ")]

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int64() if c == "key" else pa.float64()) for c in names})
        return block(key, left, right)

    return run


def count_pairs(tokens: DataFrame, code: Callable[[Column], Column], names: DataFrame, window: int, neighbours: int) -> PairTiles:
    """Count which words of ``names`` (``word, code``) stand near each other in the lists ``tokens``.

    ``neighbours`` is about how many pairs there are, for the size of tiles. The codes of the words,
    eight bytes each, go through the driver to every task.
    """
    spark = tokens.sparkSession
    known = np.sort(names.select("code").toArrow().column(0).to_numpy())
    side = max(1, math.ceil(len(known) / BLOCK), math.ceil(math.sqrt(2 * neighbours / LOAD)))
    width = max(1, math.ceil(len(known) / side))
    share = spark.sparkContext.broadcast(known)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(share.value, batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), batch.column(0)], ["key", "word"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for one, two in _near(batch.column(0), share.value, window):
                tile = one // width * side + two // width
                held.append(tile * (width * width) + one % width * width + two % width)
                if sum(map(len, held)) >= HELD:
                    yield from flushed(held)
                    held = []
        yield from flushed(held)

    def flushed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64),) * 2
        tile, offset = np.divmod(keys, width * width)
        cuts = np.flatnonzero(np.diff(tile)) + 1
        for t, o, n in zip(np.split(tile, cuts), np.split(offset, cuts), np.split(counts, cuts)):
            if len(t):
                yield from _rows(list(_packed(int(t[0]), o, n))).to_batches()

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        offsets, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for data in [*table.column("data"), None]:
            if data is not None:
                held.append(unpack(data.as_py()))
            if data is None or sum(len(x) for x, _ in held) >= max(HELD, len(offsets)):
                both = [(offsets, counts), *held]
                offsets, counts = _summed(*(np.concatenate([x[i] for x in both]) for i in (0, 1)))
                held = []
        return _rows(list(_packed(key[0].as_py(), offsets, counts)))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, data in zip(batch.column(0), batch.column(1)):
                offsets, counts = unpack(data.as_py())
                bases = [x * width for x in divmod(tile.as_py(), side)]
                for base, end in zip(bases, np.divmod(offsets, width)):
                    n = np.bincount(end, counts, width).astype(np.int64)
                    at = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([pa.array(base + at, pa.int64()), pa.array(n[at])], ["key", "n"])

    def laid(key: tuple, table: pa.Table) -> pa.Table:
        keys, n = (table.column(c).to_numpy() for c in ("key", "n"))
        out = np.ones((2, width), "<i8")
        for base, row in zip(divmod(key[0].as_py(), side), out):
            inside = keys // width == base
            row[keys[inside] - base * width] = n[inside]
        return _rows([(key[0].as_py(), pa.compress(out.tobytes(), codec="zstd", asbytes=True))])

    if not len(known):
        words = names.select(F.lit(0).cast("bigint").alias("key"), "word").where("false")
        return PairTiles(words, spark.createDataFrame([], "tile int, data binary, sums boolean"), width, side, 0)
    words = settle(names.select("word", "code").mapInArrow(numbered, "key bigint, word string"), "numbered", compact=True)
    last = F.greatest(F.size("tokens") - 1, F.lit(0))
    stretch = lambda i: F.transform(F.slice("tokens", i + 1, STRETCH + window), code)
    stretches = tokens.select(F.explode(F.transform(F.sequence(F.lit(0), last, F.lit(STRETCH)), stretch)).alias("codes"))
    parts = stretches.mapInArrow(counted, "tile int, data binary")
    tiles = settle(parts.groupBy("tile").applyInArrow(merged, "tile int, data binary"), "pairs", compact=True)
    single = settle(tiles.mapInArrow(summed, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")), "single", compact=True)
    total = single.agg(F.sum("n")).first()[0] or 0
    own = single.withColumn("tile", F.explode(_tiles_of(F.col("key"), width, side))).groupBy("tile").applyInArrow(laid, "tile int, data binary")
    own = settle(own, "sums", compact=True)
    both = tiles.withColumn("sums", F.lit(False)).unionByName(own.withColumn("sums", F.lit(True)))
    return PairTiles(words, both, width, side, total)
