"""Near-duplicate groups by MinHash signatures.

Every text becomes the set of its distinct word shingles and a signature of many
universal-hash minima, cut into bands. Texts with equal sets are one node. Nodes that share
a band form a bucket; buckets that overlap are joined to clusters, through the least node of
each bucket, so that no pairs are listed. Every link that the bands reveal lies inside a
cluster. A cluster is cut into tiles of bounded weight; a task verifies two tiles, first by
signatures, then on full sets, and returns a spanning forest of the links it finds.
Components, of buckets and of links, come from alternating large-star and small-star steps,
each written out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from reviewloom.llm.common import binaries, longs, mix, pieces, shingle_sets, text_bytes
from reviewloom.staging import settle


TILE = 1 << 19  # shingles that a task holds on either side


@dataclass(frozen=True)
class MinHash:
    """Parameters. With 48 bands of 6 a link at similarity 0.8 is missed once in two million."""

    shingle: int = 5
    percent: int = 80
    bands: int = 48
    rows: int = 6
    seed: int = 8

    def coefficients(self) -> tuple[np.ndarray, np.ndarray]:
        draw = np.random.default_rng(self.seed)
        n = self.bands * self.rows
        return draw.integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1), draw.integers(0, 2**64, n, dtype=np.uint64)

    @property
    def least_matches(self) -> int:
        """Equal minima, five standard deviations below what a link is expected to have."""
        n, p = self.bands * self.rows, self.percent / 100
        return int(n * p - 5 * (n * p * (1 - p)) ** 0.5)


def _minima(values: np.ndarray, at: np.ndarray, how: MinHash) -> np.ndarray:
    """One row per non-empty set: the least ``(a * x + b) >> 32`` over its shingles, for each (a, b)."""
    a, b = how.coefficients()
    starts = at[:-1]
    x = values >> np.uint64(32)
    out, work = np.empty((len(a), len(starts)), np.uint32), np.empty_like(x)
    for i in range(len(a)):
        np.multiply(x, a[i], out=work)
        np.add(work, b[i], out=work)
        out[i] = np.minimum.reduceat(work, starts) >> np.uint64(32)
    return out.T


def _texts(batches: Iterator[pa.RecordBatch], at: int, k: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with the shingle sets of their texts (column ``at``) and the sets' offsets."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(at))
        for first, last in pieces(offsets, 1 << 18):
            low = offsets[first]
            sets = shingle_sets(data[low : offsets[last]], offsets[first : last + 1] - low, k)
            yield batch.slice(first, last - first), *sets


def _sums(values: np.ndarray, at: np.ndarray) -> list[pa.Array]:
    """A 128-bit digest of each set: two sums over its members."""
    totals = [np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)]) for x in (values, mix(values))]
    return [longs(t[at[1:]] - t[at[:-1]]) for t in totals]


def _signer(how: MinHash) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values, at in _texts(batches, 1, how.shingle):
            full = np.flatnonzero(np.diff(at))
            keys = np.zeros((len(rows), how.bands), np.uint64)
            if len(full):
                minima = _minima(values, np.append(at[:-1][full], at[-1]), how)
                wide = minima.reshape(len(full), how.bands, how.rows).astype(np.uint64)
                key = np.broadcast_to(np.arange(1, how.bands + 1, dtype=np.uint64), wide.shape[:2])
                for i in range(how.rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, i])
                keys[full] = key
            step = pa.array(np.arange(0, (len(rows) + 1) * how.bands, how.bands, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(np.diff(at).astype(np.int64)),
                    *_sums(values, at),
                    pa.ListArray.from_arrays(step, longs(keys.ravel())),
                ],
                names=["doc_id", "n_shingles", "sum1", "sum2", "bands"],
            )

    return sign


def signatures(docs: DataFrame, how: MinHash) -> DataFrame:
    """Per row: doc_id, set size, node (a hash of the set's digest) and band keys."""
    schema = "doc_id long, n_shingles long, sum1 long, sum2 long, bands array<long>"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_signer(how), schema)
    return rows.select("doc_id", "n_shingles", _node().alias("id"), "bands")


def _node() -> Column:
    return F.xxhash64("sum1", "sum2", "n_shingles")


def _setter(how: MinHash) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts of seats to their sets, with a byte of each minimum."""
    width = how.bands * how.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values, at in _texts(batches, 5, how.shingle):
            full = np.flatnonzero(np.diff(at))
            small = np.zeros((len(rows), width), np.uint8)
            if len(full):
                small[full] = _minima(values, np.append(at[:-1][full], at[-1]), how).astype(np.uint8)
            columns = [*rows.columns[:5], pa.array(np.diff(at).astype(np.int64)), *_sums(values, at)]
            columns += [binaries(small.ravel(), np.arange(len(rows) + 1) * width), binaries(values, at)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _SEAT.split(", ")])

    return run


_SEAT = (
    "cluster long, one long, two long, tile long, id long, n_shingles long, sum1 long, sum2 long, "
    "signature binary, members binary"
)


def text_bytes_of(column: pa.Array) -> np.ndarray:
    """All bytes of a binary column without nulls."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]] if len(column) else np.zeros(0, np.uint8)


def _neighbourhood(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over edges (a > b): neighbours move to the least of the neighbourhood."""
    if small:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        kept = least.select("a", F.col("m").alias("b"))
        return moved.unionByName(kept).distinct()
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): each node but the least of its component, as (id, root).

    Alternates large-star and small-star until neither moves an edge. Each round halves
    the depth at least; every round is written out, so the lineage stays short.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    edges = settle(edges, "edges")
    print_of = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))]
    before = edges.agg(*print_of).first()
    while before[0]:
        edges = settle(_neighbourhood(_neighbourhood(edges, small=False), small=True), "edges")
        after = edges.agg(*print_of).first()
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, how: MinHash = MinHash()) -> DataFrame:
    """Group near duplicates of ``docs`` (doc_id, text): one row per input row.

    Columns: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept
    (doc_id = component_id). Empty and null texts have no shingle and link with nothing. A
    row with a null doc_id gets a null component, links with nothing and is kept. Rows that
    share a doc_id are one node, linked through any of their texts. Other columns of
    ``docs`` are ignored; an empty table gives an empty result.
    """
    base = settle(signatures(docs, how), "signed")
    solid = base.where("doc_id is not null and n_shingles > 0")
    links = settle(_links(docs, solid, how), "links")
    spread = solid.groupBy("doc_id").agg(F.min("id").alias("b"), F.max("id").alias("last")).where("b != last")
    same = solid.join(spread, "doc_id").select(F.col("id").alias("a"), "b")
    roots = settle(components(links.unionByName(same)), "roots")

    nodes = solid.select("doc_id", "id").join(roots, "id", "left")
    nodes = nodes.select("doc_id", F.coalesce("root", "id").alias("root"))
    crowds = settle(nodes.groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "components")
    known = base.select("doc_id", "n_shingles", "id").join(roots, "id", "left")
    known = known.withColumn("root", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("root", "id")))
    component = F.coalesce("least", "doc_id")
    return known.join(crowds.where("n > 1"), "root", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _links(docs: DataFrame, solid: DataFrame, how: MinHash) -> DataFrame:
    """Links between nodes, enough of them to connect all that are linked: (a, b)."""
    rows = solid.select(F.explode("bands").alias("key"), "id")
    bucket = rows.groupBy("key").agg(F.min("id").alias("b"), F.max("id").alias("last")).where("b != last")
    stars = rows.join(bucket.drop("last"), "key").where("id != b").select(F.col("id").alias("a"), "b").distinct()
    linked = settle(components(settle(stars, "stars")).toDF("id", "cluster"), "clusters")
    linked = linked.unionByName(linked.select(F.col("cluster").alias("id"), "cluster").distinct())
    heads = solid.groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("size"))
    place = heads.join(linked, "id")

    upto = W.partitionBy("cluster").orderBy("size", "id").rowsBetween(W.unboundedPreceding, -1)
    weight = F.greatest("size", F.lit(TILE // 1024))
    place = settle(place.withColumn("tile", F.floor(F.coalesce(F.sum(weight).over(upto), F.lit(0)) / TILE)), "place")
    tiles = place.groupBy("cluster", "tile").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    tiles = settle(tiles, "tiles")
    other = tiles.select("cluster", F.col("tile").alias("two"), F.col("low").alias("low2"))
    near = (F.col("tile") <= F.col("two")) & (F.col("high") * 100 >= F.col("low2") * how.percent)
    meet = settle(tiles.join(other, "cluster").where(near).select("cluster", F.col("tile").alias("one"), "two"), "meet")
    seats = meet.withColumn("tile", F.col("one")).unionByName(meet.where("one != two").withColumn("tile", F.col("two")))
    seats = settle(place.join(seats, ["cluster", "tile"]).select("cluster", "one", "two", "tile", "id", "doc_id"), "seats")

    # Seats grow with the corpus: they are never broadcast, whatever their size here.
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    texts = texts.join(seats.hint("merge"), "doc_id")
    copy = F.row_number().over(W.partitionBy("doc_id", "id", "one", "two", F.xxhash64("text")).orderBy(F.lit(0)))
    texts = texts.withColumn("copy", copy).where("copy = 1")  # a row that repeats id and text
    full = texts.select("cluster", "one", "two", "tile", "id", "text").mapInArrow(_setter(how), _SEAT)
    full = full.where(F.col("id") == _node()).drop("n_shingles", "sum1", "sum2")
    return full.groupBy("cluster", "one", "two").applyInArrow(_forest(how), "a long, b long")


def _forest(how: MinHash) -> Callable[[pa.Table], pa.Table]:
    """Compares the texts of two tiles (or of one with itself); links that join components."""
    width, least, percent = how.bands * how.rows, how.least_matches, how.percent

    def join_up(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        column = lambda name: rows.column(name).combine_chunks()
        ids, root = column("id").to_numpy(), np.arange(len(rows))
        second = column("tile").to_numpy() != column("one").to_numpy()
        signature = text_bytes_of(column("signature")).reshape(-1, width)
        values = text_bytes_of(column("members")).view(np.uint64)
        known, number = np.unique(values, return_inverse=True)
        sizes = np.array([len(m.as_buffer()) // 8 for m in column("members")], np.int64)
        ends = np.cumsum(sizes)
        mark, links = np.zeros(len(known), np.int64), []
        two = second.any()
        for i in np.flatnonzero(~second):
            fellows = np.flatnonzero(second) if two else np.arange(i + 1, len(ids))
            fellows = fellows[root[fellows] != root[i]]
            small, large = np.minimum(sizes[fellows], sizes[i]), np.maximum(sizes[fellows], sizes[i])
            fellows = fellows[small * 100 >= large * percent]
            fellows = fellows[(signature[fellows] == signature[i]).sum(axis=1) >= least]
            if not len(fellows):
                continue
            own = number[ends[i] - sizes[i] : ends[i]]
            mark[own] = 1
            both = np.array([mark[number[ends[j] - sizes[j] : ends[j]]].sum() for j in fellows])
            mark[own] = 0
            for j in fellows[100 * both >= percent * (sizes[i] + sizes[fellows] - both)]:
                if root[j] != root[i]:
                    links.append((ids[i], ids[j]))
                    root[root == root[j]] = root[i]
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return join_up
