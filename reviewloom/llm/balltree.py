"""Exact ranked search by inner product over ball trees of sparse documents.

Documents become sparse vectors of integer impacts over the terms of the items; an item is
a vector of integer weights, and a score is their inner product. Each task takes its
documents by falling length of the vector and builds a ball tree over every bounded chunk of them: a
node holds the centroid and the radius of its documents, over all terms and per term. No document
of a node scores above ``item . centroid + |item| * radius`` (Cauchy and Schwarz), nor above the
same with a radius per term; the lower bound counts, rounded up. Nodes are opened best first
and a subtree whose bound is below the item's last kept score is skipped. Leaves
are scored exactly in 64-bit integers. The kept scores go on from chunk to chunk, and a task
returns no more than its best documents of each item.

Items are taken in blocks of bounded size; all documents are read once per block.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from reviewloom.llm.common import FOLD, hash_spans, pieces, text_bytes, word_spans
from reviewloom.shipping import ship
from reviewloom.staging import settle

ITEMS, ITEM_BYTES = 512, 4 << 20  # most items, and bytes of their texts, in a block (one item at least)
CHUNK, CELLS, LEAF = 2048, 1 << 22, 8  # most documents and matrix cells of a tree, documents of a leaf
SKETCH, ROUND = 32, 1 + 1e-5  # coordinates for choosing cuts; more than single precision can err
LAST = 1 << 63  # stands for a missing doc_id: after all others
GROUPS = 64  # lists of different tasks that are merged first

# All that is not a letter or digit of ASCII, nor beyond ASCII, separates terms.
BETWEEN = np.ones(256, bool)
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    BETWEEN[_low:_high] = False


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms (A-Z lower-cased) and the term offsets of the rows."""
    data = FOLD[data]
    starts, ends, at = word_spans(data, offsets, BETWEEN)
    return hash_spans(data, starts, ends), at


@dataclass
class Items:
    """A block of items: sorted term hashes, and per item its terms' numbers and counts."""

    ids: list = field(default_factory=list)
    hashes: list[np.ndarray] = field(default_factory=list)
    size: int = 0

    def add(self, item_id, text: str | None) -> None:
        data, offsets = text_bytes(pa.array([text], pa.string()))
        self.ids.append(item_id)
        self.hashes.append(term_hashes(data, offsets)[0])
        self.size += len(data)

    @property
    def full(self) -> bool:
        return len(self.ids) >= ITEMS or self.size >= ITEM_BYTES

    def vocabulary(self) -> np.ndarray:
        return np.unique(np.concatenate([*self.hashes, np.zeros(0, np.uint64)]))

    def vectors(self, vocabulary: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        found = [np.unique(h, return_counts=True) for h in self.hashes]
        return [(np.searchsorted(vocabulary, h), n.astype(np.int64)) for h, n in found]


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """Items in blocks that the driver can hold, whatever their number."""
    block = Items()
    for row in items.select("item_id", "text").toLocalIterator():
        block.add(row["item_id"], row["text"])
        if block.full:
            yield block
            block = Items()
    if block.ids:
        yield block


# ------------------------------------------------------------------- documents


def _project(vocabulary: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each document's number of terms, and which terms of the items it holds how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for first, last in pieces(offsets):
                yield part(batch.column(0).slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])

    def part(ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        hashes, at = term_hashes(data, offsets)
        row = np.repeat(np.arange(len(ids)), np.diff(at))
        if len(vocabulary):
            number = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
            known = vocabulary[number] == hashes
            key, count = np.unique(row[known] * len(vocabulary) + number[known], return_counts=True)
        else:
            key, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        bounds = np.searchsorted(key, np.arange(len(ids) + 1) * max(1, len(vocabulary)))
        lists = pa.array(bounds.astype(np.int32))
        terms = pa.ListArray.from_arrays(lists, pa.array((key % max(1, len(vocabulary))).astype(np.int32)))
        counts = pa.ListArray.from_arrays(lists, pa.array(count.astype(np.int64)))
        columns = [ids, pa.array(np.diff(at).astype(np.int64)), terms, counts]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "counts"])

    return run


def term_weights(n_docs: int, held: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) for each document frequency."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in held], np.int64)


def with_impacts(projected: DataFrame, n_docs: int, n_terms: int, weights: np.ndarray) -> DataFrame:
    """doc_id, terms, impacts and ``far``, the squared length of the document's weighted vector."""
    wide = lambda c: F.col(c).cast("decimal(18,0)") if isinstance(c, str) else F.lit(c).cast("decimal(18,0)")
    norm = F.floor(F.lit(25).cast("decimal(2,0)") * (wide("n") * wide(n_docs))).cast("decimal(38,0)")
    rows = projected.where(F.size("terms") > 0).withColumn("__scaled", norm).withColumn("__all", F.lit(n_terms))
    rows = rows.withColumn("m", F.expr("100 - 25 + (__scaled div __all)"))
    impacts = F.expr("transform(counts, tf -> (1000000000L * tf) div (1000L * tf + 12L * m))")
    far = F.aggregate("impacts", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return rows.select("doc_id", "terms", impacts.alias("impacts")).withColumn("far", far)


# ------------------------------------------------------------------ ball trees


@dataclass
class BallTree:
    """Nodes in preorder: range of rows, number of the second child (0: leaf), centroid, radius
    of the ball, and per coordinate the radius of the interval around the centroid."""

    order: np.ndarray
    low: list[int]
    high: list[int]
    second: list[int]
    centroid: np.ndarray
    radius: np.ndarray
    spread: np.ndarray


def _halves(points: np.ndarray, leaf: int) -> tuple[np.ndarray, list[int], list[int], list[int]]:
    """Order of the rows and the nodes: a node is halved between two of its far points."""
    draw = np.random.default_rng(12).standard_normal((points.shape[1], min(SKETCH, points.shape[1])), np.float32)
    sketch = points @ draw  # where to cut is a matter of taste; bounds are taken from the points
    order = np.arange(len(points))
    low, high, second = [], [], []
    todo = [(0, len(points), -1)]
    while todo:
        a, b, parent = todo.pop()
        if parent >= 0:
            second[parent] = len(low)
        low.append(a), high.append(b), second.append(0)
        if b - a > leaf:
            rows = sketch[order[a:b]]
            one = rows[np.square(rows - rows.mean(axis=0)).sum(axis=1).argmax()]
            other = rows[np.square(rows - one).sum(axis=1).argmax()]
            order[a:b] = order[a:b][(rows @ (one - other)).argsort(kind="stable")]
            half = (a + b) // 2
            todo += [(half, b, len(low) - 1), (a, half, -1)]  # the first child follows its parent at once
    return order, low, high, second


def build_tree(points: np.ndarray, leaf: int = LEAF) -> BallTree:
    """A tree over the rows of a float32 matrix. Radii are rounded up, so that they cover all rows."""
    order, low, high, second = _halves(points, leaf)
    rows = points[order]
    ends = np.array([i for i, s in enumerate(second) if not s])  # leaves, by rising row
    starts = np.array(low)[ends]
    shape = (len(low), points.shape[1])
    centroid, most, least, radius = np.empty(shape, np.float32), np.empty(shape, np.float32), np.empty(shape, np.float32), np.empty(len(low))
    size = np.array(high) - np.array(low)
    centroid[ends] = np.add.reduceat(rows, starts) / size[ends, None]
    most[ends], least[ends] = np.maximum.reduceat(rows, starts), np.minimum.reduceat(rows, starts)
    gap = rows - np.repeat(centroid[ends], size[ends], axis=0)
    length = np.sqrt(np.einsum("ij,ij->i", gap, gap, dtype=np.float64))
    radius[ends] = np.maximum.reduceat(length, starts) * ROUND
    for node in range(len(low) - 1, -1, -1):
        if second[node]:
            pair = [node + 1, second[node]]
            centroid[node] = size[pair] @ centroid[pair] / size[node]
            most[node], least[node] = most[pair].max(axis=0), least[pair].min(axis=0)
            apart = np.sqrt(np.square((centroid[pair] - centroid[node]).astype(float)).sum(axis=1))
            radius[node] = (apart + radius[pair]).max() * ROUND
    spread = np.maximum(most - centroid, centroid - least)
    return BallTree(order, low, high, second, centroid, radius, spread)


class Search:
    """Best documents of every item so far, and how many leaves were scored of how many."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, k: int):
        self.items = [(terms, counts, counts * weights[terms]) for terms, counts in items]
        self.weights, self.k = weights, k
        self.best: list[list[tuple[int, int]]] = [[] for _ in items]
        self.scored = self.leaves = 0

    def add(self, ids: list[int], rows: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Search a chunk of documents, each with its terms and impacts."""
        columns = np.unique(np.concatenate([t for t, _ in rows]))
        exact = np.zeros((len(rows), len(columns)), np.int64)
        for i, (terms, impacts) in enumerate(rows):
            exact[i, np.searchsorted(columns, terms)] = impacts
        # Half of a term's weight goes to either side of the product: rare terms count in a radius.
        scale = np.sqrt(self.weights[columns].astype(float))
        tree = build_tree((exact * scale).astype(np.float32))
        exact, ids = exact[tree.order], [ids[i] for i in tree.order]
        queries, found = np.zeros((len(columns), len(self.items)), np.float32), []
        for number, (terms, counts, _) in enumerate(self.items):
            at = np.minimum(np.searchsorted(columns, terms), len(columns) - 1)
            here = columns[at] == terms
            queries[at[here], number] = counts[here] * scale[at[here]]
            found.append((at[here], here))
        ball = np.sqrt(np.square(queries.astype(float)).sum(axis=0)) * tree.radius[:, None]
        bound = tree.centroid @ queries + np.minimum(ball, tree.spread @ queries)
        bound *= ROUND + 1e-7 * len(columns)
        for number, (at, here) in enumerate(found):
            if len(at):
                self._one(number, exact, ids, tree, at, self.items[number][2][here], (bound[:, number] + 1e-3).tolist())

    def _one(self, number, exact, ids, tree, columns, weights, bound) -> None:
        """Open nodes best first until no bound can reach the item's last kept score."""
        best, k = self.best[number], self.k
        self.leaves += tree.second.count(0)
        queue = [(-bound[0], 0)]
        while queue:
            most, node = heapq.heappop(queue)
            least = best[0][0] if len(best) == k else 1
            if -most < least:
                break
            if tree.second[node]:
                for child in (node + 1, tree.second[node]):
                    if bound[child] >= least:
                        heapq.heappush(queue, (-bound[child], child))
                continue
            self.scored += 1
            a = tree.low[node]
            scores = exact[a : tree.high[node], columns] @ weights
            if scores.max() < least:
                continue
            for i in np.flatnonzero(scores >= least).tolist():
                entry = (int(scores[i]), -ids[a + i])
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)


def _searcher(items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, ids, rows, cells, seen = Search(items, weights, k), [], [], 0, set()

        def flush() -> None:
            nonlocal ids, rows, seen
            if ids:
                search.add(ids, rows)
            ids, rows, seen = [], [], set()

        for batch in batches:
            terms, impacts = batch.column(1), batch.column(2)
            at = terms.offsets.to_numpy()
            flat, value = terms.values.to_numpy(), impacts.values.to_numpy()
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                own = flat[at[i] : at[i + 1]]
                wider = len(seen | set(own.tolist()))
                if len(ids) >= CHUNK or (len(ids) + 1) * wider > CELLS:
                    flush()
                ids.append(LAST if doc_id is None else doc_id)
                rows.append((own, value[at[i] : at[i + 1]]))
                seen.update(own.tolist())
        flush()
        found = [(place, -doc, score) for place, best in enumerate(search.best) for score, doc in best]
        place, docs, scores = zip(*found) if found else ((), (), ())
        columns = [pa.array(place, pa.int32()), pa.array([None if d == LAST else d for d in docs], pa.int64()), pa.array(scores, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "doc_id", "score"])

    return run


def _search_block(projected: DataFrame, block: Items, vocabulary: np.ndarray, k: int) -> DataFrame:
    """Best documents of a block's items: place, rank, doc_id, score."""
    totals = projected.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    held = np.zeros(len(vocabulary), np.int64)
    # as many rows as the block has terms
    for r in projected.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        held[r["term"]] = r["count"]
    weights = term_weights(totals["docs"], held)
    rows = with_impacts(projected, totals["docs"], totals["terms"] or 1, weights)
    rows = rows.sortWithinPartitions(F.col("far").desc()).select("doc_id", "terms", "impacts")
    found = rows.mapInArrow(_searcher(block.vectors(vocabulary), weights, k), "place int, doc_id bigint, score bigint")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = W.partitionBy("place", "__group").orderBy(*order)
    found = found.withColumn("__group", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    found = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k).drop("__group")
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("place").orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def ranked_search(documents: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` documents of highest score above 0 for every item: item_id, rank, doc_id, score.

    Every row of ``items`` is an item of its own, also when its id repeats or is null; every
    row of ``documents`` is a document, and rows of equal score and id each take a rank. A
    missing doc_id comes after all others. Null and empty texts have no terms: such
    documents are not counted and such items find nothing. Other columns are ignored.
    """
    spark = documents.sparkSession
    ship(spark)
    kind = dict(items.dtypes)["item_id"]
    rows = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for block in item_blocks(items):
        vocabulary = block.vocabulary()
        schema = "doc_id bigint, n bigint, terms array<int>, counts array<bigint>"
        projected = settle(rows.mapInArrow(_project(vocabulary), schema), "projected")
        names = spark.createDataFrame(list(enumerate(block.ids)), f"place int, item_id {kind}")
        found = settle(_search_block(projected, block, vocabulary, k), "ranked")
        out = out.unionByName(found.join(F.broadcast(names), "place").select("item_id", "rank", "doc_id", "score"))
    return out
