"""Token files coded by a static range asymmetric numeral system.

Texts are encoded with a public vocabulary in ascending doc_id order, an end id closing
each. One table of frequencies, counted over all ids and scaled to a power of two, is
shared by all files. Ids are coded in independent blocks of whole texts; inside a block
many coder states run interleaved, so that numpy codes a lane per step. Each block has a
checkpoint (offset, states, first position, checksum) from which any task can decode it.

Folder: ``table`` (Parquet: id, frequency), ``checkpoints`` (Parquet: path, offset, length, part,
block), and the shards that the checkpoints name; it can be opened without anything else.
Shard: blocks in a row, then a directory. Block: crc32 of all that follows, then header (ids,
lanes, words, texts, start), all uint64, text ids (int64), validity of text ids (uint8), text
lengths (int64), states (uint64), words (uint32). All numbers are little-endian.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from reviewloom.llm import files, wordids
from reviewloom.llm.common import hash_spans, pieces, text_bytes, word_spans
from reviewloom.shipping import ship
from reviewloom.staging import fresh_path, settle

BITS = 20  # frequencies sum to 2 ** BITS
LANES = 512
BLOCK = 1 << 17  # a block is closed by the text that reaches so many ids
_FLOOR = np.uint64(1 << 31)
_B, _W = np.uint64(BITS), np.uint64(32)
_SLOT, _LOW = np.uint64((1 << BITS) - 1), np.uint64(0xFFFFFFFF)


def frequency_table(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Scale counts to a sum of ``2 ** bits``; every id keeps at least 1, so any id can be coded."""
    room = (1 << bits) - len(counts)
    total = max(int(counts.sum()), 1)
    scaled = 1 + (counts.astype(object) * room // total).astype(np.int64)
    scaled[np.argmax(scaled)] += (1 << bits) - scaled.sum()
    return scaled.astype(np.uint32)


class Coder:
    """Codes runs of ids with one frequency table."""

    def __init__(self, table: np.ndarray):
        self.freq = table.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(table)[:-1]]).astype(np.uint64)
        self._symbols: np.ndarray | None = None

    def encode(self, ids: np.ndarray, lanes: int = LANES) -> tuple[np.ndarray, np.ndarray]:
        """Final states and the 32-bit words, in the order the decoder takes them."""
        lanes = max(1, min(lanes, len(ids)))
        states = np.full(lanes, _FLOOR)
        words = []
        for first in range((len(ids) - 1) // lanes * lanes, -1, -lanes):
            row = ids[first : first + lanes]
            f, x = self.freq[row], states[: len(row)]
            full = x >= f << np.uint64(63 - BITS)
            words.append((x[full] & _LOW).astype(np.uint32))
            x = np.where(full, x >> _W, x)
            high = x // f
            states[: len(row)] = (high << _B) + (x - high * f) + self.start[row]
        return states, np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)

    def decode(self, n: int, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        if self._symbols is None:
            self._symbols = np.repeat(np.arange(len(self.freq), dtype=np.int32), self.freq.astype(np.int64))
        out, states, at = np.empty(n, np.int32), states.copy(), 0
        lanes = len(states)
        for first in range(0, n, lanes):
            x = states[: min(lanes, n - first)]
            slot = x & _SLOT
            row = self._symbols[slot]
            out[first : first + len(x)] = row
            x = self.freq[row] * (x >> _B) + slot - self.start[row]
            low = np.flatnonzero(x < _FLOOR)
            x[low] = (x[low] << _W) | words[at : at + len(low)]
            at += len(low)
            states[: len(x)] = x
        return out


def pack_block(coder: Coder, ids: np.ndarray, names: np.ndarray, known: np.ndarray, sizes: np.ndarray, start: int) -> bytes:
    states, words = coder.encode(ids)
    head = np.array([len(ids), len(states), len(words), len(sizes), start], "<u8")
    parts = (head, names.astype("<i8"), known.astype("u1"), sizes.astype("<i8"), states.astype("<u8"), words.astype("<u4"))
    raw = b"".join(p.tobytes() for p in parts)
    return zlib.crc32(raw).to_bytes(8, "little") + raw


def unpack_block(coder: Coder, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """ids, text ids, their validity, text lengths, position of the first id; checks the checksum first."""
    if len(raw) < 48 or zlib.crc32(raw[8:]) != int.from_bytes(raw[:8], "little"):
        raise ValueError("token block is damaged: its checksum differs")
    n, lanes, n_words, texts, start = (int(v) for v in np.frombuffer(raw, "<u8", 5, 8))
    at, out = 48, []
    for kind, count in (("<i8", texts), ("u1", texts), ("<i8", texts), ("<u8", lanes), ("<u4", n_words)):
        out.append(np.frombuffer(raw, kind, count, at))
        at += out[-1].nbytes
    names, known, sizes, states, words = out
    return coder.decode(n, states, words), names, known, sizes, start


def _blocks(path: str, end_id: int, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts to uncoded blocks of whole texts, in the order they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, part = wordids.word_pairs(path), TaskContext.get().partitionId()
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        sizes: list[int] = []
        block = before = filled = 0

        def close() -> pa.RecordBatch:
            flat = np.concatenate(ids).astype(kind).tobytes()
            row = [[part], [block], [before], [filled], [names], [sizes], [flat]]
            types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=_COLUMNS)

        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            keys = batch.column(0).to_pylist()
            for first, last in pieces(offsets, 1 << 22):
                low = offsets[first]
                part_data = data[low : offsets[last]]
                starts, ends, at = word_spans(part_data, offsets[first : last + 1] - low)
                flat, each = memory.lookup(part_data, starts, ends, hash_spans(part_data, starts, ends))
                bounds = np.concatenate([[0], np.cumsum(each)])[at]
                for i in range(last - first):
                    text = np.append(flat[bounds[i] : bounds[i + 1]], end_id)
                    ids.append(text)
                    names.append(keys[first + i])
                    sizes.append(len(text))
                    filled += len(text)
                    if filled >= BLOCK:
                        yield close()
                        block, before, filled = block + 1, before + filled, 0
                        ids, names, sizes = [], [], []
        if ids:
            yield close()

    return run


_COLUMNS = ["part", "block", "before", "n", "doc_ids", "sizes", "ids"]
_BLOCK_SCHEMA = "part long, block long, before long, n long, doc_ids array<long>, sizes array<long>, ids binary"


def _counter(kind: str, n_ids: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_ids, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                total += np.bincount(np.frombuffer(raw.as_buffer(), kind), minlength=n_ids)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    return run


def _writer(table: np.ndarray, folder: str, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks to shards; a shard holds neighbouring blocks in order. Returns the checkpoints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, path, out, last, offset, rows = Coder(table), "", None, None, 0, []

        def finish() -> None:
            directory = np.array([(r[1], r[2]) for r in rows if r[0] == path], "<u8").tobytes()
            out.write(directory + len(directory).to_bytes(8, "little"))
            out.close()

        for batch in batches:
            for i in range(len(batch)):
                part, block, first, names, sizes, ids = (batch.column(c)[i] for c in range(6))
                here = (part.as_py(), block.as_py())
                if out is None or here != (last[0], last[1] + 1):
                    if out is not None:
                        finish()
                    path, out = files.create(folder, f"shard-{here[0]:08d}-{here[1]:08d}")
                    offset = 0
                names = names.values
                known = names.is_valid().to_numpy(zero_copy_only=False)
                raw = pack_block(
                    coder,
                    np.frombuffer(ids.as_buffer(), kind).astype(np.int64),
                    names.fill_null(0).to_numpy(),
                    known,
                    sizes.values.to_numpy(),
                    first.as_py(),
                )
                out.write(raw)
                rows.append((path, offset, len(raw), *here))
                offset, last = offset + len(raw), here
        if out is not None:
            finish()
        columns = list(zip(*rows)) or [[]] * 5
        types = [pa.string()] + [pa.int64()] * 4
        arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
        yield pa.RecordBatch.from_arrays(arrays, names=["path", "offset", "length", "part", "block"])

    return run


def write_tokens(docs: DataFrame, path: str, end_id: int, folder: str, n_ids: int) -> None:
    """Encode all texts and write them to a new folder, for :func:`open_tokens`.

    Shards of attempts that did not count are not named by the checkpoints.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = "<u2" if n_ids <= 1 << 16 else "<u4"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    blocks = settle(ordered.mapInArrow(_blocks(path, end_id, kind), _BLOCK_SCHEMA), "blocks")

    counted = blocks.select("ids").mapInArrow(_counter(kind, n_ids), "id long, n long")
    counts = np.zeros(n_ids, np.int64)
    for row in counted.groupBy("id").agg(F.sum("n").alias("n")).collect():  # one row per id of the vocabulary
        counts[row["id"]] = row["n"]
    table = frequency_table(counts)
    rows = pd.DataFrame({"id": np.arange(n_ids), "frequency": table.astype(np.int64)})
    spark.createDataFrame(rows).coalesce(1).write.parquet(f"{folder}/table")

    parts = blocks.groupBy("part").agg(F.sum("n").alias("all"))
    upto = F.sum("all").over(W.partitionBy(F.lit(0)).orderBy("part"))
    parts = settle(parts.select(F.col("part"), (upto - F.col("all")).alias("earlier")), "parts")
    placed = blocks.join(parts, "part").withColumn("start", F.col("before") + F.col("earlier"))
    placed = placed.select("part", "block", "start", "doc_ids", "sizes", "ids").sortWithinPartitions("part", "block")
    written = placed.mapInArrow(
        _writer(table, folder, kind), "path string, offset long, length long, part long, block long"
    )
    written.write.parquet(f"{folder}/checkpoints")


def open_tokens(spark: SparkSession, folder: str) -> tuple[DataFrame, np.ndarray]:
    """Checkpoints and frequency table of a folder of token files."""
    rows = spark.read.parquet(f"{folder}/table").collect()  # one row per id of the vocabulary
    table = np.zeros(len(rows), np.uint32)
    for row in rows:
        table[row["id"]] = row["frequency"]
    return spark.read.parquet(f"{folder}/checkpoints"), table


def read_tokens(checkpoints: DataFrame, table: np.ndarray) -> DataFrame:
    """Decode blocks, spread over all tasks: doc_id, start, n_tokens, ids (uint32 binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, reader = Coder(table), files.Reader()
        for batch in batches:
            for path, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids, names, known, sizes, start = unpack_block(coder, reader.read(path, offset, length))
                ends = np.cumsum(sizes)
                raw = ids.astype("<u4").tobytes()
                texts = [raw[4 * (e - s) : 4 * e] for e, s in zip(ends.tolist(), sizes.tolist())]
                columns = [pa.array(names, mask=known == 0), pa.array(start + ends - sizes), pa.array(sizes)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(texts, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"]
                )

    spread = int(checkpoints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = checkpoints.select("path", "offset", "length").repartition(spread, "path", "offset")
    return rows.sortWithinPartitions("path", "offset").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary"
    )


def token_files(docs: DataFrame, path: str, end_id: int = 2, n_ids: int = 49_408) -> DataFrame:
    """Write all texts as token files and read them back: doc_id, start, n_tokens, ids_crc32.

    Null and empty texts hold the end id alone. Null doc_ids come first; rows that share a
    doc_id follow each other in the order of a hash of their text. Other columns are
    ignored; an empty table writes no shard and gives an empty result.
    """
    folder = fresh_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, end_id, folder, n_ids)
    return read_tokens(*open_tokens(docs.sparkSession, folder)).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
