"""Language-model scores: a smoothed unigram base and a gated recurrent network.

Texts are written once as blocks of token numbers with the block's distinct words. Word
counts over the whole corpus are summed by word and sent back to the blocks, not to texts.

The network reads a word as itself (the most frequent ones) or as one of a few classes of
other words by their last letter. It predicts the class of the next word, then the word
within its class: by the network for frequent words, by smoothed counts for the others. So
every text has a probability. It is trained by truncated backpropagation over all training
texts: from a common start, each task trains on its blocks and the weights are averaged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.llm.common import FOLD, hash_spans, longs, pieces, text_bytes, word_spans
from reviewloom.shipping import ship
from reviewloom.staging import settle

BLOCK = 4 << 20  # bytes of text in a block
END = np.uint64(1 << 63)  # the key of the end of a text
CLASSES, WIDTH = 32, 32  # classes of frequent words, and words in each
OTHERS = 32  # classes of all other words: the last five bits of a key
HIDDEN, RATE = 16, 0.01
STEPS, STRETCH, LANES = 16, 256, 512  # words of a window and of a training stretch; stretches side by side
WIDE, TOGETHER = 8192, 2  # texts scored side by side, of so many blocks at once
START_BLOCKS, START_PASSES = 2, 3  # blocks that the common start is trained on, and how often
SMOOTH = 0.1
_HEAD = CLASSES * WIDTH

_BLOCK_SCHEMA = (
    "block long, doc_ids array<long>, held array<boolean>, sizes array<int>, keys binary, counts binary, tokens binary"
)


def _planes(values: np.ndarray) -> np.ndarray:
    """32-bit numbers as their lowest bytes, then the next ones: the upper ones, nearly all 0, pack well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)


def _from_planes(raw: pa.Scalar) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw.as_buffer(), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _block(ids: pa.Array, held: pa.Array, data: np.ndarray, offsets: np.ndarray, number: int) -> pa.RecordBatch:
    """One block: the texts as numbers into the block's sorted distinct keys."""
    data = FOLD[data]
    starts, ends, at = word_spans(data, offsets)
    keys = hash_spans(data, starts, ends) & ~np.uint64((1 << 63) | (OTHERS - 1))
    keys |= (data[ends - 1] % OTHERS).astype(np.uint64)
    stops = at[1:] + np.arange(len(at) - 1)  # where each text's end goes
    full = np.empty(len(keys) + len(stops), np.uint64)
    is_end = np.zeros(len(full), bool)
    is_end[stops] = True
    full[is_end], full[~is_end] = END, keys
    sizes = np.diff(at) + 1
    distinct, tokens = np.unique(full, return_inverse=True)
    learn = np.repeat(~held.to_numpy(zero_copy_only=False), sizes)
    counts = np.bincount(tokens[learn], minlength=len(distinct))
    lists = [pa.array([v], t) for v, t in ((ids, pa.list_(pa.int64())), (held, pa.list_(pa.bool_())))]
    raw = [distinct, _planes(counts), _planes(tokens)]
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), *lists, pa.array([sizes.astype(np.int32)], pa.list_(pa.int32()))]
        + [pa.array([r.tobytes()], pa.binary()) for r in raw],
        names=[c.split()[0] for c in _BLOCK_SCHEMA.split(", ")],
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        for first, last in pieces(offsets, BLOCK):
            low, part = offsets[first], batch.slice(first, last - first)
            yield _block(part.column(0), part.column(1), data[low : offsets[last]], offsets[first : last + 1] - low, number)
            number += 1


def _words(but: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The distinct words of each block, their counts and numbers in it, but for some (sorted) keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, counts in zip(*(batch.column(i) for i in range(3))):
                key = np.frombuffer(keys.as_buffer(), np.uint64)
                n = _from_planes(counts).astype(np.int64)
                left = np.ones(len(key), bool)
                if len(but):
                    left = but[np.minimum(np.searchsorted(but, key), len(but) - 1)] != key
                columns = [pa.array(np.full(int(left.sum()), block.as_py())), longs(key[left]), pa.array(n[left])]
                at = pa.array(np.flatnonzero(left).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*columns, at], names=["block", "key", "n", "at"])

    return run


@dataclass
class Counts:
    """What the corpus says: totals, the frequent words in order of count, and other words by class."""

    total: int
    distinct: int
    frequent: np.ndarray
    other_total: np.ndarray
    other_distinct: np.ndarray

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Input number of each key: its rank among the frequent words, else by its class."""
        order = np.argsort(self.frequent)
        known = self.frequent[order]
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, order[at], _HEAD + (keys % np.uint64(OTHERS)).astype(np.int64))


@dataclass
class Network:
    """Weights. Rows of ``embed`` are inputs; the last one begins a text."""

    embed: np.ndarray
    gates: np.ndarray
    bias: np.ndarray
    reset: np.ndarray
    classes: np.ndarray
    class_bias: np.ndarray
    words: np.ndarray
    word_bias: np.ndarray

    @staticmethod
    def start(counts: Counts, frequencies: np.ndarray, seed: int = 10) -> Network:
        rng = np.random.default_rng(seed)
        small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        word = np.log(frequencies.reshape(CLASSES, WIDTH) + SMOOTH).astype(np.float32)
        mass = np.concatenate([frequencies.reshape(CLASSES, WIDTH).sum(1), counts.other_total])
        return Network(
            embed=small(_HEAD + OTHERS + 1, 3 * HIDDEN),
            gates=small(HIDDEN, 2 * HIDDEN),
            bias=np.zeros(3 * HIDDEN, np.float32),
            reset=small(HIDDEN, HIDDEN),
            classes=np.zeros((HIDDEN, CLASSES + OTHERS), np.float32),
            class_bias=np.log(mass + 1).astype(np.float32),
            words=np.zeros((CLASSES, HIDDEN, WIDTH), np.float32),
            word_bias=word,
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, f.name).ravel() for f in fields(self)])

    def like(self, flat: np.ndarray) -> Network:
        return self.within(flat.astype(np.float32))

    def within(self, flat: np.ndarray) -> Network:
        """A network of these shapes whose weights lie in ``flat``, not in a copy."""
        out, at = {}, 0
        for f in fields(self):
            old = getattr(self, f.name)
            out[f.name] = flat[at : at + old.size].reshape(old.shape)
            at += old.size
        return Network(**out)

    def step(self, inputs: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """One word further: new states and what backpropagation needs."""
        x = self.embed[inputs] + self.bias
        zr = 1 / (1 + np.exp(-(x[:, : 2 * HIDDEN] + h @ self.gates)))
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        rh = r * h
        new = np.tanh(x[:, 2 * HIDDEN :] + rh @ self.reset)
        return h + z * (new - h), (inputs, h, zr, rh, new)

    def _softmaxes(self, h: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Class of each target and class log-probabilities; then the rows whose target is a frequent
        word, ordered by class, the classes' edges in that order, and these rows' word log-probabilities."""
        logits = _log_softmax(h @ self.classes + self.class_bias)
        head = target < _HEAD
        kind = np.where(head, target // WIDTH, target - _HEAD + CLASSES)
        order = np.argsort(kind, kind="stable")
        edges = np.searchsorted(kind[order], np.arange(CLASSES + 1))
        order = order[: edges[-1]]
        states, word = h[order], np.empty((len(order), WIDTH), np.float32)
        for c in range(CLASSES):
            a, b = edges[c], edges[c + 1]
            np.matmul(states[a:b], self.words[c], out=word[a:b])
        word += self.word_bias[kind[order]]
        return kind, logits, order, edges, _log_softmax(word)

    def log_likelihood(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log-probability of each target's class and, if frequent, of the word in it."""
        kind, logits, order, _, word = self._softmaxes(h, target)
        out = logits[np.arange(len(h)), kind].astype(np.float64)
        out[order] += word[np.arange(len(order)), target[order] % WIDTH]
        return out


def _log_softmax(values: np.ndarray) -> np.ndarray:
    values -= values.max(axis=1, keepdims=True)
    values -= np.log(np.exp(values).sum(axis=1, keepdims=True))
    return values


def _lanes(sizes: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Texts side by side, those of like length together, the longest first."""
    order = np.argsort(-sizes, kind="stable")
    for first in range(0, len(order), width):
        yield order[first : first + width]


def score_block(net: Network, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log-likelihood of every token by the network; states run on from window to window."""
    begins = np.cumsum(sizes) - sizes
    out = np.empty(len(places))
    for lane in _lanes(sizes, WIDE):
        h = np.zeros((len(lane), HIDDEN), np.float32)
        last = np.full(len(lane), _HEAD + OTHERS)
        lengths = -sizes[lane]
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for t in range(int(sizes[lane[0]])):
            active = int(np.searchsorted(lengths, -t, "left"))
            h, _ = net.step(last[:active], h[:active])
            at = begins[lane[:active]] + t
            last = places[at]
            waiting.append((at, h))
            held += active
            if held >= LANES * STEPS:
                at, states = (np.concatenate(x) for x in zip(*waiting))
                out[at] = net.log_likelihood(states, places[at])
                waiting, held = [], 0
        if waiting:
            at, states = (np.concatenate(x) for x in zip(*waiting))
            out[at] = net.log_likelihood(states, places[at])
    return out


class Trainer:
    """Adam over windows of truncated backpropagation."""

    def __init__(self, net: Network, rate: float = RATE):
        self.flat = net.flat()
        self.net, self.rate, self.t = net.within(self.flat), rate, 0
        self.first, self.second, self.gradient = (np.zeros_like(self.flat) for _ in range(3))
        self.grads = net.within(self.gradient)

    def _apply(self, grads: Network) -> None:
        """One step of Adam on the gradients, all in place."""
        g = self.gradient
        g *= min(1.0, 1.0 / (float(np.sqrt(g @ g)) + 1e-9))
        self.t += 1
        self.first += 0.1 * (g - self.first)
        g *= g
        g -= self.second
        self.second += 0.01 * g
        np.sqrt(self.second / (1 - 0.99**self.t), out=g)
        g += 1e-6
        np.divide(self.first, g, out=g)
        g *= self.rate / (1 + self.t / 2000) / (1 - 0.9**self.t)
        self.flat -= g

    def _window(self, past: list, states: list[np.ndarray], targets: list[np.ndarray]) -> None:
        """Gradients of one window, back to its first step."""
        net = self.net
        g = self.grads
        self.gradient[:] = 0
        h, target = np.concatenate(states), np.concatenate(targets)
        kind, logits, order, edges, word = net._softmaxes(h, target)
        scale = np.float32(1 / len(h))
        d = np.exp(logits)
        d[np.arange(len(h)), kind] -= 1
        d *= scale
        np.matmul(h.T, d, out=g.classes)
        d.sum(axis=0, out=g.class_bias)
        dh_all = d @ net.classes.T
        e = np.exp(word)
        e[np.arange(len(order)), target[order] % WIDTH] -= 1
        e *= scale
        inner, back = h[order], np.empty((len(order), HIDDEN), np.float32)
        for c in range(CLASSES):
            a, b = edges[c], edges[c + 1]
            if a < b:
                np.matmul(inner[a:b].T, e[a:b], out=g.words[c])
                e[a:b].sum(axis=0, out=g.word_bias[c])
                np.matmul(e[a:b], net.words[c].T, out=back[a:b])
        dh_all[order] += back
        carry = np.zeros_like(states[-1])
        ends = np.cumsum([len(s) for s in states])
        all_inputs, all_dx = [], []
        for t in range(len(states) - 1, -1, -1):
            inputs, before, zr, rh, new = past[t]
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            dh = dh_all[ends[t] - len(states[t]) : ends[t]].copy()
            dh[: len(carry)] += carry
            dnew = dh * z * (1 - new * new)
            drh = dnew @ net.reset.T
            dzr = np.concatenate([dh * (new - before), drh * before], axis=1) * zr * (1 - zr)
            g.reset += rh.T @ dnew
            g.gates += before.T @ dzr
            all_inputs.append(inputs)
            all_dx.append(np.concatenate([dzr, dnew], axis=1))
            carry = dh * (1 - z) + drh * r + dzr @ net.gates.T
        inputs, dx = np.concatenate(all_inputs), np.concatenate(all_dx)
        dx.sum(axis=0, out=g.bias)
        order = np.argsort(inputs, kind="stable")
        kinds, first = np.unique(inputs[order], return_index=True)
        g.embed[kinds] = np.add.reduceat(dx[order], first, axis=0)
        self._apply(g)

    def block(self, places: np.ndarray, sizes: np.ndarray, learn: np.ndarray) -> None:
        """One pass over the training texts of a block, in stretches that each begin anew."""
        n = -(-sizes // STRETCH) * learn
        row = np.repeat(np.arange(len(sizes)), n)
        skip = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * STRETCH
        begins = (np.cumsum(sizes) - sizes)[row] + skip
        lengths = np.minimum(STRETCH, sizes[row] - skip)
        for lane in _lanes(lengths, LANES):
            h = np.zeros((len(lane), HIDDEN), np.float32)
            at, size = begins[lane], -lengths[lane]
            last = np.where(skip[lane] > 0, places[np.maximum(at - 1, 0)], _HEAD + OTHERS)
            past, states, targets = [], [], []
            longest = int(-size[0])
            for t in range(longest):
                active = int(np.searchsorted(size, -t, "left"))
                h, kept = self.net.step(last[:active], h[:active])
                last = places[at[:active] + t]
                past.append(kept)
                states.append(h)
                targets.append(last)
                if len(states) == STEPS or t == longest - 1:
                    self._window(past, states, targets)
                    past, states, targets = [], [], []


def _parts(batch: pa.RecordBatch, row: int, counts: Counts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, tokens, input numbers, lengths and held-out marks of one block."""
    column = lambda name: batch.column(batch.schema.get_field_index(name))[row]
    keys = np.frombuffer(column("keys").as_buffer(), np.uint64)
    tokens = _from_planes(column("tokens"))
    sizes = column("sizes").values.to_numpy().astype(np.int64)
    held = column("held").values.to_numpy(zero_copy_only=False).astype(bool)
    return keys, tokens, counts.places(keys)[tokens], sizes, held


def _fit(net: Network, counts: Counts, passes: int = 1) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Train on the blocks of a task: one row with the weights and the words they rest on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, seen = Trainer(net, RATE if passes > 1 else RATE / 4), 0
        for batch in batches:
            for row in [r for _ in range(passes) for r in range(len(batch))]:
                _, _, places, sizes, held = _parts(batch, row, counts)
                trainer.block(places, sizes, ~held)
                seen += int(sizes[~held].sum())
        if seen:
            weights = pa.array([trainer.net.flat().astype(np.float64)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([seen]), weights], names=["seen", "weights"])

    return run


def _average(fitted: DataFrame, net: Network) -> Network:
    """Mean of the tasks' weights by the words they saw, summed by weight on the executors."""
    each = fitted.select("seen", F.posexplode("weights").alias("at", "w"))
    mean = each.groupBy("at").agg((F.sum(F.col("w") * F.col("seen")) / F.sum("seen")).alias("w"))
    rows = mean.collect()  # one row per weight of the network
    flat = net.flat().astype(np.float64)
    for row in rows:
        flat[row["at"]] = row["w"]
    return net.like(flat)


def _corpus_counts(totals: DataFrame) -> tuple[Counts, np.ndarray]:
    """Totals over the distinct words, and the most frequent of them."""
    words = totals.where("c > 0")
    top = words.where(F.col("key") != int(END.view(np.int64))).orderBy(F.desc("c"), "key").limit(_HEAD - 1)
    other = F.pmod("key", F.lit(OTHERS)).alias("kind")
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    rows = top.collect()  # CLASSES x WIDTH words at most
    end = words.where(F.col("key") == int(END.view(np.int64))).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    ranked = sorted([(r["c"], r["key"]) for r in rows] + [(end, int(END.view(np.int64)))], key=lambda r: (-r[0], r[1]))
    frequent = np.array([k for _, k in ranked], np.int64).view(np.uint64)
    kinds = words.groupBy(other).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    n, v = np.zeros(OTHERS, np.int64), np.zeros(OTHERS, np.int64)
    for row in kinds:
        n[row["kind"]], v[row["kind"]] = row["n"], row["v"]
    for (c, _), key in zip(ranked, frequent):
        n[int(key % np.uint64(OTHERS))] -= c
        v[int(key % np.uint64(OTHERS))] -= c > 0
    frequencies = np.zeros(_HEAD)
    frequencies[: len(ranked)] = [c for c, _ in ranked]
    return Counts(int(total[0]), int(total[1]), frequent, n, v), frequencies


SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _scorer(net: Network, counts: Counts, frequencies: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from (out for first in range(0, len(batch), TOGETHER) for out in some(batch.slice(first, TOGETHER)))

    def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        parts = [_parts(batch, row, counts) for row in range(len(batch))]
        likely = score_block(net, *(np.concatenate([p[i] for p in parts]) for i in (2, 3))) / np.log(10)
        first = 0
        for row, (keys, tokens, _, sizes, held) in enumerate(parts):
            own, places, shared = (batch.column(batch.schema.get_field_index(name))[row] for name in ("counts", "places", "shared"))
            often, rank = _from_planes(own).astype(float), counts.places(keys)
            often[rank < _HEAD] = frequencies[rank[rank < _HEAD]]
            if places.is_valid:
                often[places.values.to_numpy()] = shared.values.to_numpy()
            base = np.log10((often + SMOOTH) / (counts.total + SMOOTH * (counts.distinct + 1)))
            kind = (keys % np.uint64(OTHERS)).astype(np.int64)
            room = counts.other_total[kind] + SMOOTH * (counts.other_distinct[kind] + 1)
            inside = np.where(rank < _HEAD, 0.0, np.log10((often + SMOOTH) / room))
            value = likely[first : first + len(tokens)] + inside[tokens]
            first, starts = first + len(tokens), np.cumsum(sizes) - sizes
            columns = [
                batch.column(batch.schema.get_field_index("doc_ids"))[row].values,
                pa.array(held),
                pa.array(sizes),
                pa.array(np.add.reduceat((often > 0)[tokens].astype(np.int64), starts)),
                pa.array(np.full(len(sizes), counts.total)),
                pa.array(np.add.reduceat(base[tokens], starts)),
                pa.array(np.add.reduceat(value, starts)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return run


def score_texts(docs: DataFrame, held_out: Column) -> DataFrame:
    """Log10-probabilities of whole texts: one row per input row.

    Columns: doc_id, held_out, n_tokens (words and one end), n_known (tokens seen in
    training), train_tokens, base_score (smoothed unigrams), score (the network). Learns
    from the rows that are not held out. A null or empty text is its end alone. Without
    training rows the base gives every token probability 1. Null doc_ids, repeated rows and
    other columns do no harm; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long"), held_out.alias("held"), F.col("text").cast("string"))
    blocks = settle(rows.mapInArrow(_blocks, _BLOCK_SCHEMA), "blocks")
    held_words, schema = blocks.select("block", "keys", "counts"), "block long, key long, n long, at int"
    every = held_words.mapInArrow(_words(np.zeros(0, np.uint64)), schema)
    totals = settle(every.groupBy("key").agg(F.sum("n").alias("c"), F.count("*").alias("blocks")), "totals")
    counts, frequencies = _corpus_counts(totals)

    net = Network.start(counts, frequencies)
    slim = blocks.select("sizes", "held", "keys", "tokens", "block")
    # only numbers are sorted; the blocks themselves stay where they are
    least = [r["block"] for r in blocks.select("block").orderBy("block").limit(START_BLOCKS).collect()]
    first = slim.where(F.col("block").isin(least)).coalesce(1)
    net = _average(settle(first.mapInArrow(_fit(net, counts, START_PASSES), "seen long, weights array<double>"), "start"), net)
    net = _average(settle(slim.mapInArrow(_fit(net, counts), "seen long, weights array<double>"), "fitted"), net)

    # The scorer knows the totals of frequent words, which nearly all blocks hold, and a block knows those
    # of words that no other block holds; the others get theirs by a join.
    rare = held_words.mapInArrow(_words(np.sort(counts.frequent)), schema).select("block", "key", "at")
    shared = rare.join(totals.where("blocks > 1").select("key", "c"), "key")
    back = shared.groupBy("block").agg(F.collect_list("at").alias("places"), F.collect_list("c").alias("shared"))
    return blocks.join(back, "block", "left").mapInArrow(_scorer(net, counts, frequencies), SCHEMA)
