"""Toxicity by a support vector machine with a subsequence string kernel.

Two words are alike by the three-letter subsequences they share, each weighted down by the
letters it spans, so that letters put between or left out cost likeness but not all of it.
The machine is trained on Nyström features over landmark words: the words that tell toxic
sentences from clean ones, and ordinary words. As the kernel is an inner product over
subsequences, the trained machine folds into one weight per subsequence, and scoring a word
needs no landmark. A text scores by its worst word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from reviewloom.llm.common import hash_spans, mix, pieces, text_bytes, word_spans
from reviewloom.shipping import ship
from reviewloom.staging import settle

TRAIN_ROWS, CALIBRATION = 2000, 400  # labelled texts of each class to learn from and to scale with, at most
LANDMARKS, NEGATIVES = 96, 800  # ordinary words among the landmarks; clean words to train on
HARD_ROUNDS, HARD = 3, 300  # fits with the clean words that the last one took for telling; such words a fit
DECAY = 0.7  # weight of each letter a subsequence spans
WINDOW = 16  # letters compared at once; longer words are cut into overlapping windows
RATIO, SURE = 12.0, 24.0  # least likelihood ratio of a telling word and its stem; of a stem that tells alone
MINIMA, ALIKE = 64, 0.8  # size of a sketch of a text; share of it that near copies have in common
PRIOR = 0.1  # share of toxic texts that the probability assumes
MEMORY = 500_000  # words remembered per task
_KINDS = 40

# Letters by code; digits that stand for letters; other characters are left out.
_LETTER = bytearray(256)
for _i in range(26):
    _LETTER[65 + _i] = _LETTER[97 + _i] = _i + 1
for _digit, _as in zip("013457@", "oieasta"):
    _LETTER[ord(_digit)] = ord(_as) - 96
for _i in range(0x80, 0xC0):
    _LETTER[_i] = 27 + (_i - 0x80) % 13  # the later bytes of other letters; their first bytes tell little
_LEFT_OUT = bytes(i for i in range(256) if not _LETTER[i])
_LETTER = bytes(_LETTER)
_MARKS = bytes(i for i in range(33, 127) if not chr(i).isalnum())


def letters(word: bytes) -> bytes:
    return word.translate(_LETTER, _LEFT_OUT)


@lru_cache(maxsize=None)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all three-letter subsequences of n letters and their weights."""
    at = np.array(list(combinations(range(n), 3)), np.int64)
    return at, DECAY ** (at[:, 2] - at[:, 0] + 1.0)


def features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence numbers (words x triples) of equally long words, and the triples' weights."""
    at, weight = _triples(codes.shape[1])
    c = codes.astype(np.int64)
    return (c[:, at[:, 0]] * _KINDS + c[:, at[:, 1]]) * _KINDS + c[:, at[:, 2]], weight


def self_kernel(codes: np.ndarray) -> np.ndarray:
    """Kernel of each word with itself, by the usual recursion over both copies."""
    n = codes.shape[1]
    c = codes.T
    same = DECAY**2 * (c[:, None, :] == c[None, :, :])
    inner = same
    for _ in range(2):
        total = inner.copy()
        for a in range(1, n):
            total[a] += DECAY * total[a - 1]
        for b in range(1, n):
            total[:, b] += DECAY * total[:, b - 1]
        inner = np.zeros_like(same)
        inner[1:, 1:] = same[1:, 1:] * total[:-1, :-1]
    return inner.sum(axis=(0, 1))


def vector(word: bytes) -> np.ndarray:
    """Normalised subsequence vector of one word (letters, at most a window)."""
    out = np.zeros(_KINDS**3)
    if len(word) >= 3:
        number, weight = features(np.frombuffer(word, np.uint8)[None, :])
        np.add.at(out, number[0], weight)
        out /= np.linalg.norm(out)
    return out


@dataclass
class Machine:
    """A weight per subsequence, an offset, and the slope and offset of the probability."""

    weights: np.ndarray
    offset: float
    slope: float
    shift: float

    def words(self, texts: list[bytes]) -> np.ndarray:
        """Decision value of each word; words of fewer than three letters have the offset."""
        out = np.full(len(texts), self.offset)
        groups: dict[int, list[tuple[int, bytes]]] = {}
        for i, text in enumerate(texts):
            word = letters(text)
            if len(word) <= WINDOW:
                groups.setdefault(len(word), []).append((i, word))
            else:
                half = WINDOW // 2
                for first in range(0, len(word) - half, half):
                    part = word[first : first + WINDOW]
                    groups.setdefault(len(part), []).append((i, part))
        for n, members in groups.items():
            if n < 3:
                continue
            for first in range(0, len(members), 2048):
                rows, parts = zip(*members[first : first + 2048])
                codes = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, n)
                number, weight = features(codes)
                value = self.weights[number] @ weight / np.sqrt(self_kernel(codes)) + self.offset
                np.maximum.at(out, list(rows), value)
        return out

    def probability(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * worst + self.shift, -30, 30)))


def text_words(text: str) -> list[bytes]:
    """Words of a text, and runs of three or more single letters as one word each."""
    words = text.encode().split()
    spelled = re.findall(rb"(?:(?<![^ \t-\r])[A-Za-z0-9][ \t-\r]+){2,}[A-Za-z0-9](?![^ \t-\r])", text.encode())
    return words + [b"".join(s.split()) for s in spelled]


def _sentences(text: str) -> list[str]:
    return [s for s in re.split(r"[.!?\n]+", text) if s.strip()]


def unlike_texts(texts: list[str], toxic: list[int]) -> list[int]:
    """Numbers of the texts that are no near copy of an earlier one with the same label.

    Near copies agree in ``ALIKE`` of ``MINIMA`` minima over their pairs of words.
    """
    salts = np.random.default_rng(5).integers(1, 2**63, MINIMA, dtype=np.uint64)
    sketches = np.zeros((len(texts), MINIMA), np.uint64)
    for i, text in enumerate(texts):
        words = text.lower().encode().split()
        pairs = {zlib.crc32(b" ".join(words[j : j + 2])) for j in range(max(1, len(words) - 1))}
        shingles = np.fromiter(pairs, np.uint64, len(pairs))
        for first in range(0, len(shingles), 4096):
            least = mix(shingles[first : first + 4096, None] ^ salts).min(axis=0)
            sketches[i] = least if not first else np.minimum(sketches[i], least)
    kept: list[int] = []
    for kind in (0, 1):
        rows = np.flatnonzero(np.array(toxic, int) == kind)
        gone = np.zeros(len(rows), bool)
        for at, i in enumerate(rows):
            if not gone[at]:
                gone[at + 1 :] |= (sketches[rows[at + 1 :]] == sketches[i]).mean(axis=1) >= ALIKE
        kept += rows[~gone].tolist()
    return sorted(kept)


def stems(word: bytes) -> list[bytes]:
    """Beginnings of a word that its forms share: at least half of it and four letters, not all of it."""
    text = word.decode("utf-8", "replace")
    return [text[:n].encode() for n in range(max(4, (len(text) + 1) // 2), len(text))] or [word]


def telling_words(toxic: list[set[bytes]], clean: list[set[bytes]]) -> list[bytes]:
    """Words whose texts are toxic far beyond chance, by the likelihood ratio of their counts.

    The counts of a word and those of its best stem, pooled over all words that begin with
    it, both must reach ``RATIO``, or the stem alone ``SURE`` if the word itself is more toxic
    than not. A chance word mostly has clean relatives; an insult's forms, each rare, add up.
    """
    if not toxic or not clean:
        return []
    often, usual = (Counter(w for words in kind for w in words) for kind in (toxic, clean))
    words = [w for w, n in often.items() if n >= 3 and len(letters(w)) >= 3]
    share = len(toxic) / (len(toxic) + len(clean))
    wanted = {t for w in words for t in stems(w)}
    pooled: tuple[Counter, Counter] = (Counter(), Counter())
    begins: dict[bytes, tuple[bytes, ...]] = {}
    for count, kind in zip(pooled, (toxic, clean)):
        for one in kind:
            found: set[bytes] = set()
            for w in one:
                if w not in begins:
                    text = w.decode("utf-8", "replace")
                    begins[w] = tuple(t for n in range(1, len(text) + 1) if (t := text[:n].encode()) in wanted)
                found.update(begins[w])
            count.update(found)

    def ratio(hit: np.ndarray, miss: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            out = 2 * (hit * np.log(hit / ((hit + miss) * share)) + np.nan_to_num(miss * np.log(miss / ((hit + miss) * (1 - share)))))
        return np.where(hit > (hit + miss) * share, out, 0.0)

    hit, miss = (np.array([float(c[w]) for w in words]) for c in (often, usual))
    own = ratio(hit, miss)
    names = sorted(wanted)
    of = dict(zip(names, ratio(*(np.array([float(c[t]) for t in names]) for c in pooled))))
    best = np.array([max(of[t] for t in stems(w)) for w in words])
    keep = ((own >= RATIO) & (best >= RATIO)) | ((best >= SURE) & (hit > miss))
    return sorted(w for w, k in zip(words, keep) if k)


def _support_vectors(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Linear machine with hinge loss by dual coordinate steps; ``weight`` bounds each dual."""
    w, dual = np.zeros(x.shape[1]), np.zeros(len(x))
    norm = (x * x).sum(axis=1)
    rng = np.random.default_rng(2)
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            gain = y[i] * (x[i] @ w) - 1
            new = min(max(dual[i] - gain / norm[i], 0.0), weight[i])
            if new != dual[i]:
                w += (new - dual[i]) * y[i] * x[i]
                dual[i] = new
    return w


def _fit(bad: list[bytes], negatives: list[bytes], landmarks: list[bytes]) -> Machine:
    """The machine of two lists of words, without the scale of its probability."""
    cut = lambda w: letters(w)[:WINDOW]
    # Only the subsequences of landmarks count; the others of a word meet zeros.
    used = np.unique(np.concatenate([np.flatnonzero(vector(cut(w))) for w in landmarks]))
    base = np.array([vector(cut(w))[used] for w in landmarks])
    values, vectors = np.linalg.eigh(base @ base.T)
    solid = values > 1e-6 * values.max()
    root = vectors[:, solid] / np.sqrt(values[solid])  # maps kernels with landmarks to Nyström features
    words = bad + negatives
    kernels = np.concatenate([np.array([vector(cut(w))[used] for w in words[i : i + 256]]) @ base.T for i in range(0, len(words), 256)])
    x = np.hstack([kernels @ root, np.ones((len(words), 1))])
    y = np.where(np.arange(len(words)) < len(bad), 1.0, -1.0)
    w = _support_vectors(x, y, np.where(y > 0, 100.0, 10.0))
    weights = np.zeros(_KINDS**3)
    weights[used] = base.T @ (root @ w[:-1])
    return Machine(weights, float(w[-1]), 1.0, 0.0)


def train(texts: list[str], toxic: list[int]) -> Machine:
    """Fit the machine on labelled texts.

    The words of toxic sentences that clean ones lack are the examples of one class, words
    of clean sentences those of the other, first common ones, then those that the machine
    takes for telling ones. The probability is scaled on whole texts.
    """
    found: tuple[list[set[bytes]], list[set[bytes]]] = ([], [])
    for i in unlike_texts(texts, toxic):
        words = (w.strip(_MARKS) for s in _sentences(texts[i].lower()) for w in s.encode().split())
        found[bool(toxic[i])].append(set(words))
    often = Counter(w for words in found[0] for w in words)
    bad = telling_words(found[1], found[0])
    if not bad:
        return Machine(np.zeros(_KINDS**3), -1.0, 2.0, -2.0)
    usual = sorted((w for w in often if len(letters(w)) >= 3), key=lambda w: (-often[w], w))
    step = max(1, len(usual) // NEGATIVES)
    negatives = [w for w in dict.fromkeys(usual[: NEGATIVES // 2] + usual[::step]) if w not in set(bad)]
    ordinary = negatives[: LANDMARKS // 2] + negatives[LANDMARKS // 2 :: max(1, 2 * len(negatives) // LANDMARKS)]
    machine = _fit(bad, negatives, bad + ordinary)
    for _ in range(HARD_ROUNDS):  # clean words that look most like telling ones are examples and landmarks as well
        value = machine.words(usual)
        taken = set(bad) | set(negatives)
        hard = [usual[i] for i in np.argsort(-value, kind="stable")[: 2 * HARD] if usual[i] not in taken][:HARD]
        negatives, ordinary = negatives + hard, ordinary + hard[:LANDMARKS]
        machine = _fit(bad, negatives, bad + ordinary)

    chosen = [i for kind in (0, 1) for i in np.flatnonzero(np.array(toxic) == kind)[:CALIBRATION]]
    worst = np.array([machine.words(sorted(set(text_words(texts[i]))) or [b""]).max() for i in chosen])
    label = np.array([float(toxic[i]) for i in chosen])
    pull = np.where(label == 1, PRIOR * len(label) / max(label.sum(), 1), (1 - PRIOR) * len(label) / max((1 - label).sum(), 1))
    fit = np.array([1.0, 0.0])
    inputs = np.column_stack([worst, np.ones_like(worst)])
    for _ in range(50):  # logistic regression with a weak pull to zero, by Newton steps
        p = 1 / (1 + np.exp(-np.clip(inputs @ fit, -30, 30)))
        slope = inputs.T @ (pull * (p - label)) + 0.5 * fit
        curve = (inputs * (pull * p * (1 - p))[:, None]).T @ inputs + 0.5 * np.eye(2)
        fit = fit - np.linalg.solve(curve, slope)
    machine.slope, machine.shift = float(fit[0]), float(fit[1])
    return machine


def _scorer(machine: Machine) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, float] = {}
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for first, last in pieces(offsets, 1 << 22):
                if len(known) > MEMORY:
                    known.clear()
                low = offsets[first]
                part = data[low : offsets[last]]
                starts, ends, at = word_spans(part, offsets[first : last + 1] - low)
                distinct, sample, back = np.unique(hash_spans(part, starts, ends), return_index=True, return_inverse=True)
                keys, raw = distinct.tolist(), part.tobytes()
                fresh = [i for i, k in enumerate(keys) if k not in known]
                words = [raw[a:b] for a, b in zip(starts[sample[fresh]].tolist(), ends[sample[fresh]].tolist())]
                known.update(zip([keys[i] for i in fresh], machine.words(words).tolist()))
                value = np.fromiter((known[k] for k in keys), np.float64, len(keys))[back]
                worst = np.full(last - first, machine.offset)
                some = np.flatnonzero(np.diff(at))
                if len(some):
                    worst[some] = np.maximum.reduceat(value, at[:-1][some])
                single = ends - starts == 1
                row = np.repeat(np.arange(last - first), np.diff(at))
                for i in np.unique(row[1:][single[1:] & single[:-1]]):
                    text = raw[starts[at[i]] : ends[at[i + 1] - 1]].decode()
                    spelled = text_words(text)[at[i + 1] - at[i] :]
                    if spelled:
                        worst[i] = max(worst[i], machine.words(spelled).max())
                score = machine.probability(worst)
                rest = [pa.array(score), pa.array((score >= 0.3).astype(np.int32))]
                keep = batch.select([0, 1]).slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*keep.columns, *rest], names=["doc_id", "held_out", "score", "predicted"])

    return run


def learn(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = TRAIN_ROWS) -> Machine:
    """Train on at most ``rows`` usable texts of each class, first by a hash of their id."""
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = docs.where(usable & F.col("text").isNotNull()).withColumn("order", F.xxhash64("doc_id", "text"))
    # Labels meet ids and hashes; of the texts only the chosen ones are moved.
    slim = known.select("doc_id", "order").join(marks, "doc_id").select("toxic", "order").distinct()
    slim = slim.groupBy("order").agg(F.max(F.col("toxic") == 1).alias("bad"))
    place = F.row_number().over(W.partitionBy("bad").orderBy("order"))
    chosen = settle(slim.withColumn("place", place).where(F.col("place") <= rows).select("order", "bad"), "chosen")
    texts = known.join(chosen, "order").groupBy("order", "bad").agg(F.first("text").alias("text"))
    sample = settle(texts, "labelled").orderBy("order").collect()  # twice ``rows`` texts at most
    return train([r["text"] for r in sample], [int(r["bad"]) for r in sample])


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, rows: int = TRAIN_ROWS) -> DataFrame:
    """Toxicity of each text: doc_id, held_out, score, predicted; one row per input row.

    Learns from labelled rows that are not held out; a label row without ``toxic`` or
    doc_id is left out, and of several for one id the highest counts. Null and empty texts
    score as clean as a text can. Without toxic examples all scores are low. Null doc_ids,
    repeated rows and other columns do no harm; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    rows_in = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), F.col("text").cast("string"))
    machine = docs.sparkSession.sparkContext.broadcast(learn(rows_in, labels, ~F.col("held_out"), rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _scorer(machine.value)(batches)

    return rows_in.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
