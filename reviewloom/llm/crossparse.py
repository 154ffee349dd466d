"""Language identification by cross-parsing.

A suffix automaton holds every substring of a language's training text. A text is parsed
against it into the longest phrases the automaton knows; a language explains a text the
better, the fewer phrases it needs. Texts are parsed in stretches of fixed length, each
beginning a new phrase, so that numpy steps through many stretches at once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from reviewloom.shipping import ship
from reviewloom.staging import settle

TRAIN_ROWS, TRAIN_CHARS = 200, 20_000  # training texts and characters per language, at most
SPANS = 8  # of a text that is longer than its part
STRETCH = 512  # characters parsed in a row
DENSE = 62  # letters of a language, the most frequent first, whose transitions are a plain table
LANES = 4096
UNKNOWN = "und"
_PAD, _OTHER, _GAP = 0, 1, 2  # codes: after the end, a letter the language has never seen, anything else


def _symbols(text: str) -> np.ndarray:
    """Code points of the lower-cased text; runs without letters become one 0."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[np.minimum(points, _WIDE)]
    points = np.where(letter, points, 0)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
    return points[keep]


_WIDE = 0x34000  # letters end below
_is_letter: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _is_letter:
        _is_letter.append(np.array([chr(i).isalpha() for i in range(_WIDE)] + [False]))
    return _is_letter[0]


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``codes``: the next state by code, for each state."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p != -1:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


class Language:
    """A language's alphabet, every letter of its training text, and automaton.

    Codes run from the most frequent letter to the rarest. Transitions by the first ``DENSE``
    letters are a plain table; those by rarer ones are few and lie sorted by state and code.
    """

    def __init__(self, text: str):
        symbols = _symbols(text)
        self.length = len(symbols)
        kinds, counts = np.unique(symbols[symbols > 0], return_counts=True)
        self.alphabet = kinds
        self.rank = np.empty(len(kinds), np.int64)
        self.rank[np.argsort(-counts, kind="stable")] = np.arange(len(kinds)) + 3
        self.width = min(len(kinds), DENSE) + 3
        step = suffix_automaton(self.codes(symbols).tolist())
        self.end = len(step)  # where a finished stretch stays
        self.table = np.full((self.end + 1, self.width), -1, np.int32)
        self.kinds = len(kinds) + 3
        rare = []
        for state, row in enumerate(step):
            for code, to in row.items():
                if code < self.width:
                    self.table[state, code] = to
                else:
                    rare.append((state * self.kinds + code, to))
        self.table[:, _PAD] = self.end
        self.rare_keys, self.rare_to = np.array(sorted(rare), np.int64).reshape(-1, 2).T.copy()

    def codes(self, symbols: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.alphabet, symbols), max(len(self.alphabet) - 1, 0))
        known = self.alphabet[at] == symbols if len(self.alphabet) else np.zeros(len(symbols), bool)
        code = self.rank[at] if len(self.alphabet) else at
        kind = np.uint8 if len(self.alphabet) + 3 <= 256 else np.int32
        return np.where(symbols == 0, _GAP, np.where(known, code, _OTHER)).astype(kind)

    def follow(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The next state of each lane, -1 where the language knows none."""
        if not len(self.rare_keys):
            return self.table.ravel()[state * self.width + codes]
        rare = codes >= self.width
        to = self.table.ravel()[state * self.width + np.where(rare, _OTHER, codes)]
        if rare.any():
            key = state[rare] * self.kinds + codes[rare]
            at = np.minimum(np.searchsorted(self.rare_keys, key), len(self.rare_keys) - 1)
            to[rare] = np.where(self.rare_keys[at] == key, self.rare_to[at], -1)
        return to

    def phrases(self, stretches: np.ndarray) -> np.ndarray:
        """Phrases of each column of codes: longest matches, one after the other."""
        state = np.zeros(stretches.shape[1], np.int64)
        count = np.zeros(stretches.shape[1], np.int64)
        root = self.follow(np.zeros(self.kinds, np.int64), np.arange(self.kinds))
        for codes in stretches:
            follow = self.follow(state, codes)
            stuck = follow < 0
            # A phrase begins at the root and where the last one cannot go on. A symbol
            # that the language lacks is a phrase of its own.
            count += (stuck | (state == 0)) & (codes != _PAD)
            state = np.where(stuck, np.maximum(root[codes], 0), follow).astype(np.int64)
        return count


def learn(docs: DataFrame, usable: Column, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> dict[str, Language]:
    """One automaton per value of lang among the usable rows, each from a bounded sample.

    Per language at most ``rows`` texts, first by a hash of text and id, and ``chars``
    characters in equal parts. A text's part is cut into spans spread over the whole of it; with few
    texts the parts are longer.
    """
    known = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = settle(known.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    share = F.ceil(F.lit(chars) / F.least("n", F.lit(rows)))
    wide, long = F.ceil(share / SPANS), F.length("text")
    at = lambda i: F.floor(i * F.greatest(long - wide, F.lit(0)) / (SPANS - 1)) + 1
    spans = F.transform(F.sequence(F.lit(0), F.lit(SPANS - 1)), lambda i: F.substring("text", at(i), wide))
    text = F.when(long <= share, F.col("text")).otherwise(F.array_join(spans, "\n"))
    known = known.join(sizes, "lang").select("lang", F.xxhash64("doc_id", "text").alias("order"), text.alias("text"))
    first = F.row_number().over(W.partitionBy("lang").orderBy("order", "text"))
    chosen = settle(known.withColumn("place", first).where(F.col("place") <= rows), "sample")
    texts: dict[str, list[str]] = {}
    for row in chosen.orderBy("lang", "place").collect():  # chars and a little x languages characters at most
        texts.setdefault(row["lang"], []).append(row["text"])
    return {lang: Language("\n".join(each)) for lang, each in texts.items()}


def _predictor(models: dict[str, Language]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = sorted(models)
    # matches grow with the logarithm of the text that they are sought in
    learnt = np.array([math.log(2 + models[name].length) for name in names])
    fair = learnt / learnt.max() if names else learnt

    def judge(texts: list[str | None]) -> tuple[list[str], list[float]]:
        symbols = [_symbols(t or "") for t in texts]
        sizes = np.array([len(s) for s in symbols])
        pieces = -(-sizes // STRETCH)
        flat = np.concatenate([*symbols, np.zeros(0, np.uint32)])
        row = np.repeat(np.arange(len(texts)), pieces)
        begin = np.repeat(np.cumsum(sizes) - sizes, pieces)
        order = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = begin + order * STRETCH
        length = np.minimum(STRETCH, np.repeat(np.cumsum(sizes), pieces) - begin)
        by_length = np.argsort(-length, kind="stable")
        cost = np.zeros((len(names), len(texts)))
        for i, name in enumerate(names):
            model = models[name]
            codes = np.append(model.codes(flat), np.uint8(_PAD))
            for first in range(0, len(row), LANES):
                lanes = by_length[first : first + LANES]
                steps = np.arange(length[lanes[0]])[:, None]
                take = np.where(steps < length[lanes], begin[lanes] + steps, len(flat))
                cost[i] += np.bincount(row[lanes], model.phrases(codes[take]), minlength=len(texts))
        some = np.array([bool((s > 0).any()) for s in symbols])
        if not names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        per = cost * fair[:, None] / np.maximum(sizes, 1)
        best = per.argmin(axis=0)
        lead = np.exp(-20 * (per - per.min(axis=0)))  # shares of the languages by phrases per character
        score = np.where(some, 1 / lead.sum(axis=0), 0.0)
        return [names[b] if s else UNKNOWN for b, s in zip(best, some)], score.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = batch.column(2).to_pylist(), batch.select([0, 1])
            first = 0
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and (size < 1 << 20 or last == first):
                    size, last = size + len(texts[last] or ""), last + 1
                lang, score = judge(texts[first:last])
                part = keys.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lang), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"]
                )
                first = last

    return run


def identify(docs: DataFrame, held_out: Column, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> DataFrame:
    """Language of each text: doc_id, held_out, lang_pred, score; one row per input row.

    Learns from rows that are not held out and have a lang. A null text, or one without a
    letter, is ``und`` with score 0, as is any text if there is nothing to learn from. Ties
    go to the first language by name. Null doc_ids, repeated rows and other columns do no
    harm; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    rows_in = docs.select(
        F.col("doc_id").cast("long"), held_out.alias("held_out"), F.col("text").cast("string"), F.col("lang").cast("string")
    )
    models = docs.sparkSession.sparkContext.broadcast(learn(rows_in, ~F.col("held_out"), rows, chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _predictor(models.value)(batches)

    return rows_in.drop("lang").select("doc_id", "held_out", "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double"
    )
