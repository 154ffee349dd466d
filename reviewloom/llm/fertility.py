"""Quality rules by tokenizer fertility.

A public vocabulary is measured on each text: characters per token, the share of tokens
that fall back to single bytes, and the entropy of the token distribution. Ordinary prose
of a language lies in a band of each; texts outside a band are rejected. The bands come
from the quartiles of all texts of a language, inside wide fixed bands per script. A few
plain counts (words, symbols, repeated lines and words) come with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.llm import wordids
from reviewloom.llm.common import SPACE, hash_spans, mix, pieces, text_bytes, windows, word_spans
from reviewloom.shipping import ship
from reviewloom.staging import settle

MIN_WORDS, MAX_REPEATED = 50, 50  # below so many words, or above so many percent in repeats: rejected
FENCE, LEAST = 1.5, 100  # quartile ranges a text may lie off the quartiles; texts that a learnt band needs

# Fixed values. Bands per script: least and most characters per token, most share of byte
# tokens, least entropy of tokens in bits.
BANDS = {
    "latin": (1.6, 6.0, 0.10, 4.0),
    "greek": (0.8, 4.0, 0.40, 4.0),
    "cyrillic": (1.2, 5.0, 0.30, 4.0),
    "hebrew": (0.6, 4.0, 0.60, 3.5),
    "arabic": (0.6, 4.0, 0.60, 3.5),
    "indic": (0.4, 4.0, 0.90, 3.0),
    "kana": (0.5, 4.0, 0.60, 4.0),
    "han": (0.4, 3.0, 0.80, 4.0),
    "hangul": (0.3, 3.0, 0.95, 3.0),
    "other": (0.25, 8.0, 0.98, 2.0),
}
SCRIPTS = list(BANDS)
SYMBOLS = b"#*$%&|<>"

_SCRIPT = np.full(256, len(SCRIPTS), np.int64)  # by the first byte of a character
for _name, _first, _last in (
    ("latin", 0x41, 0x5A), ("latin", 0x61, 0x7A), ("latin", 0xC3, 0xCA), ("greek", 0xCD, 0xCF),
    ("cyrillic", 0xD0, 0xD4), ("hebrew", 0xD6, 0xD7), ("arabic", 0xD8, 0xDB), ("indic", 0xE0, 0xE0),
    ("kana", 0xE3, 0xE3), ("han", 0xE4, 0xE9), ("hangul", 0xEA, 0xED), ("other", 0xF0, 0xF4),
):
    _SCRIPT[_first : _last + 1] = SCRIPTS.index(_name)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, n_byte_tokens long, chars_per_token double, byte_share double, entropy double, script string, "
    "base_failed boolean, kept boolean"
)


def _per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def _repeats(key: np.ndarray) -> np.ndarray:
    """How often each value occurs among all of them."""
    _, back, counts = np.unique(key, return_inverse=True, return_counts=True)
    return counts[back]


def _salted(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Values that are equal only within a row."""
    return mix(values ^ mix(row.astype(np.uint64) + np.uint64(1)))


def measure(data: np.ndarray, offsets: np.ndarray, memory: wordids.WordIds, is_byte: np.ndarray) -> dict:
    """All counts of a run of texts, each as one array over the texts."""
    n = len(offsets) - 1
    starts, ends, at = word_spans(data, offsets)
    words = np.diff(at)
    row = np.repeat(np.arange(n), words)
    out = {"n_words": words, "n_symbols": _per_row(_SYMBOL[data], offsets)}
    begin = (data & 0xC0) != 0x80
    out["word_chars"] = _per_row(begin & ~SPACE[data], offsets)

    breaks = np.flatnonzero(data == 10)
    first = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks + 1]))
    first = first[first < len(data)]
    last = np.minimum(np.concatenate([first[1:], [len(data)]]), len(data)).astype(np.int64)
    last = last - (data[last - 1] == 10)
    filled = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    first, last = first[filled], last[filled]
    line_row = np.searchsorted(offsets, first, "right") - 1
    lines = _salted(hash_spans(data, first, last), line_row)
    distinct = np.unique(lines, return_index=True)[1]
    out["n_dup_lines"] = np.bincount(line_row, minlength=n) - np.bincount(line_row[distinct], minlength=n)

    hashes = hash_spans(data, starts, ends)
    three, whole = windows(hashes, at, 3)
    twice = np.zeros(len(hashes), bool)
    if whole.any():
        hit = np.flatnonzero(whole)[_repeats(_salted(three[whole], row[whole])) > 1]
        for step in range(3):
            twice[hit + step] = True
    out["n_repeat_words"] = np.bincount(row[twice], minlength=n)

    ids, sizes = memory.lookup(data, starts, ends, hashes)
    tokens = np.bincount(row, sizes, minlength=n).astype(np.int64)
    token_row = np.repeat(np.arange(n), tokens)
    out["n_tokens"] = tokens
    out["n_byte_tokens"] = np.bincount(token_row, is_byte[ids], minlength=n).astype(np.int64)
    kinds, counts = np.unique(token_row * len(is_byte) + ids, return_counts=True)
    kind_row = kinds // len(is_byte)
    some = np.maximum(tokens, 1)
    share = counts / some[kind_row]
    out["entropy"] = np.bincount(kind_row, -share * np.log2(share), minlength=n) if len(kinds) else np.zeros(n)
    out["chars_per_token"] = out["word_chars"] / some
    out["byte_share"] = out["n_byte_tokens"] / some

    char_row = np.repeat(np.arange(n), np.diff(offsets))
    script = np.bincount(char_row * (len(SCRIPTS) + 1) + _SCRIPT[data], minlength=n * (len(SCRIPTS) + 1))
    out["script"] = script.reshape(n, -1)[:, :-1].argmax(axis=1)
    return out


def _judge(m: dict, bands: dict[str, tuple[float, float, float, float]]) -> dict:
    low, high, most_bytes, least_bits = np.array([bands[s] for s in SCRIPTS])[m["script"]].T
    m["base_failed"] = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED * m["n_words"])
    inside = (m["chars_per_token"] >= low) & (m["chars_per_token"] <= high)
    m["kept"] = ~m["base_failed"] & inside & (m["byte_share"] <= most_bytes) & (m["entropy"] >= least_bits)
    m["script"] = np.array(SCRIPTS, object)[m["script"]]
    return m


def _measured(docs: DataFrame, path: str, bands: dict) -> DataFrame:
    """``docs`` with its measures and the verdict of ``bands`` as a last column, the struct ``__measures``."""
    ship(docs.sparkSession)
    at = docs.columns.index("text")
    fields = MEASURES.split(", ")
    names = [f.split()[0] for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, is_byte = wordids.pieces_with_bytes(path)
        for batch in batches:
            data, offsets = text_bytes(batch.column(at))
            for first, last in pieces(offsets, 1 << 22):
                low = offsets[first]
                found = _judge(measure(data[low : offsets[last]], offsets[first : last + 1] - low, memory, is_byte), bands)
                measures = pa.StructArray.from_arrays([pa.array(found[c]) for c in names], names)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns, measures], names=[*batch.schema.names, "__measures"])

    struct = ", ".join(f.replace(" ", ": ") for f in fields)
    schema = docs.withColumn("__measures", F.lit(None).cast(f"struct<{struct}>")).schema
    return docs.mapInArrow(run, schema)


def learn_bands(measured: DataFrame) -> DataFrame:
    """Bands by script and ``__lang``, from the quartiles of the texts that pass the base rule.

    A band ends ``FENCE`` quartile ranges off the quartiles (values to three decimals, so
    that the aggregation holds few of them). Where the quartiles agree there is no spread to
    learn from, and groups of fewer than ``LEAST`` texts are left out: the fixed bands hold.
    """
    m = measured.where("not __measures.base_failed").select("__lang", "__measures.*")
    quartiles = [
        F.percentile(F.round(c, 3), [0.25, 0.75]).alias(c) for c in ("chars_per_token", "byte_share", "entropy")
    ]
    found = m.groupBy("script", "__lang").agg(F.count("*").alias("n"), *quartiles).where(F.col("n") >= LEAST)

    def end(name: str, upper: int) -> Column:
        low, high = F.get(name, F.lit(0)), F.get(name, F.lit(1))
        return F.when(high > low, high + FENCE * (high - low) if upper else low - FENCE * (high - low))

    bands = found.select(
        F.col("script").alias("__of"), F.col("__lang").alias("__in"), end("chars_per_token", 0).alias("__low"),
        end("chars_per_token", 1).alias("__high"), end("byte_share", 1).alias("__bytes"), end("entropy", 0).alias("__bits"),
    )
    return settle(bands, "bands")


def _inside(measured: DataFrame, bands: DataFrame) -> DataFrame:
    """``measured`` with the verdict of fixed and learnt bands as ``__kept``."""
    m = "__measures."
    out = (F.col(m + "chars_per_token") < F.col("__low")) | (F.col(m + "chars_per_token") > F.col("__high"))
    out = F.coalesce(out, F.lit(False)) | F.coalesce(F.col(m + "byte_share") > F.col("__bytes"), F.lit(False))
    out = out | F.coalesce(F.col(m + "entropy") < F.col("__bits"), F.lit(False))
    same = (F.col(m + "script") == F.col("__of")) & F.col("__lang").eqNullSafe(F.col("__in"))
    return measured.join(bands, same, "left").withColumn("__kept", F.col(m + "kept") & ~out)


def _language(docs: DataFrame) -> Column:
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return lang.alias("__lang")


def fertility(
    docs: DataFrame, path: str, bands: dict[str, tuple[float, float, float, float]] | None = None
) -> DataFrame:
    """Counts, fertility measures and verdict of each text: one row per input row.

    ``path`` names the vocabulary file on every executor. Without ``bands`` they are learnt
    per script and ``lang`` (null, or no such column: a language of its own) from all texts,
    inside ``BANDS``. Null and empty texts have no words and are rejected; texts without
    letters count as ``latin``. A null doc_id stays null, equal rows get equal results, an
    empty table gives an empty result, and other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), _language(docs))
    measured = _measured(rows, path, bands or BANDS).drop("text")
    kept = F.col("__measures.kept")
    if bands is None:
        measured = settle(measured, "measures")
        measured, kept = _inside(measured, learn_bands(measured)), F.col("__kept")
    return measured.select("doc_id", "__measures.*", kept.alias("__kept")).withColumn("kept", F.col("__kept")).drop("__kept")


def keep_fertile(
    docs: DataFrame, path: str, bands: dict[str, tuple[float, float, float, float]] | None = None
) -> DataFrame:
    """The rows of ``docs`` whose text passes, all columns as they are; no text is shuffled.

    Without ``bands`` the texts are measured twice: to learn the bands, and to judge.
    """
    rows = docs.select("*", _language(docs))
    if bands is None:
        narrow = docs.select(F.col("text").cast("string"), _language(docs))
        measured = _inside(_measured(rows, path, BANDS), learn_bands(_measured(narrow, path, BANDS).drop("text")))
        return measured.where("__kept").select(*docs.columns)
    return _measured(rows, path, bands).where("__measures.kept").select(*docs.columns)
