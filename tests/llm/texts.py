"""Makers of documents for the tests."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "kept boolean, n_words long, key string, id long, part long, size long, words string"
)
SYLLABLES = "man ter ion per stand ing com port der ful".split()
SPACES = [" ", "  ", "\n", "\t", " \r\n", "\x0b"]


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    word = lambda: "".join(SYLLABLES[int(d)] for d in str(rng.randrange(vocabulary)))
    words = [word() if rng.random() < 0.8 else rng.choice(["Ünï", "the", "THE", "été."]) for _ in range(n)]
    return "".join(w + rng.choice(SPACES) for w in words)


def table(spark, rows: list[tuple]):
    """Documents from (doc_id, text, lang, source), with columns that clash with internal names."""
    full = [(i, t, g, s, None, False, -1, "x", 7, 8, 9, "clash") for i, t, g, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)
