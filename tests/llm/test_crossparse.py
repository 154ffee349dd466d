from __future__ import annotations

import random

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reviewloom.llm import crossparse
from reviewloom.llm.common import held_out

SOUNDS = {"aa": "ba be bi bo bu".split(), "bb": "ka ke ki ko ku".split(), "cc": "жа же жи жо жу".split()}


def say(rng: random.Random, lang: str, n: int = 60) -> str:
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def phrases(codes: bytes, train: bytes) -> int:
    """Longest matches, one after the other, by searching the training text."""
    n = at = 0
    while at < len(codes):
        k = 1
        while at + k < len(codes) and codes[at : at + k + 1] in train:
            k += 1
        at, n = at + k, n + 1
    return n


@settings(max_examples=200, deadline=None)
@given(st.text("abcé -1Ж", max_size=60), st.text("abcé -1Ж", max_size=40))
def test_phrases_are_longest_matches(train, text):
    model = crossparse.Language(train)
    codes = model.codes(crossparse._symbols(text))
    if len(codes):
        assert model.phrases(codes[:, None])[0] == phrases(codes.tobytes(), model.codes(crossparse._symbols(train)).tobytes())


def test_stretches_side_by_side_count_alone():
    model = crossparse.Language("abracadabra abraham")
    rows = [model.codes(crossparse._symbols(t)) for t in ("abra", "zzz abracad", "a")]
    wide = np.zeros((max(map(len, rows)), 3), np.uint8)
    for i, row in enumerate(rows):
        wide[: len(row), i] = row
    assert model.phrases(wide).tolist() == [model.phrases(r[:, None])[0] for r in rows]


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 10**6), st.integers(70, 600))
def test_phrases_of_a_large_alphabet(seed, letters):
    rng = random.Random(seed)

    def say_many(n: int) -> str:
        return "".join(rng.choice(" a" + chr(0x4E00 + int(letters * rng.random() ** 2))) for _ in range(n))

    train, text = say_many(3000), say_many(300) + "Жñ"
    model = crossparse.Language(train)
    codes, learnt = model.codes(crossparse._symbols(text)), model.codes(crossparse._symbols(train))
    # one Unicode letter per code, so that searching cannot begin inside one
    as_text = lambda c: "".join(chr(0x100 + i) for i in c.tolist())
    assert model.phrases(codes[:, None])[0] == phrases(as_text(codes), as_text(learnt))
    assert set(codes[-2:].tolist()) == {crossparse._OTHER} and crossparse._OTHER not in learnt


def test_a_large_alphabet_takes_no_foreign_text():
    rng = random.Random(9)
    alphabets = {"aa": "etaoinshrdlucm", "bb": "enisratdhulcgm", "cc": "оеаинтсрвлкмдп"}
    spelt = {k: ["".join(rng.choice(v) for _ in range(rng.randrange(2, 9))) for _ in range(2000)] for k, v in alphabets.items()}
    zipf = [1 / (i + 10) for i in range(2500)]

    def write(lang: str, n: int) -> str:
        if lang == "zh":
            words = ("".join(chr(0x4E00 + i) for i in rng.choices(range(2500), zipf, k=rng.randrange(2, 12))) for _ in range(n))
            return "，".join(words)
        return " ".join(rng.choice(spelt[lang]) for _ in range(n))

    models = {lang: crossparse.Language(write(lang, 4000)[:20_000]) for lang in [*alphabets, "zh"]}
    for lang in models:
        for _ in range(10):
            symbols = crossparse._symbols(write(lang, 60))
            cost = {k: int(m.phrases(m.codes(symbols)[:, None])[0]) for k, m in models.items()}
            assert min(cost, key=cost.get) == lang


def test_languages_are_told_apart(spark, awkward, awkward_rows):
    rng = random.Random(4)
    rows = [(1000 + i, say(rng, lang), lang) for i in range(60) for lang in [sorted(SOUNDS)[i % 3]]]
    rows += [(2000, None, "aa"), (2001, "123 ... !!", "bb"), (2002, "", None), (None, say(rng, "cc"), None)]
    rows += [(2003, say(rng, "bb", 20_000), None), (1000, rows[0][1], "aa")]
    docs = spark.createDataFrame([(*r, "clash", 0.5) for r in rows], "doc_id long, text string, lang string, held_out string, score double")
    got = crossparse.identify(docs, held_out(F.col("doc_id"), 4, 2)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, text, lang in rows:
        if i is not None and 1000 <= i < 2000:
            assert by_id[i]["lang_pred"] == lang and 0.5 < by_id[i]["score"] <= 1
    assert [by_id[i]["lang_pred"] for i in (2000, 2001, 2002, None, 2003)] == ["und", "und", "und", "cc", "bb"]
    assert any(r["held_out"] for r in got) and not all(r["held_out"] for r in got)


def test_nothing_to_learn_and_empty_table(spark, awkward, nothing):
    held = held_out(F.col("doc_id"), 4, 2)
    blind = crossparse.identify(awkward.withColumn("lang", F.lit(None).cast("string")), held).collect()
    assert {(r["lang_pred"], r["score"]) for r in blind} == {("und", 0.0)}
    assert crossparse.identify(nothing, held).collect() == []


def test_few_long_texts_teach_as_much_as_many(spark):
    """Three long texts fill the sample; a language with a tenth of the text is not taken for others."""
    rng = random.Random(8)
    long = {lang: [say(rng, lang, 6000) for _ in range(3)] for lang in ("aa", "bb")}
    rows = [(i * 4, "#" * 3000 + t, lang) for lang in long for i, t in enumerate(long[lang], 1 if lang == "aa" else 11)]
    rows += [(400 + 4 * i, say(rng, "cc", 40), "cc") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = crossparse.learn(docs, F.lit(True))
    assert min(models[lang].length for lang in ("aa", "bb")) > 10_000
    ask = [(i, say(rng, lang, 60), lang) for i in range(30) for lang in [sorted(SOUNDS)[i % 3]]]
    more = spark.createDataFrame([(9000 + i, t, None) for i, t, _ in ask], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in crossparse.identify(docs.unionByName(more), F.col("doc_id") >= 9000).collect()}
    assert sum(got[9000 + i] == lang for i, _, lang in ask) >= 28
