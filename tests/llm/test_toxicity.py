from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reviewloom.llm import toxicity
from reviewloom.llm.common import held_out

INSULTS = ["idiot", "worthless", "scumbag"]


def kernel(a: bytes, b: bytes) -> float:
    """Shared three-letter subsequences, each weighted by the letters it spans in both words."""
    def spans(w):
        return [(bytes(w[i] for i in at), toxicity.DECAY ** (at[2] - at[0] + 1)) for at in combinations(range(len(w)), 3)]

    return sum(x * y for u, x in spans(a) for v, y in spans(b) if u == v)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abcd", min_size=3, max_size=7), min_size=1, max_size=4))
def test_self_kernel_and_vectors(words):
    for word in words:
        w = toxicity.letters(word.encode())
        codes = np.frombuffer(w, np.uint8)[None, :]
        assert np.isclose(toxicity.self_kernel(codes)[0], kernel(w, w))
        other = toxicity.letters(words[0].encode())
        like = kernel(w, other) / np.sqrt(kernel(w, w) * kernel(other, other))
        assert np.isclose(toxicity.vector(w) @ toxicity.vector(other), like)


@pytest.fixture(scope="module")
def talk(spark):
    rng = random.Random(6)
    usual = ["".join(rng.choice("tr ea no li su me".split()) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    rows, marks = [], []
    for i in range(240):
        words = [rng.choice(usual) for _ in range(40)]
        toxic = i % 3 == 0
        if toxic:
            for insult in rng.sample(INSULTS, 2):
                words[rng.randrange(40)] = insult
        rows.append((i, " ".join(words) + ".", None))
        marks.append((i, 1, int(toxic)))
    rows += [(500, "you i d i o t indeed", None), (501, None, None), (502, "", None), (503, "idxiot " * 3, None), (504, "x" * 50_000, None)]
    rows += [(505, "tre " * 30_000 + "wo-rth-less", None), (None, "such an Idiot!", None), (500, "you i d i o t indeed", None)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lang string, score string, toxic int")
    labels = spark.createDataFrame(marks + [(3, 1, 1), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    return docs, labels, rows, dict((i, t) for i, _, t in marks)


def test_held_out_texts(spark, talk):
    docs, labels, rows, truth = talk
    got = toxicity.score_toxicity(docs, labels, held_out(F.col("doc_id"), 4, 2)).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 30 and all(r["predicted"] == truth[r["doc_id"]] for r in held)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["predicted"] == 1 for i in (500, 505, None))  # spelled out, broken up, capital
    assert by_id[501]["score"] == by_id[502]["score"] <= min(r["score"] for r in got) + 1e-9
    assert by_id[503]["score"] > 2 * by_id[502]["score"]  # an inserted letter keeps much of the likeness
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_rare_forms_tell_beside_frequent_insults():
    chance = [{b"blehaing"}] * 4  # four toxic texts and no clean one, but clean relatives
    forms = [{b"bomente" + end, b"que"} for end in (b"ado", b"co", b"dora", b"ga") for _ in range(4)]
    toxic = [{b"idiot", b"the"}] * 120 + forms + chance
    clean = [{b"the", b"que"}] * 1000 + [{b"blehain"}, {b"blehaon"}] * 60
    want = sorted([b"idiot"] + [b"bomente" + end for end in (b"ado", b"co", b"dora", b"ga")])
    assert toxicity.telling_words(toxic, clean) == want


def test_only_near_copies_of_one_label_go():
    rng = random.Random(8)
    words = [f"word{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(20)]  # the same words in another order
    near = texts[3].replace("word7 ", "changed ", 1)
    assert toxicity.unlike_texts([*texts, near, near], [0] * 21 + [1]) == [*range(20), 21]


def test_no_toxic_examples_and_empty_table(spark, talk, nothing):
    docs, labels, *_ = talk
    held = held_out(F.col("doc_id"), 4, 2)
    assert {r["predicted"] for r in toxicity.score_toxicity(docs, labels.where("toxic = 0"), held).collect()} == {0}
    assert toxicity.score_toxicity(nothing, labels, held).collect() == []
