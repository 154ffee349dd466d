from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from reviewloom.llm import recurrent
from reviewloom.llm.common import held_out


def tokens(text: str | None) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "<end>"]


def test_base_scores_of_every_text(awkward, awkward_rows):
    held = held_out(F.col("doc_id"), 10, 0)
    got = recurrent.score_texts(awkward, held).collect()
    marks = {r["doc_id"]: r["h"] for r in awkward.select("doc_id", held.alias("h")).distinct().collect()}
    count = Counter(t for i, text, *_ in awkward_rows if not marks[i] for t in tokens(text))
    total, kinds = sum(count.values()), len(count)
    want = []
    for i, text, *_ in awkward_rows:
        each = tokens(text)
        base = sum(math.log10((count[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in each)
        want.append((i, marks[i], len(each), sum(count[t] > 0 for t in each), total, round(base, 6)))
    have = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    assert all(r["score"] < 0 for r in got)
    # words drawn at random leave nothing to learn from their order
    assert sum(r["score"] for r in got if r["held_out"]) > 1.01 * sum(r["base_score"] for r in got if r["held_out"])


def test_order_is_learnt(spark):
    """Texts that walk through a fixed cycle of words score far better than by their words' counts."""
    words = [f"w{i}" for i in range(40)]
    rng = np.random.default_rng(6)
    texts = []
    for i in range(600):
        first = int(rng.integers(40))
        texts.append((i, " ".join(words[(first + 7 * j) % 40] for j in range(60))))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = recurrent.score_texts(docs, held_out(F.col("doc_id"), 10, 0)).where("held_out").collect()
    assert len(got) > 30
    assert sum(r["score"] for r in got) > 0.95 * sum(r["base_score"] for r in got)


def small_network(seed: int = 1) -> tuple[recurrent.Network, recurrent.Counts]:
    rng = np.random.default_rng(seed)
    counts = recurrent.Counts(10, 5, np.arange(recurrent._HEAD, dtype=np.uint64) << np.uint64(5), np.ones(32, np.int64), np.ones(32, np.int64))
    net = recurrent.Network.start(counts, rng.integers(1, 50, recurrent._HEAD).astype(float))
    return net.like(net.flat() + rng.standard_normal(net.flat().size) * 0.1), counts


def test_probabilities_sum_to_one():
    net, _ = small_network()
    h = np.random.default_rng(2).standard_normal((1, recurrent.HIDDEN)).astype(np.float32)
    every = np.arange(recurrent._HEAD + recurrent.OTHERS)
    like = net.log_likelihood(np.repeat(h, len(every), axis=0), every)
    assert abs(np.exp(like).sum() - 1) < 1e-4


def test_windows_and_neighbours_do_not_change_a_text():
    net, _ = small_network()
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, recurrent._HEAD + 32, n) for n in (700, 3, 1, 40)]
    alone = [recurrent.score_block(net, t, np.array([len(t)])) for t in texts]
    together = recurrent.score_block(net, np.concatenate(texts), np.array([len(t) for t in texts]))
    assert np.allclose(np.concatenate(alone), together, atol=1e-3)


def test_gradients_by_difference():
    net, _ = small_network()
    rng = np.random.default_rng(4)
    places = rng.integers(0, recurrent._HEAD + 32, 14)
    sizes = np.array([6, 5, 3])
    trainer = recurrent.Trainer(net)
    caught = []
    trainer._apply = lambda g: caught.append(g.flat().astype(float))
    trainer.block(places, sizes, np.ones(3, bool))
    flat = net.flat().astype(np.float64)
    loss = lambda f: -recurrent.score_block(net.like(f), places, sizes).mean()
    order = np.argsort(-np.abs(caught[0]))
    for at in np.concatenate([order[:20], order[200:1200:100]]):
        step = np.zeros_like(flat)
        step[at] = 3e-2
        slope = (loss(flat + step) - loss(flat - step)) / 6e-2
        assert abs(slope - caught[0][at]) < 2e-3 + 0.05 * abs(slope)


def test_empty_table_and_nothing_to_learn(awkward, nothing):
    assert recurrent.score_texts(nothing, held_out(F.col("doc_id"), 10, 0)).collect() == []
    blind = recurrent.score_texts(awkward, F.lit(True)).collect()
    assert {(r["base_score"], r["train_tokens"], r["n_known"]) for r in blind} == {(0.0, 0, 0)}
