from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from reviewloom.operators import articles, metrics, sentiment, stats

GUESSES = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)] + [(2, 0)] * 4


@pytest.fixture(scope="module")
def guesses(spark):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(GUESSES)], "id long, label int, prediction int")


def test_confusion_and_class_metrics(guesses):
    matrix = {r.label: tuple(r)[1:] for r in metrics.confusion_matrix(guesses).collect()}
    assert matrix == {0: (5, 2, 0), 1: (1, 3, 0), 2: (4, 0, 0)}
    out = {r["class"]: r for r in metrics.class_metrics(guesses).collect()}
    assert (out[0].precision, out[0].recall, out[0].support) == (0.5, 5 / 7, 7)
    assert (out[2].precision, out[2].recall, out[2].f1, out[2].support) == (0.0, 0.0, 0.0, 4)


def test_missing_classes_are_listed_with_zeros(guesses):
    out = {r["class"]: r.support for r in metrics.class_metrics(guesses.where("label = 0 and prediction = 0")).collect()}
    assert out == {0: 5, 1: 0, 2: 0}


def test_weighted_metrics_agree_with_spark_ml(guesses):
    row = metrics.weighted_metrics(guesses).first()
    scored = guesses.select(F.col("label").cast("double"), F.col("prediction").cast("double"))
    for name, value in {"accuracy": row.accuracy, "weightedPrecision": row.precision, "weightedRecall": row.recall, "f1": row.f1}.items():
        assert MulticlassClassificationEvaluator(metricName=name).evaluate(scored) == pytest.approx(value)


def test_class_weights(spark, guesses):
    out = {r.label: r.weight for r in metrics.class_weights(guesses).collect()}
    assert out == {0: pytest.approx(15 / 21), 1: pytest.approx(15 / 12), 2: pytest.approx(15 / 12)}
    one = spark.createDataFrame([(0,)] * 4, "label int")
    assert [r.weight for r in metrics.class_weights(one).collect()] == [1.0]


def test_smoothed_loss(spark):
    rng = np.random.default_rng(5)
    raw = rng.dirichlet([2, 2, 2], size=10)
    labels = [int(x) for x in rng.integers(0, 3, 10)]
    df = spark.createDataFrame([(i, labels[i], [float(x) for x in raw[i]]) for i in range(10)], "id long, label int, probability array<double>")
    weights = {0: 0.5, 1: 2.0, 2: 1.0}
    table = spark.createDataFrame(list(weights.items()), "label int, weight double")
    got = metrics.smoothed_loss(df, table, smoothing=0.1, batch_size=4, seed=42).first()
    order = sorted(range(10), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    losses = []
    for at in (0, 4, 8):
        batch, top, bottom = order[at : at + 4], 0.0, 0.0
        for i in batch:
            w = weights[labels[i]]
            top += 0.9 * w * -math.log(raw[i][labels[i]]) + 0.1 / 3 * sum(weights[c] * -math.log(raw[i][c]) for c in range(3))
            bottom += w
        losses.append(top / bottom)
    assert got.n_batches == 3 and got.loss == pytest.approx(np.mean(losses))


ARTICLE = """
    Title: Compare Three Pairs of Earbuds

    Introduction: What we looked at.

    TOP 3 RECOMMENDED PRODUCTS:
    1. Product A
    Key Strengths: long battery life

    WORST PRODUCT WARNING:
    Product D breaks early.

    Final Verdict:
    Choose what fits you.
    """


def test_section_metrics_precision_can_pass_one(spark):
    df = spark.createDataFrame([("x", ARTICLE), ("y", "no headers"), ("z", "")], "article_id string, generated string")
    out = {r.article_id: r for r in articles.section_metrics(df).collect()}
    assert (out["x"].accuracy, out["x"].recall, out["x"].precision) == (1.0, 1.0, 5 / 3)
    assert [out[k].f1 for k in "yz"] == [0.0, 0.0]
    assert articles.section_metrics(df, clamp=True).where("article_id = 'x'").first().precision == 1.0


def test_product_metrics(spark):
    source, generated = "Product: Test A\nProduct: Test B", "Product: Test A\nProduct: Test C"
    df = spark.createDataFrame([("x", generated, source), ("y", "nothing", source), ("z", generated, "")], "article_id string, generated string, source string")
    out = {r.article_id: r for r in articles.product_metrics(df).collect()}
    assert (out["x"].precision, out["x"].recall, out["x"].accuracy, out["x"].f1) == (0.5, 0.5, 0.5, 0.5)
    assert (out["y"].precision, out["z"].accuracy, out["z"].f1) == (0.0, 0.0, 0.0)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(*[st.lists(st.sampled_from("ABCDE"), max_size=5)] * 2), min_size=10, max_size=20))
def test_swapping_sides_swaps_precision_and_recall(spark, pairs):
    def text(names):
        return "\n".join(f"Product: {n}" for n in names)

    df = spark.createDataFrame([(str(i), text(a), text(b)) for i, (a, b) in enumerate(pairs)], "article_id string, generated string, source string")
    there = {r.article_id: r for r in articles.product_metrics(df).collect()}
    back = {r.article_id: r for r in articles.product_metrics(df, "source", "generated").collect()}
    for key, row in there.items():
        assert (row.precision, row.recall, row.f1) == (back[key].recall, back[key].precision, back[key].f1)


def test_soft_match(spark):
    rng = np.random.default_rng(2)
    table = rng.normal(size=(50, 8))
    vectors = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(table)], "vec_id long, vector array<double>")
    pairs = [("x", "a b b c", "a d"), ("y", "same words", "same words"), ("z", "", "a")]
    df = spark.createDataFrame(pairs, "article_id string, generated string, source string")
    out = {r.article_id: r for r in articles.soft_match_score(df, vectors, 50).collect()}

    def unit(word):
        v = table[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 50]
        return v / np.linalg.norm(v)

    g, s = [unit(w) for w in "abbc"], [unit(w) for w in "ad"]
    precision = np.mean([max(a @ b for b in s) for a in g])
    recall = np.mean([max(a @ b for b in g) for a in s])
    assert (out["x"].precision, out["x"].recall) == (pytest.approx(precision), pytest.approx(recall))
    assert out["y"].f1 == pytest.approx(1.0) and out["z"].f1 == 0.0


def test_evaluation_table(spark):
    df = spark.createDataFrame([("x", ARTICLE, "Product: D"), ("y", "Product: D", "Product: D")], "article_id string, generated string, source string")
    parts = {"structure": articles.section_metrics(df), "products": articles.product_metrics(df)}
    out = {r.metric: r for r in articles.evaluation_table(parts).collect()}
    assert set(out) == set(articles.MEASURES) and out["accuracy"].structure == 0.5


def test_quartiles_are_exact(spark):
    rng = np.random.default_rng(8)
    values = [float(x) for x in np.concatenate([np.full(400, 0.5), rng.random(37)])]
    df = spark.createDataFrame([(v, 1 - v, None) for v in values], "a double, b double, c double")
    out = {(r.metric, r.quantile): r.value for r in stats.metric_quartiles(df, ["a", "b", "c"]).collect()}
    for q in stats.QUARTILES:
        assert out[("a", q)] == pytest.approx(np.quantile(values, q))
        assert out[("b", q)] == pytest.approx(np.quantile([1 - v for v in values], q))
    assert len(out) == 10


def test_sentiment_model(spark):
    words = {"Negative": "bad broken awful", "Neutral": "okay average fine", "Positive": "great lovely superb"}
    rows = [(f"{w} item {i}", s) for s, ws in words.items() for i in range(30 if s != "Neutral" else 10) for w in ws.split()]
    df = spark.createDataFrame(rows, "processed_text string, sentiment string")
    train, val = df.where("processed_text not like '%7'"), df.where("processed_text like '%7'")
    grid = [{"n_features": 1, "reg": 50.0, "max_iter": 2}, {"n_features": 256, "reg": 0.01}]
    model, table = sentiment.select_model(train, val, grid)
    scores = {r.candidate: r for r in table.collect()}
    assert scores[1].chosen and scores[1].f1 > 0.95 and not scores[0].chosen
    out = sentiment.predict_sentiment(model, val).collect()
    assert all(len(r.probability) == 3 and abs(sum(r.probability) - 1) < 1e-9 for r in out)
    assert all(r.prediction == int(np.argmax(r.probability)) for r in out)
