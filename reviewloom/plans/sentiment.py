"""The sentiment job: from cleaned reviews to a stored model and its measures on unseen rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from reviewloom.operators import metrics, sentiment
from reviewloom.operators.quality import encode_label, sentiment_label
from reviewloom.operators.sampling import balanced_splits
from reviewloom.sources.sinks import write_metrics
from reviewloom.staging import settle

GRID = ({"reg": 0.01}, {"reg": 0.1})


@dataclass
class SentimentJob:
    """The model as loaded again, the candidates' scores, and tables of the test rows."""

    model: PipelineModel
    scores: DataFrame
    predictions: DataFrame
    overall: DataFrame
    per_class: DataFrame
    confusion: DataFrame


def sentiment_job(
    reviews: DataFrame,
    target: str,
    per_class: int = 200_000,
    val: int = 50_000,
    test: int = 50_000,
    grid: tuple[dict, ...] = GRID,
    text: str = "processed_text",
    seed: int = 42,
) -> SentimentJob:
    """Label, balance, train, keep the best on ``val``, save, load, predict ``test``, measure, write.

    ``reviews`` has ``review_id, rating`` and the cleaned text. The model goes to ``target/model``
    and the measures, as CSV, to ``target/overall``, ``target/per_class`` and
    ``target/confusion``; a run again replaces them.
    """
    labelled = sentiment_label(reviews).where(F.col(text).isNotNull())
    parts = settle(balanced_splits(labelled, per_class, val, test, seed), "balanced")
    part = lambda name: parts.where(F.col("split") == name)
    best, scores = sentiment.select_model(part("train"), part("val"), list(grid), text)
    best.write().overwrite().save(f"{target}/model")
    model = PipelineModel.load(f"{target}/model")
    predicted = settle(sentiment.predict_sentiment(model, encode_label(part("test"))), "predicted")
    tables = {
        "overall": metrics.weighted_metrics(predicted),
        "per_class": metrics.class_metrics(predicted),
        "confusion": metrics.confusion_matrix(predicted),
    }
    written = {name: write_metrics(table, f"{target}/{name}") for name, table in tables.items()}
    return SentimentJob(model, scores, predicted, written["overall"], written["per_class"], written["confusion"])
