from __future__ import annotations

import random

from pyspark.sql import functions as F

from reviewloom.plans.sentiment import sentiment_job


def test_sentiment_job(spark, tmp_path):
    rng = random.Random(4)
    words = {1.0: ["awful", "broken", "refund"], 3.0: ["average", "okay", "plain"], 5.0: ["great", "love", "perfect"]}
    rows = []
    for i in range(240):
        rating = [1.0, 3.0, 5.0][i % 3]
        rows.append((i, rating, " ".join(rng.choices(words[rating] + ["the", "item", "was"], k=8))))
    rows += [(900, 5.0, None), (901, None, "no rating"), (902, 0.0, "out of range")]
    reviews = spark.createDataFrame(rows, "review_id long, rating double, processed_text string")
    target = str(tmp_path / "sentiment")
    job = sentiment_job(reviews, target, 50, 30, 30, grid=({"reg": 0.01, "n_features": 256}, {"reg": 0.5, "n_features": 256}))
    assert job.predictions.count() == 30 and job.scores.where("chosen").count() == 1
    right = job.predictions.where(F.col("label") == F.col("prediction")).count()
    assert job.overall.first().accuracy == right / 30 > 0.9
    assert [r.support for r in job.per_class.orderBy("class").collect()] == [10, 10, 10]
    cells = job.confusion.collect()
    assert sum(r.pred_0 + r.pred_1 + r.pred_2 for r in cells) == 30
    again = spark.read.csv(f"{target}/overall", header=True, inferSchema=True).first()
    assert again.accuracy == job.overall.first().accuracy
