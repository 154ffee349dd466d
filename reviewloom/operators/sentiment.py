"""Sentiment model on Spark ML: word counts, idf, multinomial logistic regression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame, functions as F

from reviewloom.operators.metrics import class_weights
from reviewloom.operators.quality import encode_label
from reviewloom.staging import settle

# Starting points of a model search; every entry overrides the defaults below.
DEFAULTS = {"n_features": 1 << 16, "reg": 0.01, "max_iter": 20}


def _prepared(df: DataFrame, text: str) -> DataFrame:
    labelled = df if "label" in df.columns else encode_label(df)
    return labelled.where(F.col("label").isNotNull() & F.col(text).isNotNull())


@dataclass
class Hashed:
    """Labelled texts as hashed word counts, written once, and the steps that made them."""

    steps: list
    rows: DataFrame


def hash_texts(train: DataFrame, text: str = "processed_text", n_features: int = DEFAULTS["n_features"]) -> Hashed:
    """Read the texts once; fitting runs on what is written here."""
    tokens = RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"\s+")
    counts = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=n_features)
    hashed = counts.transform(tokens.transform(_prepared(train, text)))
    return Hashed([tokens, counts], settle(hashed.select("label", "_tf"), "hashed"))


def fit_hashed(hashed: Hashed, reg: float = DEFAULTS["reg"], max_iter: int = DEFAULTS["max_iter"]) -> PipelineModel:
    """Fit the model; rarer classes weigh more, in proportion."""
    rows = hashed.rows
    idf = IDF(inputCol="_tf", outputCol="_features").fit(rows)
    weighted = rows.join(class_weights(rows).select("label", "weight"), "label")
    regression = LogisticRegression(
        featuresCol="_features",
        labelCol="label",
        weightCol="weight",
        family="multinomial",
        regParam=reg,
        maxIter=max_iter,
        probabilityCol="_probability",
        predictionCol="_prediction",
    )
    return PipelineModel([*hashed.steps, idf, regression.fit(idf.transform(weighted))])


def train_sentiment(train: DataFrame, text: str = "processed_text", **params) -> PipelineModel:
    """Hash the texts and fit the model on them."""
    setting = {**DEFAULTS, **params}
    return fit_hashed(hash_texts(train, text, setting["n_features"]), setting["reg"], setting["max_iter"])


def predict_sentiment(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``probability`` (array) and ``prediction`` (the most likely class)."""
    out = model.transform(df)
    return out.select(
        *df.columns,
        vector_to_array("_probability").alias("probability"),
        F.col("_prediction").cast("int").alias("prediction"),
    )


def f1_on(model: PipelineModel, df: DataFrame, text: str = "processed_text") -> float:
    scored = model.transform(_prepared(df, text))
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="_prediction", metricName="f1")
    return evaluator.evaluate(scored)


def select_model(
    train: DataFrame, val: DataFrame, grid: list[dict], text: str = "processed_text"
) -> tuple[PipelineModel, DataFrame]:
    """Fit one model per parameter set and keep the best weighted F1 on ``val``.

    The texts are hashed once per number of features, whatever else the sets differ in. Also returns the scores: ``candidate, params, f1, chosen``.
    """
    settings = [{**DEFAULTS, **params} for params in grid]
    hashed = {n: hash_texts(train, text, n) for n in sorted({s["n_features"] for s in settings})}
    models = [fit_hashed(hashed[s["n_features"]], s["reg"], s["max_iter"]) for s in settings]
    scores = [f1_on(m, val, text) for m in models]
    best = max(range(len(grid)), key=lambda i: scores[i])
    rows = [(i, str(sorted(p.items())), scores[i], i == best) for i, p in enumerate(grid)]
    table = val.sparkSession.createDataFrame(rows, "candidate int, params string, f1 double, chosen boolean")
    return models[best], table
