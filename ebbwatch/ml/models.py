"""Classifiers by name, and their scores."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbwatch.operators.ranking import auc_ranked
from ebbwatch.operators.sampling import SEED
from ebbwatch.operators.scoring import CLASS_NAMES, classification_metrics
from ebbwatch.session import write_table

# The names of the classifiers, and the settings they are compared with.
CLASSIFIERS: dict[str, Callable[[], Estimator]] = {
    "decision_tree": lambda: DecisionTreeClassifier(seed=SEED),
    "logistic_regression": lambda: LogisticRegression(maxIter=10000),
    "random_forest": lambda: RandomForestClassifier(seed=SEED),
    "gradient_boosting": lambda: GBTClassifier(seed=SEED),
}


def classifier(name: str, **params) -> Estimator:
    """The named classifier; ``params`` override its settings."""
    if name not in CLASSIFIERS:
        raise ValueError(f"unknown classifier {name!r}; known: {', '.join(CLASSIFIERS)}")
    return CLASSIFIERS[name]().setParams(**params)


def fit_predict(train: DataFrame, test: DataFrame, name: str, **params) -> tuple[Model, DataFrame]:
    """Fit the named classifier on ``train`` and add its predictions to ``test``."""
    model = classifier(name, **params).fit(train)
    return model, model.transform(test)


def prediction_rows(predictions: DataFrame) -> DataFrame:
    """(userId, label, prediction, p_churn)."""
    return predictions.select(
        "userId", "label", F.col("prediction").cast("int").alias("prediction"),
        F.get(vector_to_array("probability"), F.lit(1)).alias("p_churn"),
    )


def evaluate(predictions: DataFrame, class_names: Sequence[str] = CLASS_NAMES) -> DataFrame:
    """(metric, value): the scores of the hard prediction, and auc from the raw scores."""
    if "rawPrediction" not in predictions.columns:
        return classification_metrics(predictions, class_names)
    # The model scores each row once; all metrics read the written scores.
    score = F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("score")
    predictions = write_table(predictions.select("label", "prediction", score), "scores")
    hard = classification_metrics(predictions, class_names)
    return hard.unionByName(auc_ranked(predictions).select(F.lit("auc").alias("metric"), F.col("auc").alias("value")))


def compare_models(train: DataFrame, test: DataFrame, names: Iterable[str] = tuple(CLASSIFIERS)) -> DataFrame:
    """(model, metric, value) for each named classifier."""
    scores = []
    for name in names:
        _, predictions = fit_predict(train, test, name)
        scores.append(evaluate(predictions).select(F.lit(name).alias("model"), "metric", "value"))
    return reduce(DataFrame.unionByName, scores)
