"""Scores of a binary classifier from its confusion matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of class 0 and class 1.
CLASS_NAMES = ("stay", "churn")


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy(F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))
        .agg(F.count("*").alias("n"))
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def classification_metrics(predictions: DataFrame, class_names: Sequence[str] = CLASS_NAMES) -> DataFrame:
    """(metric, value): accuracy, label-weighted F1, precision and recall, recall per class,
    and auc_hard, the area under the curve of the hard prediction. One pass, one row in
    between; a ratio over nothing is 0."""
    label, guess = F.col("label") == 1, F.col("prediction") == 1
    counts = predictions.agg(
        F.count_if(label & guess).alias("tp"), F.count_if(~label & guess).alias("fp"),
        F.count_if(label & ~guess).alias("fn"), F.count_if(~label & ~guess).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    recall = (_ratio(tn, tn + fp), _ratio(tp, tp + fn))
    precision = (_ratio(tn, tn + fn), _ratio(tp, tp + fp))
    f1 = tuple(_ratio(2 * p * r, p + r) for p, r in zip(precision, recall))

    def weighted(by_class: Sequence[Column]) -> Column:
        return _ratio(by_class[0] * (tn + fp) + by_class[1] * (tp + fn), total)

    metrics = {
        "f1": weighted(f1),
        "accuracy": _ratio(tp + tn, total),
        "weighted_precision": weighted(precision),
        "weighted_recall": weighted(recall),
        "auc_hard": (recall[0] + recall[1]) / 2,
        f"recall_{class_names[0]}": recall[0],
        f"recall_{class_names[1]}": recall[1],
    }
    rows = [F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in metrics.items()]
    return counts.select(F.inline(F.array(*rows)))
