"""Cross-validated tuning of the decision tree."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession

from ebbwatch.operators.sampling import SEED, add_fold

FOLDS = 3
FIT_ROWS = 12_500  # that one task of a fit reads; with more tasks, each reads more


@dataclass
class TunedTree:
    search: CrossValidatorModel
    names: list[str]

    @property
    def pipeline(self) -> PipelineModel:
        return self.search.bestModel

    @property
    def tree(self) -> DecisionTreeClassificationModel:
        return self.pipeline.stages[-1]

    def grid(self, spark: SparkSession) -> DataFrame:
        """(max_bins, max_depth, impurity, avg_f1): mean score over the folds per setting."""
        default = {p.name: v for p, v in self.tree.extractParamMap().items()}
        rows = []
        for params, score in zip(self.search.getEstimatorParamMaps(), self.search.avgMetrics):
            named = {p.name: v for p, v in params.items()}
            rows.append(
                (named["maxBins"], named["maxDepth"], named.get("impurity", default["impurity"]), float(score))
            )
        return spark.createDataFrame(rows, "max_bins int, max_depth int, impurity string, avg_f1 double")

    def best_params(self, spark: SparkSession) -> DataFrame:
        """(param, value) of the winning tree."""
        chosen = [(name, str(self.tree.getOrDefault(name))) for name in ("maxBins", "maxDepth", "impurity")]
        return spark.createDataFrame(chosen, "param string, value string")

    def importances(self, spark: SparkSession, k: int | None = None) -> DataFrame:
        """(feature, importance), most important first."""
        pairs = zip(self.names, (float(x) for x in self.tree.featureImportances.toArray()))
        frame = spark.createDataFrame(list(pairs), "feature string, importance double")
        ranked = frame.orderBy(frame.importance.desc(), frame.feature)
        return ranked if k is None else ranked.limit(k)


def gathered(rows: DataFrame) -> DataFrame:
    """The rows in as many partitions as the square root of their number calls for.

    At each level of a tree, each task of a fit keeps and sends a histogram of every open node, however few of its rows
    reach it. A deep tree has nodes in proportion to the rows, so the histograms grow with rows times tasks. The fits that
    run side by side share the cores.
    """
    return rows.coalesce(max(1, math.ceil(math.sqrt(rows.count() / FIT_ROWS))))


def tune_tree(
    train: DataFrame,
    names: Sequence[str],
    max_bins: Sequence[int] = (10, 40),
    max_depth: Sequence[int] = (5, 15),
    impurity: Sequence[str] | None = None,
    folds: int = FOLDS,
    parallelism: int = 8,
) -> TunedTree:
    """Search the grid by weighted F1 over folds that are fixed by user."""
    tree = DecisionTreeClassifier(featuresCol="features", labelCol="label", seed=SEED)
    grid = ParamGridBuilder().addGrid(tree.maxBins, list(max_bins)).addGrid(tree.maxDepth, list(max_depth))
    if impurity:
        grid = grid.addGrid(tree.impurity, list(impurity))
    search = CrossValidator(
        estimator=Pipeline(stages=[tree]),
        estimatorParamMaps=grid.build(),
        evaluator=MulticlassClassificationEvaluator(metricName="f1"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    ).fit(gathered(add_fold(train, folds).select("userId", "label", "features", "fold")))
    return TunedTree(search, list(names))
