"""The batch job: log -> clean log -> features -> tuned tree -> scores and rules.

    spark-submit --py-files ebbwatch.zip ebbwatch/plans/training_job.py LOG_PATH OUTPUT_PATH

LOG_PATH holds JSON lines; both paths go through Spark's file systems. The output folder
receives the cleaned log by date, the features, the model and the result tables.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ebbwatch.ml import models, trees
from ebbwatch.ml.tuning import TunedTree, tune_tree
from ebbwatch.operators.clean import clean_activity
from ebbwatch.plans.features import user_features
from ebbwatch.plans.modelling import ModelData, model_data
from ebbwatch.session import prepare_session, remove_scratch
from ebbwatch.sources import activity_log as logs


def train(
    spark: SparkSession,
    log_path: str,
    output_path: str,
    pages: Sequence[str] | None = None,
    compare: Sequence[str] = ("decision_tree",),
    max_bins: Sequence[int] = (10, 40),
    max_depth: Sequence[int] = (5, 15),
) -> dict[str, DataFrame]:
    """Run the job and return the result tables, all of which are also written.

    What an earlier run left in the output folder is replaced.
    """
    prepare_session(spark)
    clean = clean_activity(logs.read_json_log(spark, log_path))
    logs.land_clean_log(clean, f"{output_path}/clean_log")
    landed = logs.read_clean_log(spark, f"{output_path}/clean_log", clean.schema)
    features = user_features(landed, pages)
    data = model_data(features)
    logs.write_features_csv(data.features, f"{output_path}/features_csv")

    comparison = models.compare_models(data.train, data.validation, compare)
    tuned = tune_tree(data.train, data.names, max_bins, max_depth)
    trees.save_model(tuned.tree, f"{output_path}/tree")
    results = {"comparison": comparison, **_reports(spark, data, tuned, f"{output_path}/tree")}
    written = {}
    for name, table in results.items():
        table.write.mode("overwrite").parquet(f"{output_path}/{name}")
        written[name] = spark.read.parquet(f"{output_path}/{name}")
    return written


def _reports(spark: SparkSession, data: ModelData, tuned: TunedTree, tree_path: str) -> dict[str, DataFrame]:
    nodes = trees.read_nodes(spark, tree_path)
    return {
        "grid": tuned.grid(spark),
        "best_params": tuned.best_params(spark),
        "importances": tuned.importances(spark),
        "validation_metrics": models.evaluate(tuned.search.transform(data.validation)),
        "test_metrics": models.evaluate(tuned.pipeline.transform(data.test)),
        "nodes": trees.tree_nodes(nodes, data.names),
        "edges": trees.tree_edges(nodes, data.names),
        "rules": trees.tree_rules(nodes, data.names),
        "leaves": trees.leaf_profile(tuned.tree, data.rows, nodes, data.names),
    }


def main(arguments: Sequence[str]) -> int:
    if len(arguments) != 2:
        print(__doc__)
        return 2
    spark = SparkSession.builder.appName("ebbwatch-training").getOrCreate()
    try:
        for name, table in train(spark, *arguments).items():
            print(name)
            table.show(50, truncate=False)
    finally:
        remove_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
