import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from ebbwatch.ml import models, prepare, trees, tuning
from ebbwatch.ml.tuning import tune_tree
from ebbwatch.operators.sampling import data_split
from ebbwatch.plans.features import complete_rows
from ebbwatch.plans.modelling import model_data

TRAIN_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def data(spark):
    return registry._model_data(spark, TRAIN_DIR)


@pytest.fixture(scope="module")
def tuned(data):
    return tune_tree(data.train, data.names)


@pytest.fixture(scope="module")
def nodes(spark, tuned, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('tree')}/tree"
    trees.save_model(tuned.tree, path)
    return trees.read_nodes(spark, path).persist()


def scores(frame):
    return {r.metric: r.value for r in frame.collect()}


def test_pipeline_keeps_exactly_the_complete_rows(data):
    complete = complete_rows(data.features)
    assert sorted(r.userId for r in data.rows.select("userId").collect()) == sorted(
        r.userId for r in complete.select("userId").collect()
    )


def test_indexed_columns_enter_the_vector_on_request_only(data):
    rows = prepare.prepare(data.features, include_indexed=True)
    assert rows[1] == [*data.names, "gender_index", "location_index", "valid_level_index"]
    assert rows[2].head().features.size == len(data.names) + 3
    assert data.rows.head().features.size == len(data.names)
    assert "last_interaction" not in prepare.prepare(data.features, exclude=["last_interaction"])[1]


@pytest.mark.parametrize("name", sorted(models.CLASSIFIERS))
def test_each_classifier_scores_within_bounds(data, name):
    _, predictions = models.fit_predict(data.train, data.validation, name)
    found = scores(models.evaluate(predictions))
    assert set(found) == {
        "f1", "accuracy", "weighted_precision", "weighted_recall", "auc_hard", "recall_stay", "recall_churn", "auc",
    }
    assert all(0 <= v <= 1 for v in found.values())
    rows = models.prediction_rows(predictions)
    assert rows.count() == data.validation.count()
    assert rows.where("prediction not in (0, 1) or p_churn < 0 or p_churn > 1").isEmpty()


def test_unknown_classifier():
    with pytest.raises(ValueError, match="unknown classifier"):
        models.classifier("perceptron")


def test_settings_can_be_overridden():
    assert models.classifier("logistic_regression").getMaxIter() == 10000
    assert models.classifier("logistic_regression", maxIter=100).getMaxIter() == 100


def test_grid_and_best_parameters(spark, tuned):
    grid = tuned.grid(spark).collect()
    assert {(r.max_bins, r.max_depth) for r in grid} == {(10, 5), (10, 15), (40, 5), (40, 15)}
    best = max(grid, key=lambda r: r.avg_f1)
    chosen = {r.param: r.value for r in tuned.best_params(spark).collect()}
    assert any(
        r.avg_f1 == best.avg_f1 and (str(r.max_bins), str(r.max_depth)) == (chosen["maxBins"], chosen["maxDepth"])
        for r in grid
    )


def test_search_gives_the_same_scores_for_any_partitioning(spark, data, tuned):
    # One setting is enough; folds follow the user, not the layout.
    one = tune_tree(data.train.coalesce(1), data.names, [10], [5]).grid(spark).head().avg_f1
    many = tune_tree(data.train.repartition(5), data.names, [10], [5]).grid(spark).head().avg_f1
    assert one == pytest.approx(many)


def test_fits_read_few_partitions(spark, data, monkeypatch):
    read = []
    monkeypatch.setattr(tuning.CrossValidator, "fit", lambda self, frame: read.append((frame.rdd.getNumPartitions(), frame.count())))
    rows = data.train.repartition(40)
    tune_tree(rows, data.names)
    monkeypatch.setattr(tuning, "FIT_ROWS", rows.count() / 8)
    tune_tree(rows, data.names)
    assert read == [(1, rows.count()), (3, rows.count())]


def test_importances_sum_to_one_in_falling_order(spark, tuned, data):
    rows = tuned.importances(spark).collect()
    values = [r.importance for r in rows]
    assert {r.feature for r in rows} == set(data.names)
    assert sum(values) == pytest.approx(1.0) and values == sorted(values, reverse=True)
    assert len(tuned.importances(spark, 3).collect()) == 3


def test_tree_tables_fit_together(data, tuned, nodes):
    table = trees.tree_nodes(nodes, data.names).collect()
    edges = trees.tree_edges(nodes, data.names).collect()
    rules = trees.tree_rules(nodes, data.names).collect()
    leaves = [n for n in table if n.kind == "leaf"]
    splits = [n for n in table if n.kind == "split"]
    assert len(table) == tuned.tree.numNodes and len(edges) == len(table) - 1
    assert {n.display for n in leaves} <= {"stay", "churn"} and {n.display for n in splits} <= set(data.names)
    assert {r.leaf for r in rules} == {n.id for n in leaves}
    assert max(r.depth for r in rules) == tuned.tree.depth
    assert {(e.parent, e.child) for e in edges} == {(n.id, c) for n in splits for c in (n.left_child, n.right_child)}


def test_rules_select_the_rows_of_their_leaf(data, tuned, nodes):
    profile = trees.leaf_profile(tuned.tree, data.rows, nodes, data.names).collect()
    predicted = tuned.tree.transform(data.rows).persist()
    assert sum(r.n_users for r in profile) == data.rows.count()
    for row in profile:
        chosen = predicted.where(row.rule or "true")
        stats = chosen.agg(F.count("*").alias("n"), F.avg("label").alias("rate"), F.collect_set("prediction").alias("p")).head()
        assert (stats.n, stats.rate) == (row.n_users, pytest.approx(row.churn_rate))
        assert set(stats.p) <= {row.prediction}


def test_saved_model_predicts_the_same(spark):
    row = registry.queries()["model_roundtrip"](spark, TRAIN_DIR).head()
    assert row.n > 0 and row.n == row.n_same


def test_split_follows_the_key(data):
    again = data_split(data.rows.drop("split").repartition(5))
    assert sorted((r.userId, r.split) for r in data.rows.select("userId", "split").collect()) == sorted(
        (r.userId, r.split) for r in again.select("userId", "split").collect()
    )


def test_model_data_reads_the_written_table(spark, data):
    plan = data.rows._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan and "features-" in plan
    assert model_data(data.features).names == data.names
