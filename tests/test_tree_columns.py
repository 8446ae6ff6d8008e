"""Trees as column expressions against the models they come from."""

import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from ebbwatch.ml.tree_columns import compiled, leaf_rules, scored_by_tree, tree_flow
from ebbwatch.ml.trees import leaf_profile, read_nodes, save_model

NODE = "id int, prediction double, leftChild int, rightChild int, split struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"


@pytest.mark.parametrize("depth", [1, 4, 12])
def test_same_as_the_model(spark, tmp_path, depth):
    rng = random.Random(depth)
    raw = [(i, int(rng.random() < 0.4), rng.random(), rng.choice("abcdef"), float(rng.randrange(4)), rng.gauss(0, 1)) for i in range(800)]
    raw = [(i, int((k in "ace") ^ (x > 0.6) ^ (z > 1) ^ (rng.random() < 0.1)), x, k, y, z) for i, _, x, k, y, z in raw]
    frame = spark.createDataFrame(raw, "userId long, label int, x double, k string, y double, z double").repartition(4)
    indexed = StringIndexer(inputCol="k", outputCol="k_index").fit(frame).transform(frame)  # a categorical input
    names = ["x", "k_index", "y", "z"]
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(indexed).persist()
    model = DecisionTreeClassifier(maxDepth=depth, seed=1).fit(rows)
    save_model(model, f"{tmp_path}/tree")
    nodes = read_nodes(spark, f"{tmp_path}/tree").persist()
    scored = scored_by_tree(rows.drop("prediction"), nodes, names).persist()
    expected = {r.userId: r.prediction for r in model.transform(rows).collect()}
    assert {r.userId: r.prediction for r in scored.collect()} == expected
    profile = {r.leaf: (r.rule, r.n_users, r.churn_rate) for r in leaf_profile(model, rows, nodes, names).collect()}
    assert {r.leaf: (r.rule, r.n_users, r.churn_rate) for r in leaf_rules(scored, nodes, names).collect()} == profile
    flow = {r.id: r for r in tree_flow(scored, nodes, names).collect()}
    assert flow[0].n_users == 800 and len(flow) == model.numNodes
    for r in flow.values():
        if r.kind == "split":
            assert r.n_users == sum(c.n_users for c in flow.values() if c.parent == r.id)
    if depth == 12:
        assert any(" in (" in (r.reason or "") for r in flow.values())


def test_edges_of_trees(spark):
    leaf = spark.createDataFrame([(0, 1.0, -1, -1, (-1, [], -1))], NODE)
    rows = spark.createDataFrame([(1, 0, 2.0), (2, 1, None), (3, 1, 0.5)], "userId int, label int, `a b` double")
    assert {(r.leaf, r.prediction) for r in scored_by_tree(rows, leaf, ["a b"]).collect()} == {(0, 1.0)}
    stump = spark.createDataFrame([(0, 0.0, 1, 4, (0, [1.0], -1)), (1, 0.0, -1, -1, (-1, [], -1)), (4, 1.0, -1, -1, (-1, [], -1))], NODE)
    got = {r.userId: (r.leaf, r.prediction, r.path) for r in scored_by_tree(rows, stump, ["a b"]).collect()}
    assert got == {1: (4, 1.0, [0, 4]), 2: (4, 1.0, [0, 4]), 3: (1, 0.0, [0, 1])}  # null goes to the right
    assert {(r.id, r.n_users, r.churn_rate) for r in tree_flow(scored_by_tree(rows.limit(0), stump, ["a b"]), stump, ["a b"]).collect()} == {(0, 0, None), (1, 0, None), (4, 0, None)}
    with pytest.raises(ValueError, match="no child"):
        compiled(stump.where("id != 4"))
    with pytest.raises(ValueError, match="node 0"):
        compiled(stump.where("id = 4"))
