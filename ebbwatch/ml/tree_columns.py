"""Decision trees that score rows as one column expression, from the node rows of a saved tree.

The nodes become literal arrays, and the walk from the root is a fold over the levels of the tree, so the
expression is as small for a tree of thousands of nodes as for one of three. No model object is needed, and rows
stay in the JVM. A tree is small next to the data; its nodes are collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbwatch.ml.trees import tree_edges, tree_nodes, tree_rules
from ebbwatch.operators.scoring import CLASS_NAMES


class Tree(NamedTuple):
    ids: list[int]
    features: list[int]  # -1 in leaves
    thresholds: list[float]
    categories: list[list[float]]
    lefts: list[int]  # places in these lists; a leaf's is itself
    rights: list[int]
    predictions: list[float]
    depth: int


def compiled(nodes: DataFrame) -> Tree:
    """The tree of node rows as ``read_nodes`` gives them; node 0 is the root. A child that is not there is an error."""
    rows = nodes.select("id", "prediction", "leftChild", "rightChild", "split.*").orderBy("id").collect()
    place = {r.id: i for i, r in enumerate(rows)}
    if 0 not in place:
        raise ValueError("a tree needs a node 0")
    leaf = [r.leftChild < 0 and r.rightChild < 0 for r in rows]
    depths = {0: 0}
    todo = [0]
    for node in todo:
        r = rows[place[node]]
        if not leaf[place[node]]:
            for child in (r.leftChild, r.rightChild):
                if child not in place or child in depths:
                    raise ValueError(f"node {node} has no child {child} of its own")
                depths[child] = depths[node] + 1
                todo.append(child)
    numeric = [r.numCategories < 0 for r in rows]
    values = [list(r.leftCategoriesOrThreshold or []) for r in rows]
    return Tree(
        [r.id for r in rows],
        [-1 if x else r.featureIndex for x, r in zip(leaf, rows)],
        [v[0] if n and not x else 0.0 for n, x, v in zip(numeric, leaf, values)],
        [[] if n or x else v for n, x, v in zip(numeric, leaf, values)],
        [i if leaf[i] else place[r.leftChild] for i, r in enumerate(rows)],
        [i if leaf[i] else place[r.rightChild] for i, r in enumerate(rows)],
        [r.prediction for r in rows],
        max(depths.values()),
    )


def _table(values: list, kind: str) -> Column:
    return F.lit(values).cast(f"array<{kind}>") if values and not isinstance(values[0], list) else F.array(*[F.lit(v).cast(kind) for v in values])


def path_column(tree: Tree, inputs: Sequence[Column]) -> Column:
    """The ids of the nodes that a row passes, from the root to its leaf. A null value goes to the right."""
    values = F.array(*[c.cast("double") for c in inputs])
    features, thresholds, lefts, rights = (_table(x, k) for x, k in ((tree.features, "int"), (tree.thresholds, "double"), (tree.lefts, "int"), (tree.rights, "int")))
    listed = F.array(*[F.array(*[F.lit(float(v)) for v in c]).cast("array<double>") for c in tree.categories])
    grouped = any(tree.categories)

    def step(path: Column, _: Column) -> Column:
        at = F.element_at(path, -1)
        feature = F.get(features, at)
        value = F.get(values, feature)
        left = value <= F.get(thresholds, at)
        if grouped:
            left = F.when(F.size(F.get(listed, at)) > 0, F.array_contains(F.get(listed, at), value)).otherwise(left)
        return F.when(feature < 0, path).otherwise(F.concat(path, F.array(F.when(left, F.get(lefts, at)).otherwise(F.get(rights, at)))))

    root = F.array(F.lit(tree.ids.index(0)))
    places = F.aggregate(F.sequence(F.lit(1), F.lit(tree.depth)), root, step) if tree.depth else root
    ids = _table(tree.ids, "int")
    return F.transform(places, lambda p: F.get(ids, p))


def scored_by_tree(rows: DataFrame, nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows with ``path``, ``leaf`` and ``prediction``; ``names`` are the columns that the tree's features stand for."""
    tree = compiled(nodes)
    scored = rows.withColumn("path", path_column(tree, [F.col(f"`{n}`") for n in names])).withColumn("leaf", F.element_at("path", -1))
    place = {i: k for k, i in enumerate(tree.ids)}
    by_id = [tree.predictions[place[i]] if i in place else 0.0 for i in range(max(tree.ids) + 1)]
    return scored.withColumn("prediction", F.get(_table(by_id, "double"), F.col("leaf")))


def tree_flow(scored: DataFrame, nodes: DataFrame, names: Sequence[str], class_names: Sequence[str] = CLASS_NAMES) -> DataFrame:
    """(id, kind, display, parent, side, reason, prediction, n_users, churn_rate): each node with who passes it.

    Rows are counted by path first, so what is counted by node is as small as the tree.
    """
    paths = scored.groupBy("path").agg(F.count("*").alias("n"), F.sum(F.col("label").cast("long")).alias("churners"))
    passed = paths.select(F.explode("path").alias("id"), "n", "churners").groupBy("id").agg(F.sum("n").alias("n_users"), F.sum("churners").alias("churners"))
    edges = tree_edges(nodes, names).select(F.col("child").alias("id"), "parent", "side", "reason")
    shown = tree_nodes(nodes, names, class_names).select("id", "kind", "display", "prediction")
    users = F.coalesce("n_users", F.lit(0))
    return shown.join(edges, "id", "left").join(passed, "id", "left").select(
        "id", "kind", "display", "parent", "side", "reason", "prediction", users.alias("n_users"), (F.col("churners") / F.col("n_users")).alias("churn_rate")
    )


def leaf_rules(scored: DataFrame, nodes: DataFrame, names: Sequence[str], class_names: Sequence[str] = CLASS_NAMES) -> DataFrame:
    """(leaf, depth, rule, class_name, n_users, churn_rate): the rule of each leaf and who it selects."""
    population = scored.groupBy("leaf").agg(F.count("*").alias("n_users"), F.avg("label").alias("churn_rate"))
    rules = tree_rules(nodes, names, class_names).select("leaf", "depth", "rule", "class_name")
    return rules.join(population, "leaf", "left").withColumn("n_users", F.coalesce("n_users", F.lit(0)))
