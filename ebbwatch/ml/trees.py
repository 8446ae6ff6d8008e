"""A fitted decision tree as tables: nodes, edges, rules and leaf populations.

The tables grow with the tree (at most 2^(maxDepth + 1) nodes), not with the data,
except for the leaf profile, which aggregates the scored rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbwatch.operators.scoring import CLASS_NAMES


_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
_LEAF_SLICE = 100_000  # node ids that one window task numbers


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Node rows of a saved tree."""
    return spark.read.parquet(f"{path}/data/*")


def _named(names: Sequence[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), index)


def tree_nodes(
    nodes: DataFrame, names: Sequence[str], class_names: Sequence[str] = CLASS_NAMES
) -> DataFrame:
    """(id, kind, display, feature, threshold, n_categories, prediction, left_child, right_child)."""
    leaf = (F.col("leftChild") < 0) & (F.col("rightChild") < 0)
    feature = F.when(~leaf, _named(names, F.col("split.featureIndex")))
    label = _named(class_names, F.col("prediction").cast("int"))
    numeric = ~leaf & (F.col("split.numCategories") < 0)
    return nodes.select(
        "id",
        F.when(leaf, "leaf").otherwise("split").alias("kind"),
        F.when(leaf, label).otherwise(feature).alias("display"),
        feature.alias("feature"),
        F.when(numeric, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(~leaf, F.col("split.numCategories")).alias("n_categories"),
        "prediction",
        F.col("leftChild").alias("left_child"),
        F.col("rightChild").alias("right_child"),
    )


def tree_edges(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """(parent, child, side, reason): the test that leads from a node to each child."""
    feature = _named(names, F.col("split.featureIndex"))
    values = F.col("split.leftCategoriesOrThreshold")
    numeric = F.col("split.numCategories") < 0
    inner = nodes.where("leftChild > 0 and rightChild > 0")

    def side(child: str, name: str, comparison: str, membership: str) -> DataFrame:
        reason = F.when(numeric, F.concat_ws(f" {comparison} ", feature, F.get(values, F.lit(0)).cast("string")))
        listed = F.concat(feature, F.lit(f" {membership} ("), F.array_join(values.cast("array<string>"), ", "), F.lit(")"))
        return inner.select(
            F.col("id").alias("parent"), F.col(child).alias("child"), F.lit(name).alias("side"),
            reason.otherwise(listed).alias("reason"),
        )

    return side("leftChild", "left", "<=", "in").unionByName(side("rightChild", "right", ">", "not in"))


def tree_rules(
    nodes: DataFrame, names: Sequence[str], class_names: Sequence[str] = CLASS_NAMES
) -> DataFrame:
    """(leaf, depth, rule, prediction, class_name): the path from the root to each leaf.

    The recursion visits every node once; the engine's limit of rows is raised to that where it is lower.
    """
    limit, n = int(nodes.sparkSession.conf.get(_ROW_LIMIT)), nodes.count()
    if 0 <= limit <= n:
        nodes.sparkSession.conf.set(_ROW_LIMIT, str(n + 1))
    return nodes.sparkSession.sql(
        """
        WITH RECURSIVE paths(id, depth, rule) AS (
          SELECT 0, 0, ''
          UNION ALL
          SELECT e.child, p.depth + 1, CASE WHEN p.rule = '' THEN e.reason ELSE concat(p.rule, ' and ', e.reason) END
          FROM paths p JOIN {edges} e ON e.parent = p.id
        )
        SELECT n.id AS leaf, p.depth, p.rule, n.prediction, n.display AS class_name
        FROM paths p JOIN {leaves} n ON n.id = p.id
        """,
        edges=tree_edges(nodes, names),
        leaves=tree_nodes(nodes, names, class_names).where("kind = 'leaf'"),
    )


def leaf_profile(
    tree: DecisionTreeClassificationModel, rows: DataFrame, nodes: DataFrame, names: Sequence[str],
    class_names: Sequence[str] = CLASS_NAMES,
) -> DataFrame:
    """(leaf, rule, prediction, n_users, churn_rate): who ends up in each leaf of the tree."""
    scored = tree.copy().setLeafCol("leaf_number").transform(rows)
    population = scored.groupBy("leaf_number").agg(F.count("*").alias("n_users"), F.avg("label").alias("churn_rate"))
    # Leaves are numbered in the order of their ids: within slices of the ids, after the leaves of earlier slices.
    rules = tree_rules(nodes, names, class_names).withColumn("slice", F.floor(F.col("leaf") / _LEAF_SLICE))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = rules.groupBy("slice").agg(F.count("*").alias("n"))
    firsts = firsts.select("slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    number = F.col("first") + F.row_number().over(Window.partitionBy("slice").orderBy("leaf")) - 1
    rules = rules.join(firsts, "slice").withColumn("leaf_number", number.cast("double"))
    return rules.join(population, "leaf_number", "left").select(
        "leaf", "rule", "prediction", F.coalesce("n_users", F.lit(0)).alias("n_users"), "churn_rate"
    )
