"""Registry of the queries, each over the whole tables of a folder."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.ml import models, page_vectors, prepare, tree_columns, trees
from ebbwatch.ml.tuning import TunedTree, tune_tree
from ebbwatch.operators import account, behaviour, breakdown, dictionary, histogram, label, null_patterns, profiling, ranking, sampling, scoring, sketches
from ebbwatch.operators.clean import clean_activity, clean_strings, event_time
from ebbwatch.plans import cubes
from ebbwatch.plans.features import INDEXED, complete_rows, feature_report, user_counts, user_features
from ebbwatch.plans.modelling import ModelData, model_data
from ebbwatch.session import scratch_path, prepare_session, write_table
from ebbwatch.sources import activity_log as logs
from ebbwatch.sources import batches, checked_log
from ebbwatch.sources.star_tables import activity_log
from sqlchecks.statements import statements

try:  # the corpus operators may be left out of a deployment
    from ebbwatch.llm.registry import corpus_queries
    from ebbwatch.llm.statements import corpus_statements
except ModuleNotFoundError as error:
    if error.name not in ("ebbwatch.llm", "ebbwatch.llm.registry", "corpus_pipeline"):
        raise
    _CORPUS_QUERIES, _CORPUS_STATEMENTS = {}, {}
else:
    _CORPUS_QUERIES, _CORPUS_STATEMENTS = corpus_queries(), corpus_statements()

Query = Callable[[SparkSession, str], DataFrame]

_RAW_ORDER = ["ts", "userId", "sessionId", "itemInSession"]


def _published(df: DataFrame) -> DataFrame:
    """Rounded doubles, and times in a form that reads the same in every engine."""
    shown = []
    for f in df.schema.fields:
        kind, c = f.dataType.simpleString(), F.col(f"`{f.name}`")
        if kind == "double":
            c = F.round(c + 1e-9, 6)
        elif kind == "date":
            c = c.cast("string")
        elif kind == "timestamp":
            shown.append(F.unix_timestamp(c).alias("interaction_second"))
            continue
        shown.append(c.alias(f.name))
    return df.select(*shown)


def _shown_deviation(c: Column) -> Column:
    """Six decimals; two from a million on, where doubles do not hold more from engine to engine."""
    return F.when(c < 1e6, F.round(c + 1e-9, 6)).otherwise(F.round(c, 2))


def _raw(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return activity_log(prepare_session(spark), sf_dir, *columns)


def _clean(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Cleaned log with the named columns besides userId, ts and auth (all if none is named)."""
    named = dict.fromkeys(["userId", "ts", "auth", *columns]) if columns else []
    return clean_activity(_raw(spark, sf_dir, *named))


_CUBE_COLUMNS = ("page", "level", "gender", "location", "registration", "sessionId", "itemInSession")


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_features(_clean(spark, sf_dir, *_CUBE_COLUMNS))


def _model_data(spark: SparkSession, sf_dir: str) -> ModelData:
    return model_data(_features(spark, sf_dir))


def _tuned(spark: SparkSession, sf_dir: str) -> tuple[ModelData, TunedTree]:
    data = _model_data(spark, sf_dir)
    return data, tune_tree(data.train, data.names)


def _saved_tree(spark: SparkSession, sf_dir: str) -> tuple[ModelData, TunedTree, DataFrame]:
    data, tuned = _tuned(spark, sf_dir)
    path = scratch_path(spark, "tree")
    trees.save_model(tuned.tree, path)
    return data, tuned, trees.read_nodes(spark, path)


# Sources, sinks, actions


def scan_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the log as JSON lines and scan it with the declared schema."""
    path = scratch_path(spark, "log-json")
    logs.write_json_log(_raw(spark, sf_dir), path)
    return _published(logs.read_json_log(spark, path))


def land_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the cleaned log by date and read it back."""
    clean = _clean(spark, sf_dir)
    path = scratch_path(spark, "log-clean")
    logs.land_clean_log(clean, path)
    return _published(logs.read_clean_log(spark, path, clean.schema))


def features_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the features as CSV and read them back."""
    features = _features(spark, sf_dir)
    path = scratch_path(spark, "features-csv")
    logs.write_features_csv(features, path)
    return _published(logs.read_features_csv(spark, path, features.schema))


def _log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line, ts): the log as JSON lines."""
    return _raw(spark, sf_dir).select(F.to_json(F.struct("*")).alias("line"), "ts")


def scan_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the log, some of them broken by a rule on their time: how many fit, and how many do not, by cause."""
    lines, kind, path = _log_lines(spark, sf_dir), F.col("ts") % 97, scratch_path(spark, "log-lines")
    broken = (
        F.when(kind == 0, F.expr("left(line, length(line) - 5)")).when(kind == 1, "42").when(kind == 2, F.regexp_replace("line", r'"ts":\d+', '"ts":"soon"'))
        .when(kind == 3, F.regexp_replace("line", r'"itemInSession":(\d+)', '"itemInSession":$1.5')).when(kind == 4, " ").otherwise(F.col("line"))
    )
    lines.select(broken.alias("value")).write.text(path)
    good, quarantine = checked_log.land_checked(checked_log.read_lines(spark, path), scratch_path(spark, "checked-log"))
    return checked_log.causes(quarantine).union(good.select(F.lit("none").alias("cause"), "ts").groupBy("cause").agg(F.count("ts")))


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a log that lost one, got one, and has numbers and texts in a third."""
    kind = F.col("ts") % 97
    log = _raw(spark, sf_dir).withColumn("status", F.when(kind == 6, F.lit("ok")).otherwise(F.col("status").cast("string")))
    line = F.to_json(F.struct(*[c for c in log.columns if c != "userAgent"], F.when(kind == 5, "phone").alias("device")))
    line = F.regexp_replace(line, r'"status":"(\d+)"', '"status":$1')
    return checked_log.schema_drift(log.select(line.alias("line")))


def sketched_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users from the merged sketches of all days: whether the estimate is within its error of the exact number."""
    log = event_time(_raw(spark, sf_dir, "userId", "ts"))
    days = write_table(sketches.user_sketches(log), "sketches")
    exact = log.agg(F.count_distinct("userId").alias("n_users"))
    total = sketches.estimated_users(days).select(F.col("n_users").alias("estimate"))
    near = F.abs(F.col("estimate") - F.col("n_users")) <= F.greatest(F.lit(1.0), F.col("n_users") * sketches.ERROR)
    return exact.join(total).join(days.agg(F.count("*").alias("n_days"))).select("n_days", "n_users", near.alias("within_error"))


def sketched_users_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_time(_raw(spark, sf_dir, "userId", "ts"))
    exact = log.groupBy("date").agg(F.count_distinct("userId").alias("n_users"))
    near = F.abs(F.col("estimate") - F.col("n_users")) <= F.greatest(F.lit(1.0), F.col("n_users") * sketches.ERROR)
    days = sketches.estimated_users(sketches.user_sketches(log), "date").withColumnRenamed("n_users", "estimate")
    return _published(exact.join(days, "date").select("date", "n_users", near.alias("within_error")))


def land_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the cleaned log in two batches that share days, one of them twice, and read it back."""
    clean = _clean(spark, sf_dir)
    path = scratch_path(spark, "log-batches")
    even = F.col("sessionId") % 2 == 0
    for name, part in (("even", even), ("odd", ~even), ("even", even)):
        batches.land_batch(clean.where(part), path, name)
    return _published(batches.read_batches(spark, path, clean.schema))


def landed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of two batches has landed by day; the second comes again with fewer days."""
    clean = _clean(spark, sf_dir, "sessionId")
    path = scratch_path(spark, "log-batches")
    even = F.col("sessionId") % 2 == 0
    for name, part in (("even", even), ("odd", ~even), ("odd", ~even & (F.dayofmonth("date") <= 15))):
        batches.land_batch(clean.where(part), path, name)
    return _published(batches.landed_days(spark, path, clean.schema))


def activity_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored cube, merged over batches; without the exact recency key, which only orders."""
    return _published(cubes.merged_cube(_stored_cubes(spark, sf_dir)).drop("rank"))


def _stored_cubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cubes of three batches of the log that share users, days and sessions."""
    clean = _clean(spark, sf_dir, *_CUBE_COLUMNS, "length")
    path = scratch_path(spark, "cubes")
    for i in range(3):
        stored = cubes.add_to_cubes(clean.where(F.pmod(F.hash("ts"), F.lit(3)) == i), path, f"part-{i}")
    return stored


def features_from_cubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(cubes.features_from_cube(_stored_cubes(spark, sf_dir)))


def _page_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.page_means_long(_clean(spark, sf_dir, "page"))


def page_vector_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries of the users' sparse page vectors."""
    means = write_table(_page_means(spark, sf_dir), "page-means")
    positions = write_table(page_vectors.page_positions(means), "page-positions")
    return _published(page_vectors.page_entries(page_vectors.page_vectors(means, means, positions), positions))


# Models


def _model(name: str, **params) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        data = _model_data(spark, sf_dir)
        _, predictions = models.fit_predict(data.train, data.validation, name, **params)
        return models.evaluate(predictions)

    return run


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _model_data(spark, sf_dir)
    return models.prediction_rows(models.fit_predict(data.train, data.validation, "decision_tree")[1])


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _model_data(spark, sf_dir)
    return models.compare_models(data.train, data.validation)


def model_comparison_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _model_data(spark, sf_dir)
    scores = models.compare_models(sampling.stratified_sample(data.train), data.validation)
    return scores.withColumn("sampling", F.lit("stratified"))


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save a tree, load it, and count the rows on which the two agree."""
    data = _model_data(spark, sf_dir)
    model, predicted = models.fit_predict(data.train, data.validation, "decision_tree")
    path = scratch_path(spark, "model")
    trees.save_model(model, path)
    reloaded = DecisionTreeClassificationModel.load(path).setPredictionCol("again").setRawPredictionCol("raw_again")
    both = reloaded.setProbabilityCol("probability_again").transform(predicted)
    return both.agg(F.count("*").alias("n"), F.count_if(F.col("prediction") == F.col("again")).alias("n_same"))


def tune_tree_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger grid, with four depths and both impurities."""
    data = _model_data(spark, sf_dir)
    return tune_tree(data.train, data.names, (10, 40), (5, 10, 20, 30), ("entropy", "gini")).grid(spark)


def validation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, tuned = _tuned(spark, sf_dir)
    return models.evaluate(tuned.search.transform(data.validation))


def test_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, tuned = _tuned(spark, sf_dir)
    return models.evaluate(tuned.pipeline.transform(data.test))


def tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, _, nodes = _saved_tree(spark, sf_dir)
    return trees.tree_nodes(nodes, data.names)


def tree_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, _, nodes = _saved_tree(spark, sf_dir)
    return trees.tree_edges(nodes, data.names)


def tree_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, _, nodes = _saved_tree(spark, sf_dir)
    return trees.tree_rules(nodes, data.names)


def leaf_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, tuned, nodes = _saved_tree(spark, sf_dir)
    return trees.leaf_profile(tuned.tree, data.rows, nodes, data.names)


# What must hold of any fit, stated without fitted numbers


def leaf_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaves of a tree part the model rows: their users, and those that churn."""
    leaves = leaf_profile(spark, sf_dir)
    churners = F.sum(F.round(F.coalesce("churn_rate", F.lit(0.0)) * F.col("n_users")).cast("long"))
    return leaves.agg(F.sum("n_users").alias("n_users"), churners.alias("n_churners"))


def tree_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A binary tree has one node more than edges, one leaf more than splits, and a rule for each leaf."""
    data, _, nodes = _saved_tree(spark, sf_dir)
    parts = [
        trees.tree_nodes(nodes, data.names).select("kind"),
        trees.tree_edges(nodes, data.names).select(F.lit("edge").alias("kind")),
        trees.tree_rules(nodes, data.names).select("rule").distinct().select(F.lit("rule").alias("kind")),
    ]
    kinds = reduce(DataFrame.unionByName, parts).groupBy().pivot("kind", ["leaf", "split", "edge", "rule"]).count()
    return kinds.selectExpr(
        "leaf + split - edge AS n_roots", "leaf - split AS leaves_over_splits", "leaf - rule AS leaves_without_rule"
    )


def grid_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tune_tree_wide(spark, sf_dir).select("max_bins", "max_depth", "impurity")


def best_setting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winning setting has the highest mean score of the grid."""
    tuned = _tuned(spark, sf_dir)[1]
    best = {r.param: r.value for r in tuned.best_params(spark).collect()}
    won = (F.col("max_bins") == int(best["maxBins"])) & (F.col("max_depth") == int(best["maxDepth"]))
    scores = tuned.grid(spark).agg(F.max("avg_f1").alias("top"), F.max(F.when(won, F.col("avg_f1"))).alias("chosen"), F.count("*").alias("n"))
    return scores.select(F.col("n").alias("n_settings"), (F.col("top") == F.col("chosen")).alias("is_best"))


def importance_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances of all inputs are shares."""
    shares = _tuned(spark, sf_dir)[1].importances(spark)
    return shares.agg(
        F.count("*").alias("n_features"), F.round(F.sum("importance"), 6).alias("total"), (F.min("importance") >= 0).alias("none_negative")
    )


def compared_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each classifier scores each validation row once."""
    data = _model_data(spark, sf_dir)
    scored = [
        models.prediction_rows(models.fit_predict(data.train, data.validation, name)[1]).select(F.lit(name).alias("model"), "label", "p_churn")
        for name in models.CLASSIFIERS
    ]
    rows = reduce(DataFrame.unionByName, scored)
    return rows.groupBy("model", "label").agg(F.count("*").alias("n"), F.count_if(F.col("p_churn").between(0, 1)).alias("n_probable"))


def score_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of a tree's predictions against its own confusion counts."""
    data = _model_data(spark, sf_dir)
    scores = write_table(models.prediction_rows(models.fit_predict(data.train, data.validation, "decision_tree")[1]), "predicted")
    hits = F.when(F.col("label") == F.col("prediction"), F.col("n"))
    counts = scoring.confusion_matrix(scores).select("n", hits.alias("hits"), F.lit(None).cast("double").alias("accuracy"))
    told = scoring.classification_metrics(scores).where("metric = 'accuracy'")
    both = counts.unionByName(told.select(F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("hits"), F.col("value").alias("accuracy")))
    agrees = F.abs(F.sum("hits") / F.sum("n") - F.max("accuracy")) < 1e-9
    return both.agg(F.sum("n").alias("n"), agrees.alias("accuracy_agrees"))


def _rule_scores(rows: DataFrame) -> DataFrame:
    """A fixed rule in place of a model, so that its scores can be checked in SQL."""
    guess = (F.col("avg_monthly_Error") >= 1.5) & (F.col("registered_days") < 200)
    return rows.select("label", F.when(guess, 1).otherwise(0).alias("prediction"))


def _rule_score(rows: DataFrame) -> DataFrame:
    """A score that SQL can state, with many ties."""
    return rows.select("label", (F.col("avg_monthly_Error") - F.floor(F.col("registered_days") / 50)).alias("score"))


def _indexed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Complete rows with the indexes of the text columns from dictionaries, and the dictionaries."""
    features = write_table(_features(spark, sf_dir), "features")
    rows, dictionaries = dictionary.index_columns(features, INDEXED)
    return sampling.data_split(complete_rows(rows, [f"{c}_index" for c in INDEXED])), dictionaries


def value_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionaries of the text columns as one table."""
    parts = [d.select(F.lit(c).alias("column_name"), "value", "n", "idx") for c, d in _indexed(spark, sf_dir)[1].items()]
    return reduce(DataFrame.unionByName, parts)


def indexed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _indexed(spark, sf_dir)[0].select("userId", "label", *[f"{c}_index" for c in INDEXED], "split")


# A tree written by hand, over inputs of the feature table, in the form in which trees are saved:
# (id, prediction, left child, right child, input, threshold or left categories, number of categories).
_TREE_INPUTS = ["avg_monthly_Error", "registered_days", "valid_level_index"]
_TREE = [
    (0, 0.0, 1, 4, 0, [1.25], -1), (1, 0.0, 2, 3, 2, [0.0], 2), (2, 0.0, -1, -1, -1, [], -1), (3, 0.0, -1, -1, -1, [], -1),
    (4, 1.0, 5, 8, 1, [120.0], -1), (5, 1.0, 6, 7, 0, [2.0], -1), (6, 0.0, -1, -1, -1, [], -1), (7, 1.0, -1, -1, -1, [], -1), (8, 0.0, -1, -1, -1, [], -1),
]


def _hand_tree(spark: SparkSession) -> DataFrame:
    split = "split struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
    rows = [(i, p, left, right, (x, v, n)) for i, p, left, right, x, v, n in _TREE]
    return spark.createDataFrame(rows, f"id int, prediction double, leftChild int, rightChild int, {split}")


def _tree_query(result) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        nodes, rows = _hand_tree(spark), _indexed(spark, sf_dir)[0]
        return _published(result(tree_columns.scored_by_tree(rows, nodes, _TREE_INPUTS), nodes, _TREE_INPUTS))

    return run


def feature_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Ranges and counts both read the features, so these are written once.
    features = write_table(_published(_features(spark, sf_dir)), "features")
    numeric = [f.name for f in features.schema.fields if f.dataType.simpleString() != "string" and f.name != "userId"]
    return _published(histogram.feature_histograms(features, numeric))


def queries() -> dict[str, Query]:
    """Each query takes a session and a folder of tables and gives a DataFrame."""
    return _log_queries() | _CORPUS_QUERIES


def _log_queries() -> dict[str, Query]:

    def on_raw(operator, *columns: str) -> Query:
        return lambda spark, sf_dir: _published(operator(_raw(spark, sf_dir, *columns)))

    def on_clean(operator, *columns: str) -> Query:
        return lambda spark, sf_dir: _published(operator(_clean(spark, sf_dir, *columns)))

    def on_features(operator) -> Query:
        return lambda spark, sf_dir: _published(operator(_features(spark, sf_dir)))

    def on_split(operator) -> Query:
        return on_features(lambda features: operator(sampling.data_split(complete_rows(features))))

    def on_train(operator) -> Query:
        return on_split(lambda rows: operator(rows.where("split = 'train'")))

    def on_model_data(operator) -> Query:
        return lambda spark, sf_dir: _published(operator(_model_data(spark, sf_dir)))

    def on_tuned(operator) -> Query:
        return lambda spark, sf_dir: operator(_tuned(spark, sf_dir)[1], spark)

    def pages(*grains: str) -> Query:
        return on_clean(lambda log: behaviour.page_visits(log, behaviour.discover_pages(log), grains), "page")

    return {
        "scan_activity": scan_activity,
        "land_activity": land_activity,
        "features_sink": features_sink,
        "row_count": on_raw(profiling.row_count, "userId"),
        "split_counts": on_split(lambda rows: rows.groupBy("split").agg(F.count("*").alias("n"))),
        "user_counts": on_features(user_counts),
        "preview": on_raw(lambda log: profiling.preview(log, _RAW_ORDER)),
        "schema_report": on_raw(profiling.schema_report),
        "clean_strings": on_raw(clean_strings),
        "event_time": on_raw(event_time, "userId", "ts"),
        "clean_activity": on_clean(lambda log: log),
        "null_pattern_rows": on_raw(
            lambda log: profiling.preview(profiling.rows_where(log, "artist is null"), _RAW_ORDER, 10)
        ),
        "null_name_rows": on_raw(lambda log: profiling.rows_where(log, "lastName is null")),
        "null_by_auth": on_raw(
            lambda log: profiling.null_by_auth(log, [c for c in log.columns if c != "auth"])
        ),
        "scan_quarantine": scan_quarantine,
        "schema_drift": schema_drift,
        "sketched_users": sketched_users,
        "sketched_users_by_day": sketched_users_by_day,
        "null_patterns": on_raw(null_patterns.null_pattern_report),
        "null_implications": on_raw(null_patterns.null_implications),
        "null_groups": on_raw(null_patterns.null_groups),
        "churn_label": on_clean(label.churn_label, "page"),
        "label_join": on_clean(lambda log: label.label_join(log, label.churn_label(log))),
        "last_interaction": on_clean(account.last_interaction, "ts"),
        "registered_days": on_clean(account.registered_days, "registration"),
        "valid_level": on_clean(account.valid_level, "level", "itemInSession"),
        "avg_length": on_clean(account.avg_length, "length"),
        "dedup": on_clean(
            account.account_rows, "page", "level", "gender", "location", "registration", "itemInSession"
        ),
        "session_duration": on_clean(behaviour.session_duration, "sessionId"),
        "items": on_clean(behaviour.items, "itemInSession"),
        "session_counts": on_clean(behaviour.session_counts, "sessionId"),
        "page_pivot_daily": on_clean(lambda log: behaviour.page_pivot(log, "date", behaviour.discover_pages(log)), "page"),
        "page_pivot_monthly": on_clean(lambda log: behaviour.page_pivot(log, "month", behaviour.discover_pages(log)), "page"),
        "page_visits_daily": pages("daily"),
        "page_visits_monthly": pages("monthly"),
        "page_visits": pages("daily", "monthly"),
        "page_means_long": lambda spark, sf_dir: _published(_page_means(spark, sf_dir)),
        "page_vector_entries": page_vector_entries,
        "land_increments": land_increments,
        "landed_days": landed_days,
        "activity_cube": activity_cube,
        "features_from_cubes": features_from_cubes,
        "user_features": on_features(lambda features: features),
        "feature_columns": on_features(feature_report),
        "distinct_users": on_raw(profiling.distinct_users, "userId"),
        "time_range": on_raw(profiling.time_range, "ts"),
        "distinct_values": on_raw(profiling.distinct_values, *profiling.CATEGORIES),
        "null_counts": on_raw(profiling.null_counts),
        "feature_null_counts": on_features(lambda features: profiling.null_counts(features.drop("userId"))),
        "describe": lambda spark, sf_dir: _published(
            profiling.describe(_raw(spark, sf_dir)).withColumn("stddev", _shown_deviation(F.col("stddev")))
        ),
        "pages_without_null_artist": on_raw(profiling.pages_without_null_artist, "page", "artist"),
        "count_gender_level_auth": on_raw(
            lambda log: breakdown.event_counts(log, "gender", "level", "auth"), "gender", "level", "auth"
        ),
        "users_by_state_label": on_clean(lambda log: breakdown.users_by(log, "location"), "page", "location"),
        "users_by_gender_label": on_clean(lambda log: breakdown.users_by(log, "gender"), "page", "gender"),
        "avg_registered_days": on_clean(breakdown.avg_registered_days, "page", "registration"),
        "events_by_gender_level": on_clean(
            lambda log: breakdown.fewest_first(breakdown.event_counts(log, "gender", "level")), "gender", "level"
        ),
        "users_by_gender_level": on_clean(
            lambda log: breakdown.event_counts(log.select("userId", "gender", "level").distinct(), "gender", "level"),
            "gender", "level",
        ),
        "sessions_per_user": on_clean(breakdown.sessions_per_user, "page", "sessionId"),
        "avg_item_in_session": on_clean(breakdown.avg_item_in_session, "page", "itemInSession"),
        "events_by_level_label": on_clean(
            lambda log: breakdown.fewest_first(breakdown.events_by(log, "level")), "page", "level"
        ),
        "events_by_state_label": on_clean(
            lambda log: breakdown.fewest_first(
                breakdown.label_share(breakdown.events_by(log, "location"), "location")
            ),
            "page", "location",
        ),
        "crosstab_gender_level": on_clean(
            lambda log: breakdown.crosstab(breakdown.event_counts(log, "gender", "level"), "level", "gender", ["F", "M"]),
            "gender", "level",
        ),
        "crosstab_level_label": on_clean(
            lambda log: breakdown.crosstab(breakdown.events_by(log, "level"), "label", "level", ["free", "paid"]),
            "page", "level",
        ),
        "crosstab_state_label": on_clean(
            lambda log: breakdown.crosstab(breakdown.events_by(log, "location"), "location", "label", [0, 1]),
            "page", "location",
        ),
        "feature_histograms": feature_histograms,
        "hist_registered_days": on_clean(
            lambda log: histogram.histogram(breakdown.avg_registered_days(log), "label", "avg_registered_days"),
            "page", "registration",
        ),
        "hist_sessions": on_clean(
            lambda log: histogram.histogram(breakdown.sessions_per_user(log), "label", "n_sessions"),
            "page", "sessionId",
        ),
        "hist_items": on_clean(
            lambda log: histogram.histogram(
                _published(breakdown.avg_item_in_session(log)), "label", "avg_item_in_session"
            ),
            "page", "itemInSession",
        ),
        "string_index": on_model_data(lambda data: prepare.index_values(data.fitted, data.features)),
        "prepare_features": on_model_data(
            lambda data: data.rows.select("userId", "label", *[f"{c}_index" for c in INDEXED], "split")
        ),
        "feature_vector": on_model_data(lambda data: prepare.vector_entries(data.rows)),
        "data_split": on_split(lambda rows: rows.select("userId", "split")),
        "stratified_sample": on_train(lambda rows: sampling.stratified_sample(rows).select("userId", "label")),
        "class_balance": on_train(sampling.class_balance),
        "class_balance_stratified": on_train(lambda rows: sampling.class_balance(sampling.stratified_sample(rows))),
        "confusion_matrix": on_split(lambda rows: scoring.confusion_matrix(_rule_scores(rows))),
        "classification_metrics": on_split(lambda rows: scoring.classification_metrics(_rule_scores(rows))),
        "auc_ranked": on_split(lambda rows: ranking.auc_ranked(_rule_score(rows))),
        "score_ranks": on_split(lambda rows: ranking.score_ranks(_rule_score(rows))),
        "roc_curve": on_split(lambda rows: ranking.roc_curve(_rule_score(rows))),
        "value_indexes": value_indexes,
        "indexed_rows": indexed_rows,
        "tree_scored": _tree_query(lambda scored, nodes, names: scored.select("userId", "leaf", "prediction")),
        "tree_flow": _tree_query(tree_columns.tree_flow),
        "tree_leaf_rules": _tree_query(tree_columns.leaf_rules),
        "model_tree": _model("decision_tree"),
        "model_logistic": _model("logistic_regression"),
        "model_logistic_default": _model("logistic_regression", maxIter=100),
        "model_forest": _model("random_forest"),
        "model_gbt": _model("gradient_boosting"),
        "predictions": predictions,
        "model_comparison": model_comparison,
        "model_comparison_stratified": model_comparison_stratified,
        "model_roundtrip": model_roundtrip,
        "tune_tree": on_tuned(TunedTree.grid),
        "tune_tree_wide": tune_tree_wide,
        "best_params": on_tuned(TunedTree.best_params),
        "feature_importance": on_tuned(TunedTree.importances),
        "validation_metrics": validation_metrics,
        "test_metrics": test_metrics,
        "tree_nodes": tree_nodes,
        "tree_edges": tree_edges,
        "tree_rules": tree_rules,
        "leaf_profile": leaf_profile,
        "leaf_totals": leaf_totals,
        "tree_shape": tree_shape,
        "grid_settings": grid_settings,
        "best_setting": best_setting,
        "importance_total": importance_total,
        "compared_labels": compared_labels,
        "score_identities": score_identities,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB statements for the queries that SQL can state; model fits have none."""
    return statements() | _CORPUS_STATEMENTS


def entry(spark: SparkSession) -> DataFrame:
    """The user feature table over the smallest tables."""
    return queries()["user_features"](spark, "/root/testdata/sf0.001")
