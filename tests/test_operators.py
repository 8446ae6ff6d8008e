import random
import re

import numpy as np
import pytest
from tests.log_fixture import log, ms
from pyspark.sql import functions as F

from ebbwatch.functions.columns import recency, stripped
from ebbwatch.operators import account, behaviour, breakdown, histogram, profiling, sampling, scoring


def test_stripped_equals_the_plain_pattern(spark):
    rng = random.Random(5)
    alphabet = [chr(i) for i in range(1, 128)] + list("äßé漢字😀İſK") + ["\u0000"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(2000)] + ["", None, "Logged Out"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", stripped(F.col("t")).alias("s")).collect()
    for row in rows:
        assert row.s == (None if row.t is None else re.sub("[^a-zA-Z0-9,-]", "", row.t))


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.0, 11.0], [3.0, 3.0], [float(i % 37) for i in range(500)]])
def test_histogram_agrees_with_numpy(spark, values):
    frame = spark.createDataFrame([("a", v) for v in values] + [("a", None), ("a", float("nan"))], "by string, v double")
    rows = histogram.histogram(frame, "by", "v").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=10)
    assert [r.n for r in rows] == list(counts)
    assert [r.lo for r in rows] == pytest.approx(list(edges[:-1]))
    assert [r.hi for r in rows] == pytest.approx(list(edges[1:]))


def test_describe(spark):
    frame = spark.createDataFrame([("1", 2), ("x", 4), (None, None)], "t string, n bigint")
    rows = {r.column_name: r for r in profiling.describe(frame).collect()}
    assert (rows["t"].n, rows["t"].mean, rows["t"].min_text, rows["t"].max_text) == (2, 1.0, "1", "x")
    assert (rows["n"].n, rows["n"].mean, rows["n"].stddev) == (2, 3.0, pytest.approx(2**0.5))
    empty = {r.column_name: r for r in profiling.describe(frame.where("false")).collect()}
    assert (empty["n"].n, empty["n"].mean) == (0, None)


def test_split_is_disjoint_complete_and_stable(spark):
    users = spark.range(20_000).withColumnRenamed("id", "userId")
    split = sampling.data_split(users).persist()
    shares = {r.split: r["count"] / 20_000 for r in split.groupBy("split").count().collect()}
    assert shares == pytest.approx({"train": 0.64, "validation": 0.16, "test": 0.20}, abs=0.01)
    again = sampling.data_split(users.repartition(13, F.rand()))
    assert split.exceptAll(again).isEmpty() and again.exceptAll(split).isEmpty()


def test_stratified_sample_shares(spark):
    rows = spark.range(20_000).select(F.col("id").alias("userId"), (F.col("id") % 2).alias("label"))
    counts = {r.label: r["count"] for r in sampling.stratified_sample(rows).groupBy("label").count().collect()}
    assert counts[1] == 10_000
    assert counts[0] == pytest.approx(10_000 / 3.5, rel=0.05)
    assert sampling.stratified_sample(rows, {1: 1.0}).where("label = 0").isEmpty()


def test_folds_cover_all_rows(spark):
    folds = sampling.add_fold(spark.range(3000).withColumnRenamed("id", "userId"), 3)
    counts = {r.fold: r["count"] for r in folds.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2} and min(counts.values()) > 900


def test_metrics_agree_with_the_library_evaluators(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

    rng = random.Random(1)
    pairs = [(float(rng.random() < 0.3), float(rng.random() < 0.4)) for _ in range(500)]
    frame = spark.createDataFrame(pairs, "label double, prediction double")
    ours = {r.metric: r.value for r in scoring.classification_metrics(frame).collect()}
    names = dict(f1="f1", accuracy="accuracy", weighted_precision="weightedPrecision", weighted_recall="weightedRecall")
    for name, library in names.items():
        assert ours[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=library).evaluate(frame))
    auc = BinaryClassificationEvaluator(rawPredictionCol="prediction").evaluate(frame)
    assert ours["auc_hard"] == pytest.approx(auc)


def test_metrics_without_positive_predictions(spark):
    frame = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    ours = {r.metric: r.value for r in scoring.classification_metrics(frame).collect()}
    assert ours["recall_churn"] == 0.0 and ours["recall_stay"] == 1.0
    assert ours["weighted_precision"] == pytest.approx(4 / 9)


def test_crosstab_keeps_nulls_apart(spark):
    counts = spark.createDataFrame([("a", "F", 2), ("a", None, 3), ("b", "M", 4)], "i string, c string, n long")
    rows = {r.i: (r.F, r.M, r.missing) for r in breakdown.crosstab(counts, "i", "c", ["F", "M"]).collect()}
    assert rows == {"a": (2, None, 3), "b": (None, 4, None)}


def test_pages_without_null_artist(spark):
    events = [dict(page="NextSong", artist="x"), dict(page="Home"), dict(page="Mixed", artist="y"), dict(page="Mixed")]
    assert [r.page for r in profiling.pages_without_null_artist(log(spark, events)).collect()] == ["NextSong"]


def test_time_range(spark):
    events = [dict(ts=ms("2020-01-31 23:59:59") + 999), dict(ts=ms("2020-01-02 00:00:00"))]
    row = profiling.time_range(log(spark, events)).head()
    assert (str(row.first_date), str(row.last_date)) == ("2020-01-02", "2020-01-31")


def test_unlisted_values_are_counted(spark):
    counts = spark.createDataFrame([("a", "F", 2), ("a", "X", 5), ("a", None, 3)], "i string, c string, n long")
    assert breakdown.crosstab(counts, "i", "c", ["F", "M"]).collect() == [("a", 2, None, 5, 3)]
    log = spark.createDataFrame([(1, 1, "Home"), (1, 1, "New"), (1, 1, None)], "userId long, month int, page string")
    assert behaviour.page_pivot(log, "month", ["Home"]).collect() == [(1, 1, 1, 2)]


def test_unlisted_page_is_an_error(spark):
    log = spark.createDataFrame([(1, "2024-01-01", "Home"), (1, "2024-01-01", "New")], "userId long, date string, page string")
    log = log.withColumn("date", F.col("date").cast("date"))
    assert behaviour.page_visits(log, ["Home", "New"]).collect() == [(1, 1.0, 1.0, 1.0, 1.0)]
    with pytest.raises(Exception, match="page without a column: New"):
        behaviour.page_visits(log, ["Home"]).collect()


def test_latest_level_is_exact(spark):
    far = 1 << 43
    events = [
        (1, 10, (1 << 20) + 9, "free"), (1, 10, (1 << 20) + 5, "paid"),
        (2, far, 0, "free"), (2, far - 1, 0, "paid"),
        (3, 5, 0, "free"), (3, 5, None, "paid"),
        (4, 5, -1, "free"), (4, 5, -(1 << 63), "paid"), (4, -5, (1 << 63) - 1, "gone"),
        (5, 7, None, "a"), (5, 7, None, "b"), (5, 7, None, None),
    ]
    log = spark.createDataFrame(events, "userId long, ts long, itemInSession long, level string")
    levels = account.valid_level(log)
    assert dict(tuple(r) for r in levels.collect()) == {1: "free", 2: "free", 3: "free", 4: "free", 5: "b"}
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        account.valid_level(log.withColumn("ts", F.lit((1 << 63) - 1))).collect()


def test_latest_level_is_hash_aggregated(spark):
    log = spark.createDataFrame([(1, 1, 1, "a")], "userId long, ts long, itemInSession long, level string")
    step = log.groupBy("userId", "level").agg(F.max(recency(F.col("ts"), F.col("itemInSession"))))
    assert "SortAggregate" not in step._jdf.queryExecution().executedPlan().toString()


def test_fewest_come_first(spark):
    counts = spark.createDataFrame([("b", 2), ("c", 1), ("a", 2)], "c string, n long")
    assert [tuple(r) for r in breakdown.fewest_first(counts).collect()] == [("c", 1), ("a", 2), ("b", 2)]


def test_many_pages_keep_codegen_and_narrow_rows(spark):
    pages = [f"p{i}" for i in range(400)]
    log = spark.range(4000).selectExpr(
        "id % 10 AS userId", "date_add(date'2024-01-01', cast(id % 50 AS int)) AS date", "concat('p', id % 400) AS page"
    )
    counts = behaviour.page_counts(log, pages)
    assert len(counts.columns) == 4
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    visits = behaviour.page_visits(log, pages)
    assert len(visits.columns) == 801 and visits.count() == 10
