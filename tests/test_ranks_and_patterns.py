"""Null patterns, ranks over all rows, and dictionaries of any size."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from ebbwatch.functions.running import running_totals
from ebbwatch.operators.dictionary import index_columns, value_index, with_index
from ebbwatch.operators.null_patterns import null_groups, null_implications, null_patterns
from ebbwatch.operators.ranking import auc_ranked, roc_curve, score_ranks


def test_null_patterns_of_many_columns(spark):
    rng = random.Random(1)
    names = [f"c.{i}" for i in range(150)]  # three masks, and names with a dot
    rows = []
    for _ in range(200):
        hidden = {rng.choice([0, 61, 62, 123, 124, 149]) for _ in range(rng.randrange(3))}
        hidden |= {5, 130} if rng.random() < 0.5 else set()
        rows.append(tuple(None if i in hidden else i for i in range(150)))
    frame = spark.createDataFrame(rows, ", ".join(f"`{n}` int" for n in names))
    expected = {}
    for row in rows:
        key = tuple(n for n, v in zip(names, row) if v is None)
        expected[key] = expected.get(key, 0) + 1
    got = null_patterns(frame).collect()
    assert {tuple(r["columns"]): r.n for r in got} == expected
    assert all(r.n_columns == len(r["columns"]) for r in got)
    assert ("c.130,c.5", sum(n for k, n in expected.items() if "c.5" in k)) in [tuple(r) for r in null_groups(frame).collect()]
    pairs = {(r.if_null, r.then_null): r for r in null_implications(frame).collect()}
    assert pairs["c.5", "c.130"].together and pairs["c.130", "c.5"].always
    for (a, b), r in pairs.items():
        n_a, n_both = (sum(n for k, n in expected.items() if {a, *x} <= set(k)) for x in ((), (b,)))
        assert (r.n_if, r.n_both, r.always, r.share) == (n_a, n_both, n_a == n_both, n_both / n_a)


def test_null_patterns_edges(spark):
    full = spark.createDataFrame([(1, "a")], "x int, y string")
    assert [tuple(r) for r in null_patterns(full).collect()] == [([], 0, 1)]
    assert null_implications(full).count() == null_groups(full).count() == 0
    assert null_patterns(full.limit(0)).count() == 0
    one = spark.createDataFrame([(None, "a")] * 3, "x int, y string")
    assert [tuple(r) for r in null_patterns(one, ["x"]).collect()] == [(["x"], 1, 3)]


def test_running_totals_over_many_ranges(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(100)) for i in range(5_000)]
    frame = spark.createDataFrame(rows, "k int, v long").repartition(7)
    got = {r.k: (r.number, r.before) for r in running_totals(frame, [F.col("k").desc()], {"number": F.lit(1), "before": F.col("v")}).collect()}
    total = 0
    for place, (k, v) in enumerate(sorted(rows, reverse=True)):
        assert got[k] == (place, total)
        total += v
    frame = running_totals(frame.limit(0), [F.col("k")], {"number": F.lit(1)})
    assert frame.collect() == [] and dict(frame.dtypes)["number"] == "bigint"


def test_auc_against_evaluator_and_pairs(spark):
    rng = random.Random(3)
    for values in (6, 10_000):  # many ties, few
        rows = [(rng.randrange(values) / 7, int(rng.random() < 0.3)) for _ in range(3_000)]
        frame = spark.createDataFrame(rows, "score double, label int").repartition(5)
        evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
        assert auc_ranked(frame).first().auc == pytest.approx(evaluator.evaluate(frame), abs=1e-9)
    rows = rows[:60]
    frame = spark.createDataFrame(rows, "score double, label int")
    won = sum((a > b) + (a == b) / 2 for a, x in rows if x for b, y in rows if not y)
    pos = sum(x for _, x in rows)
    assert tuple(auc_ranked(frame).first()) == (pytest.approx(won / pos / (60 - pos)), pos, 60 - pos)


def test_rank_edges(spark):
    frame = spark.createDataFrame([(0.0, 1), (-0.0, 0), (None, 1), (1.0, None), (2.0, 1)], "score double, label int")
    ranks = {r.score: tuple(r)[1:] for r in score_ranks(frame).collect()}
    assert ranks == {0.0: (2, 1, 1, 0, 0, 0, 1.5), 2.0: (1, 1, 0, 2, 1, 1, 3.0)}
    assert auc_ranked(frame).first().auc == 0.75
    assert {tuple(r) for r in roc_curve(frame).collect()} == {(0.0, 1.0, 1.0, 2 / 3), (2.0, 0.5, 0.0, 1.0)}
    assert tuple(auc_ranked(frame.where("score = 2")).first()) == (None, 1, 0)
    assert tuple(auc_ranked(frame.limit(0)).first()) == (None, 0, 0)


def test_hot_score_is_one_row_before_it_is_ranked(spark):
    frame = spark.range(100_000).select(F.lit(0.5).alias("score"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    assert score_ranks(frame).collect()[0][:4] == (0.5, 100_000, 25_000, 75_000)


def test_dictionary_is_that_of_the_indexer(spark):
    rng = random.Random(4)
    values = [rng.choice("aabbbcdefgh") if rng.random() < 0.9 else None for _ in range(500)]
    frame = spark.createDataFrame([(i, v, rng.choice(["x", "y", None])) for i, v in enumerate(values)], "id int, v string, w string")
    fitted = StringIndexer(inputCol="v", outputCol="i", handleInvalid="skip", stringOrderType="frequencyDesc").fit(frame)
    assert [r.value for r in value_index(frame, "v").orderBy("idx").collect()] == list(fitted.labels)
    rows, dictionaries = index_columns(frame, ["v", "w"])
    expected = {r.id: r.i for r in fitted.transform(frame).where("w is not null").collect()}
    assert {r.id: r.v_index for r in rows.collect()} == expected
    kept = with_index(frame, "v", dictionaries["v"], keep_unknown=True)
    assert kept.count() == 500 and kept.where("v is null").select("v_index").distinct().collect() == [(float(len(fitted.labels)),)]


def test_dictionary_of_a_million_values(spark):
    frame = spark.range(0, 1_000_000, 1, 8).select(F.concat(F.lit("v"), "id").alias("v"))
    frame = frame.union(frame.sparkSession.range(300_000).select(F.lit("hot").alias("v")))
    found = value_index(frame, "v")
    sums = found.agg(F.min("idx"), F.max("idx"), F.count_distinct("idx"), F.sum("n")).first()
    assert tuple(sums) == (0, 1_000_000, 1_000_001, 1_300_000)
    assert tuple(found.where("idx = 0").first()) == ("hot", 300_000, 0)
    assert [r.value for r in found.where("idx between 1 and 3").orderBy("idx").collect()] == ["v0", "v1", "v10"]
    assert with_index(frame, "v", found).where("v_index is null").count() == 0
