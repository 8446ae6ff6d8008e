"""Stored cubes, tables that grow by batches, and page features without columns."""

import os
import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F
from tests.log_fixture import GOLDEN, GOLDEN_PAGES, log, ms

from ebbwatch.ml.page_vectors import assembled, page_entries, page_positions, page_vectors
from ebbwatch.operators.account import account_rows, avg_length
from ebbwatch.operators.behaviour import page_means_long, user_behaviour
from ebbwatch.operators.clean import clean_activity
from ebbwatch.plans.cubes import activity_cube, add_to_cubes, features_from_cube, merged_cube
from ebbwatch.plans.features import user_features
from ebbwatch.sources.activity_log import RAW_SCHEMA
from ebbwatch.sources.batches import land_batch, landed_days, read_batches


def random_log(spark, seed, events=400):
    rng = random.Random(seed)
    rows = [
        dict(
            userId=rng.choice(["1", "2", "3", "3", "3", "4", None, "x"]), ts=ms("2024-01-30") + rng.randrange(6 * 86_400) * 1000,
            sessionId=rng.choice([1, 2, 3, None]), itemInSession=rng.choice([None, *range(9)]), page=rng.choice(["Home", "NextSong", "Cancel", "Error", None]),
            auth=rng.choice(["Logged In", "Logged In", "Logged Out"]), level=rng.choice(["free", "paid", None]), length=rng.choice([None, 1.5, 2.25]),
            location=rng.choice(["Albany, NY", "Albany, NY", None]), gender=rng.choice(["F", "F", "F", None]), registration=ms("2023-01-01"),
        )
        for _ in range(events)
    ]
    return log(spark, rows)


def sorted_rows(frame):
    """Rows as text, doubles to nine decimals: sums of doubles depend on their order."""
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in frame.select(*sorted(frame.columns)).collect())


def apart(clean, pages):
    """The features with a pass over the events for each of their kinds."""
    return account_rows(clean).join(user_behaviour(clean, pages), "userId").join(avg_length(clean), "userId")


@pytest.mark.parametrize("seed", range(3))
def test_features_from_a_cube_and_from_cubes_of_batches(spark, tmp_path, seed):
    clean = clean_activity(random_log(spark, seed)).persist()
    pages = ["Cancel", "Error", "Home", "NextSong"]
    expected = sorted_rows(apart(clean, pages))
    assert sorted_rows(user_features(clean, with_avg_length=True)) == expected
    for part in (0, 1, 2, 1):  # the last comes again
        stored = add_to_cubes(clean.where(F.pmod(F.hash("ts", "page"), F.lit(3)) == part), f"{tmp_path}/cubes", f"b{part}")
    assert sorted_rows(features_from_cube(stored, with_avg_length=True)) == expected
    assert sorted_rows(merged_cube(stored)) == sorted_rows(activity_cube(clean))
    clean.unpersist()


def test_golden_features_from_a_cube(spark):
    clean = clean_activity(log(spark, GOLDEN))
    assert sorted_rows(features_from_cube(activity_cube(clean), GOLDEN_PAGES)) == sorted_rows(account_rows(clean).join(user_behaviour(clean, GOLDEN_PAGES), "userId"))


def test_log_is_scanned_once_for_a_cube(spark, tmp_path):
    random_log(spark, 9).write.parquet(f"{tmp_path}/log")
    cube = activity_cube(clean_activity(spark.read.schema(RAW_SCHEMA).parquet(f"{tmp_path}/log")))
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def days(spark, *numbers):
    return spark.createDataFrame([(n, f"2024-03-{n:02}") for n in numbers], "id int, day string").select("id", F.to_date("day").alias("date"))


def test_batches_replace_only_themselves(spark, tmp_path):
    path = f"{tmp_path}/table"
    land_batch(days(spark, 1, 2, 2, 3), path, "first")
    untouched = {d: os.stat(f"{path}/date=2024-03-0{d}/batch=first").st_mtime_ns for d in (1, 2, 3)}
    schema = days(spark, 1).schema
    land_batch(days(spark, 3, 4), path, "second")
    rows = lambda: sorted(r.id for r in read_batches(spark, path, schema).collect())
    assert rows() == [1, 2, 2, 3, 3, 4]
    land_batch(days(spark, 3, 4), path, "second")  # again
    assert rows() == [1, 2, 2, 3, 3, 4]
    assert {d: os.stat(f"{path}/date=2024-03-0{d}/batch=first").st_mtime_ns for d in (1, 2, 3)} == untouched
    land_batch(days(spark, 4, 5), path, "second")  # corrected: no third day any more
    assert rows() == [1, 2, 2, 3, 4, 5]
    assert {(str(r.date), r.batch, r.n) for r in landed_days(spark, path, schema).collect()} == {
        ("2024-03-01", "first", 1), ("2024-03-02", "first", 2), ("2024-03-03", "first", 1), ("2024-03-04", "second", 1), ("2024-03-05", "second", 1),
    }
    land_batch(days(spark, 1).withColumn("date", F.lit(None).cast("date")), path, "undated")
    assert rows() == [1, 1, 2, 2, 3, 4, 5]
    plan = read_batches(spark, path, schema).where("date = '2024-03-04'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    with pytest.raises(ValueError, match="batch name"):
        land_batch(days(spark, 1), path, "a/b")


def test_five_thousand_pages(spark):
    """More pages than columns would do for, as vectors that a classifier takes."""
    base = spark.range(0, 30_000, 1, 8)
    raw = base.select(
        (F.col("id") % 40).cast("string").alias("userId"), (F.lit(ms("2024-01-01")) + F.col("id") * 100_000).alias("ts"),
        F.concat(F.lit("Page"), F.col("id") % 5_000).alias("page"), F.lit("Logged In").alias("auth"), F.lit("F").alias("gender"),
        F.lit("free").alias("level"), F.lit("Albany, NY").alias("location"), F.lit(ms("2023-12-01")).alias("registration"),
        F.floor(F.col("id") / 50).alias("sessionId"), (F.col("id") % 50).alias("itemInSession"),
    )
    clean = clean_activity(raw.union(raw.where("id = 0").withColumn("userId", F.lit("99")).withColumn("page", F.lit("Cancel"))).drop("id")).persist()
    with pytest.raises(ValueError, match="page_means_long"):
        user_features(clean)
    means = page_means_long(clean).persist()
    positions = page_positions(means).persist()
    assert positions.count() == 10_000
    features = account_rows(clean).join(user_behaviour(clean, metrics=["duration", "items", "sessions"]), "userId")
    vectors = page_vectors(means, features, positions)
    got = page_entries(vectors, positions)
    expected = means.select("userId", F.concat(F.lit("avg_"), "grain", F.lit("_"), "page").alias("feature"), F.col("mean").alias("value"))
    assert got.select("userId", "feature", "value").exceptAll(expected).isEmpty() and got.count() == expected.count()
    names, rows = assembled(features, vectors, exclude=["last_interaction"])
    first = rows.where("userId = 99").first()
    assert first.features.size == len(names) + 10_000 and first.pages.numNonzeros() == 0
    model = LogisticRegression(maxIter=3).fit(rows)
    assert model.numFeatures == len(names) + 10_000 and model.transform(rows).count() == 41
