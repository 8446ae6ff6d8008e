"""Plans and results under skew: a third of the log belongs to one user."""

import pytest
from pyspark.sql import functions as F
from tests.log_fixture import ms

import __spark_entry__ as registry
from ebbwatch.operators import behaviour, breakdown, label
from ebbwatch.operators.clean import clean_activity
from ebbwatch.plans.features import user_features
from ebbwatch.sources.star_tables import PAGES, activity_log


def final_plan(frame) -> str:
    """The plan as the adaptive planner left it after the run."""
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 events; user 0 has a third of them."""
    page = F.element_at(F.array(*[F.lit(p) for p in ["NextSong", "Home", "Error", "Thumbs Up"]]), (F.col("id") % 4 + 1).cast("int"))
    log = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).cast("string").alias("userId"),
        (F.lit(ms("2024-01-01")) + F.col("id") * 200_000).alias("ts"),
        page.alias("page"), F.lit("Logged In").alias("auth"), F.lit("free").alias("level"),
        F.lit("F").alias("gender"), F.lit("Albany, NY").alias("location"), F.lit(ms("2023-12-01")).alias("registration"),
        F.floor(F.col("id") / 50).alias("sessionId"), (F.col("id") % 50).alias("itemInSession"),
    )
    return clean_activity(log).persist()


@pytest.fixture
def settings(spark):
    changed = {}

    def set_(**values):
        for key, value in values.items():
            name = "spark.sql." + key.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield set_
    for name, value in changed.items():
        spark.conf.set(name, value)


def test_hot_user_is_spread_in_the_event_join(skewed, settings, monkeypatch):
    settings(**SPLIT_SMALL_PARTITIONS)

    def joined():
        return label.label_join(skewed, label.churn_label(skewed)).select("userId", "ts", "page", "label")

    final_plan(joined())
    rows = joined().where("userId = 0").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in rows) == skewed.where("userId = 0").count()
    assert max(r["count"] for r in rows) < 5_000
    # Where salts do not suffice, the adaptive planner splits what is still too large.
    monkeypatch.setattr(label, "JOIN_SALTS", 1)
    assert "skew=true" in final_plan(joined())
    assert joined().count() == 30_000


def test_features_of_a_hot_user(skewed):
    rows = {r.userId: r for r in user_features(skewed, PAGES).collect()}
    assert len(rows) == 500
    pandas = skewed.where("userId = 0").toPandas()
    per_session = pandas.groupby(["date", "sessionId"]).ts.agg(lambda t: (t.max() - t.min()) * 0.001)
    assert rows[0].avg_daily_session_duration == pytest.approx(per_session.groupby("date").mean().mean())
    assert rows[0].avg_daily_sessions == pytest.approx(pandas.groupby("date").sessionId.nunique().mean())
    songs = pandas[pandas.page == "NextSong"].groupby("month").size().mean()
    assert rows[0].avg_monthly_NextSong == pytest.approx(songs)


def test_behaviour_has_neither_joins_nor_sorts(skewed):
    # The first aggregate combines before anything is shuffled.
    for metrics, first in ((["duration", "items", "sessions"], "partial_min(ts"), (["pages"], "partial_count(1)")):
        plan = final_plan(behaviour.user_behaviour(skewed, PAGES, metrics))
        assert "Join" not in plan and "Sort" not in plan and "Window" not in plan
        assert first in plan


def test_breakdowns_do_not_join_the_log(skewed):
    plan = final_plan(breakdown.events_by(skewed, "level"))
    assert "Join" not in plan


def test_no_python_workers_and_no_sort_aggregates_over_the_log(spark, sf_dir):
    plan = final_plan(registry.queries()["user_features"](spark, sf_dir))
    assert "Python" not in plan and "Pandas" not in plan
    assert "SortAggregate" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_needed_columns_only(spark, sf_dir):
    plan = registry.queries()["last_interaction"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "customer.parquet" not in plan and "Window" not in plan
    assert "event_id" not in plan


SPLIT_SMALL_PARTITIONS = dict(
    autoBroadcastJoinThreshold="-1",
    adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
    adaptive__skewJoin__skewedPartitionFactor="2",
    adaptive__advisoryPartitionSizeInBytes="10k",
    adaptive__coalescePartitions__enabled="false",
)


def test_hot_user_of_the_tables(spark, tmp_path, settings):
    """The join with the accounts splits the hot user, and the numbering in slices equals
    one window per session."""
    spark.range(0, 12_000, 1, 8).select(
        F.col("id").alias("event_id"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.pmod(F.hash("id"), F.lit(2_000_000_000)).cast("bigint") * 1000)
        .cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1500).cast("bigint").alias("user_id"),
        F.element_at(F.array(*map(F.lit, ["view", "click", "error"])), (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
        (F.col("id") % 250).cast("double").alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 100).alias("props"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(1500).select(
        F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey")
    ).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(25).select(F.col("id").cast("int").alias("n_nationkey")).write.parquet(f"{tmp_path}/nation.parquet")

    settings(**SPLIT_SMALL_PARTITIONS)
    accounts_joined = activity_log(spark, str(tmp_path), "userId", "ts", "page", "location")
    assert "skew=true" in final_plan(accounts_joined)
    assert accounts_joined.count() == 12_000

    log = activity_log(spark, str(tmp_path))
    events = spark.read.parquet(f"{tmp_path}/events.parquet").toPandas()
    events["ms"] = 1_704_067_200_000 + 3 * (events.ts.astype("datetime64[ms]").astype("int64") - 1_704_067_200_000)
    events["k"] = events.props.str.extract(r"(\d+)").astype(int)
    events["session"] = events.ms // 172_800_000 * 2 + events.k % 2
    events = events.sort_values(["ms", "event_id"])
    events["item"] = events.groupby(["user_id", "session"]).cumcount()
    expected = sorted(zip(events.ms, events.session, events["item"]))
    found = sorted((r.ts, r.sessionId, r.itemInSession) for r in log.select("ts", "sessionId", "itemInSession").collect())
    assert found == expected


@pytest.mark.parametrize("query", ["hist_sessions", "hist_items", "hist_registered_days"])
def test_histograms_compute_their_values_once(spark, sf_dir, query):
    # Ranges and counts share the shuffle of the per-user values.
    assert final_plan(registry.queries()[query](spark, sf_dir)).count("ReusedExchange") >= 2


def test_landed_days_are_pruned(spark, skewed, tmp_path):
    from ebbwatch.sources.activity_log import land_clean_log, read_clean_log

    land_clean_log(skewed, f"{tmp_path}/log")
    landed = read_clean_log(spark, f"{tmp_path}/log", skewed.schema)
    assert sorted(landed.columns) == sorted(skewed.columns)
    one_day = landed.where("date = '2024-01-03' and page = 'Home'").select("userId")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert landed.count() == 30_000
    assert one_day.count() == skewed.where("date = '2024-01-03' and page = 'Home'").count()
