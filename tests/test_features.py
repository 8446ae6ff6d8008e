import pytest
from tests.log_fixture import GOLDEN, GOLDEN_PAGES, log, ms
from pyspark.sql import functions as F

from ebbwatch.operators import account, behaviour, breakdown, label
from ebbwatch.operators.clean import clean_activity
from ebbwatch.plans.features import complete_rows, feature_columns, user_features


@pytest.fixture(scope="module")
def clean(spark):
    return clean_activity(log(spark, GOLDEN)).persist()


def by_user(df):
    return {row.userId: row.asDict() for row in df.collect()}


def test_clean_keeps_eight_rows(clean):
    assert clean.count() == 8
    assert {r.location for r in clean.select("location").distinct().collect()} == {"NY", None}
    assert {r.page for r in clean.select("page").distinct().collect()} == set(GOLDEN_PAGES)


def test_golden_features(clean):
    rows = by_user(user_features(clean, GOLDEN_PAGES, with_avg_length=True))
    assert set(rows) == {1, 2}
    expected = {
        1: dict(
            label=1, location="NY", gender="F", last_interaction=ms("2018-11-01 09:00:30"), registered_days=61,
            valid_level="paid", avg_length=150.0, avg_daily_session_duration=170.0,
            avg_monthly_session_duration=315.0, avg_daily_items=4 / 3, avg_monthly_items=1.5,
            avg_daily_sessions=4 / 3, avg_monthly_sessions=1.5, avg_daily_Home=1.0, avg_monthly_Home=2.0,
            avg_daily_NextSong=1.0, avg_monthly_NextSong=2.0,
        ),
        2: dict(
            label=0, location=None, gender="M", last_interaction=ms("2018-10-05 08:01:00"), registered_days=34,
            valid_level="free", avg_length=None, avg_daily_session_duration=60.0, avg_monthly_session_duration=60.0,
            avg_daily_items=1.0, avg_monthly_items=1.0, avg_daily_sessions=1.0, avg_monthly_sessions=1.0,
            avg_daily_Home=2.0, avg_monthly_Home=2.0, avg_daily_NextSong=0.0, avg_monthly_NextSong=0.0,
        ),
    }
    for user, values in expected.items():
        assert {k: v for k, v in rows[user].items() if k != "userId"} == pytest.approx(values)


def test_only_complete_users_remain(clean):
    assert [r.userId for r in complete_rows(user_features(clean, GOLDEN_PAGES)).collect()] == [1]


def test_input_columns_in_schema_order(clean):
    features = user_features(clean, GOLDEN_PAGES)
    names = feature_columns(features)
    assert names == [c for c in features.columns if c not in ("userId", "gender", "location", "label", "valid_level")]
    assert "last_interaction" not in feature_columns(features, exclude=["last_interaction"])


def test_pages_can_be_discovered(clean):
    assert behaviour.discover_pages(clean) == GOLDEN_PAGES
    assert user_features(clean).columns == user_features(clean, GOLDEN_PAGES).columns
    with pytest.raises(ValueError, match="distinct pages"):
        behaviour.discover_pages(clean, limit=3)


def test_result_does_not_depend_on_partitioning(clean):
    one = user_features(clean.coalesce(1), GOLDEN_PAGES)
    many = user_features(clean.repartition(7, F.rand(1)), GOLDEN_PAGES)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_confirmation_page_counts_only_on_request(spark):
    base = dict(userId="7", ts=ms("2020-01-01"), auth="Logged In", level="free")
    clean = clean_activity(log(spark, [dict(base, page="Cancellation Confirmation")]))
    assert label.churn_label(clean).head().label == 0
    assert label.churn_label(clean, [*label.CANCEL_PAGES, "CancellationConfirmation"]).head().label == 1


def test_unknown_page_or_auth(spark):
    base = dict(userId="7", ts=ms("2020-01-01"), level="free")
    events = [dict(base, page=None, auth="Logged In"), dict(base, page="Cancel", auth=None)]
    clean = clean_activity(log(spark, events))
    assert clean.count() == 1
    assert label.churn_label(clean).head().label == 0


def test_month_grain(spark):
    base = dict(userId="7", sessionId=1, auth="Logged In", level="free", page="Home", itemInSession=0)
    clean = clean_activity(log(spark, [dict(base, ts=ms("2020-01-05")), dict(base, ts=ms("2021-01-05"), itemInSession=4)]))
    # The same month of two years is one month by default and two with the calendar grain.
    assert behaviour.items(clean).head().avg_monthly_items == 4.0
    assert behaviour.items(clean, "yyyy-MM").head().avg_monthly_items == 2.0
    with pytest.raises(ValueError, match="month grain"):
        behaviour.items(clean, "week")


def test_null_sessions_are_timed_but_not_counted(spark):
    base = dict(userId="7", auth="Logged In", level="free", page="Home", itemInSession=0)
    clean = clean_activity(
        log(spark, [dict(base, ts=ms("2020-01-05 10:00:00")), dict(base, ts=ms("2020-01-05 10:00:10")),
                    dict(base, ts=ms("2020-01-05 11:00:00"), sessionId=3)])
    )
    row = behaviour.user_behaviour(clean).head()
    assert row.avg_daily_session_duration == 5.0
    assert row.avg_daily_sessions == 1.0


def test_latest_level_ties_go_to_the_later_position(spark):
    base = dict(userId="7", ts=ms("2020-01-05"), auth="Logged In", page="Home")
    events = [dict(base, level="paid", itemInSession=3), dict(base, level="free", itemInSession=4)]
    clean = clean_activity(log(spark, events))
    assert account.valid_level(clean).head().valid_level == "free"
    same_position = clean_activity(log(spark, [dict(e, itemInSession=3) for e in events]))
    assert account.valid_level(same_position).head().valid_level == "paid"


def test_several_registrations_give_several_rows(spark):
    base = dict(userId="7", sessionId=1, itemInSession=0, auth="Logged In", page="Home", level="free", gender="F", location="A,NY")
    events = [
        dict(base, ts=ms("2020-01-05"), registration=ms("2020-01-01")),
        dict(base, ts=ms("2020-01-06"), registration=ms("2020-01-03")),
        # Another registration time with the same number of days: no row of its own.
        dict(base, ts=ms("2020-01-04"), registration=ms("2020-01-03") - 1000),
    ]
    clean = clean_activity(log(spark, events))
    rows = user_features(clean, ["Home"]).orderBy("registered_days").collect()
    assert [r.registered_days for r in rows] == [3, 5]
    assert {r.last_interaction for r in rows} == {ms("2020-01-06")}
    # Each event counts with its own registration: (5 + 3 + 3) / 3.
    assert breakdown.avg_registered_days(clean).head().avg_registered_days == pytest.approx(11 / 3)


def test_days_before_registration_truncate_towards_zero(spark):
    base = dict(userId="7", auth="Logged In", page="Home", level="free")
    clean = clean_activity(log(spark, [dict(base, ts=ms("2020-01-05 00:00:00"), registration=ms("2020-01-06 12:00:00"))]))
    assert account.registered_days(clean).head().registered_days == -1


def test_unknown_metric(clean):
    with pytest.raises(ValueError, match="unknown metrics"):
        behaviour.user_behaviour(clean, metrics=["clicks"])
