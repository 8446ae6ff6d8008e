"""Attributes of a user as a whole: recency, tenure, plan, mean song length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbwatch.functions.columns import recency, whole_days
from ebbwatch.operators.label import CANCEL_PAGES, churn_flag


ACCOUNT_KEYS = ("userId", "gender", "location", "registration", "level")


def last_interaction(clean: DataFrame) -> DataFrame:
    return clean.groupBy("userId").agg(F.max("ts").alias("last_interaction"))


def valid_level(clean: DataFrame) -> DataFrame:
    """(userId, valid_level): the level of the user's latest event.

    Ties in time go to the later position in the session, then to the greater level.
    The first step reduces the log with a fixed-width buffer (see ``recency``).
    """
    return (
        clean.groupBy("userId", "level").agg(F.max(recency(F.col("ts"), F.col("itemInSession"))).alias("seen"))
        .groupBy("userId").agg(F.max_by("level", F.struct("seen", "level")).alias("valid_level"))
    )


def avg_length(clean: DataFrame) -> DataFrame:
    """(userId, avg_length): mean length of the played items."""
    return clean.groupBy("userId").agg(F.avg("length").alias("avg_length"))


def registered_days(clean: DataFrame) -> DataFrame:
    """(userId, registration, last_interaction, registered_days, n_events), one row per
    user and registration time. Days run from registration to the last interaction."""
    # A user has few registration times, so a window over the reduced rows stays small.
    user = Window.partitionBy("userId")
    return (
        clean.groupBy("userId", "registration").agg(F.max("ts").alias("seen"), F.count("*").alias("n_events"))
        .withColumn("last_interaction", F.max("seen").over(user))
        .select(
            "userId", "registration", "last_interaction",
            whole_days(F.col("last_interaction"), F.col("registration")).alias("registered_days"), "n_events",
        )
    )


def account_rows(clean: DataFrame, cancel_pages: Sequence[str] = CANCEL_PAGES) -> DataFrame:
    """All user attributes: one row per distinct (user, gender, location, registered_days).

    Users with one set of attributes, the normal case, have one row. One pass over the
    log reduces it to (user, attributes, level) rows; the windows then see only those.
    """
    return account_table(
        clean.groupBy(*ACCOUNT_KEYS).agg(
            F.max("ts").alias("seen"),
            F.max(recency(F.col("ts"), F.col("itemInSession"))).alias("rank"),
            F.max(churn_flag(cancel_pages)).alias("flag"),
        )
    )


def account_table(reduced: DataFrame) -> DataFrame:
    """The rows of ``account_rows`` from the log reduced to one row for each value of ``ACCOUNT_KEYS``."""
    user = Window.partitionBy("userId")
    return (
        reduced.select(
            "userId", "gender", "location", "registration",
            F.max("seen").over(user).alias("last_interaction"),
            F.max("flag").over(user).alias("label"),
            F.max_by("level", F.struct("rank", "level")).over(user).alias("valid_level"),
        )
        .select(
            "userId", "last_interaction", "gender", "location", "label",
            whole_days(F.col("last_interaction"), F.col("registration")).alias("registered_days"), "valid_level",
        )
        .distinct()
    )
