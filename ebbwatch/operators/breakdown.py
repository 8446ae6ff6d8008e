"""Counts of events and users by attribute and churn label.

No operator here joins the log with the labels. Each first reduces the log to
(user, attribute) rows, then reads the user's label off those few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbwatch.functions.columns import whole_days
from ebbwatch.operators.label import CANCEL_PAGES, churn_flag


def event_counts(log: DataFrame, *columns: str) -> DataFrame:
    """Events by the given columns, nulls included."""
    return log.groupBy(*columns).agg(F.count("*").alias("n"))


def fewest_first(counts: DataFrame) -> DataFrame:
    return counts.orderBy("n", *[c for c in counts.columns if c != "n"])


def _labelled(clean: DataFrame, attribute: str, cancel_pages: Sequence[str]) -> DataFrame:
    """(userId, attribute, n, label). The window sees the distinct attribute values of one
    user: at most the number of levels, genders or states."""
    return (
        clean.groupBy("userId", attribute)
        .agg(F.count("*").alias("n"), F.max(churn_flag(cancel_pages)).alias("flag"))
        .withColumn("label", F.max("flag").over(Window.partitionBy("userId")))
    )


def users_by(clean: DataFrame, attribute: str, cancel_pages: Sequence[str] = CANCEL_PAGES) -> DataFrame:
    """Users by attribute value and label."""
    return _labelled(clean, attribute, cancel_pages).groupBy(attribute, "label").agg(F.count("*").alias("n"))


def events_by(clean: DataFrame, attribute: str, cancel_pages: Sequence[str] = CANCEL_PAGES) -> DataFrame:
    """Events by attribute value and label."""
    return _labelled(clean, attribute, cancel_pages).groupBy(attribute, "label").agg(F.sum("n").alias("n"))


def label_share(counts: DataFrame, attribute: str) -> DataFrame:
    """Add the share that each label has within its attribute value."""
    total = F.sum("n").over(Window.partitionBy(attribute))
    return counts.withColumn("label_share", F.col("n") / total)


def crosstab(counts: DataFrame, index: str, columns: str, values: Sequence) -> DataFrame:
    """Counts as a table: one row per ``index``, one column per value, plus ``other`` for values that
    are not listed and ``missing`` for null."""
    column, n = F.col(columns), F.col("n")
    cells = [F.sum(F.when(column == v, n)).alias(str(v)) for v in values]
    other = F.sum(F.when(~column.isin(*values), n)).alias("other")
    missing = F.sum(F.when(column.isNull(), n)).alias("missing")
    return counts.groupBy(index).agg(*cells, other, missing)


def avg_registered_days(clean: DataFrame, cancel_pages: Sequence[str] = CANCEL_PAGES) -> DataFrame:
    """(userId, label, avg_registered_days), each event counting with its own registration."""
    user = Window.partitionBy("userId")
    per_registration = clean.groupBy("userId", "registration").agg(
        F.count("*").alias("n"), F.max("ts").alias("seen"), F.max(churn_flag(cancel_pages)).alias("flag")
    )
    days = whole_days(F.max("seen").over(user), F.col("registration"))
    return (
        per_registration.select("userId", "n", "flag", days.alias("days"))
        .groupBy("userId")
        .agg(
            F.max("flag").alias("label"),
            (F.sum(F.col("days") * F.col("n")) / F.sum(F.when(F.col("days").isNotNull(), F.col("n"))))
            .alias("avg_registered_days"),
        )
    )


def sessions_per_user(clean: DataFrame, cancel_pages: Sequence[str] = CANCEL_PAGES) -> DataFrame:
    """(userId, label, n_sessions)."""
    return (
        clean.groupBy("userId", "sessionId").agg(F.max(churn_flag(cancel_pages)).alias("flag"))
        .groupBy("userId").agg(F.max("flag").alias("label"), F.count("*").alias("n_sessions"))
    )


def avg_item_in_session(clean: DataFrame, cancel_pages: Sequence[str] = CANCEL_PAGES) -> DataFrame:
    """(userId, label, avg_item_in_session)."""
    return clean.groupBy("userId").agg(
        F.max(churn_flag(cancel_pages)).alias("label"), F.avg("itemInSession").alias("avg_item_in_session")
    )
