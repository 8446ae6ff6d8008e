"""Churn labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pages that mean churn. The second keeps its space and therefore never
# matches a cleaned page; pass "CancellationConfirmation" as well to count that page too.
CANCEL_PAGES = ("Cancellation Confirmation", "Cancel")

JOIN_SALTS = 8


def churn_flag(cancel_pages: Sequence[str] = CANCEL_PAGES) -> Column:
    """1 for an event that shows churn, else 0."""
    shows_churn = F.col("page").isin(*cancel_pages) | (F.col("auth") == "Cancelled")
    return F.when(shows_churn, 1).otherwise(0)


def churn_label(clean: DataFrame, cancel_pages: Sequence[str] = CANCEL_PAGES) -> DataFrame:
    """(userId, label): 1 if any event of the user shows churn."""
    return clean.groupBy("userId").agg(F.max(churn_flag(cancel_pages)).alias("label"))


def label_join(clean: DataFrame, labels: DataFrame) -> DataFrame:
    """Each event with its user's label, an equal share of each user's events per salt.

    No broadcast hint: labels grow with the users. The salt spreads a hot user over
    several tasks. It also gives the labels a shuffle of their own, which the adaptive
    planner needs to split partitions further: it does not where an aggregate sits
    between the shuffle and the join. Labels are narrow and few next to the events.
    """
    salts = F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))
    return (
        clean.withColumn("salt", F.pmod(F.hash("ts"), F.lit(JOIN_SALTS)))
        .join(labels.withColumn("salt", F.explode(salts)), ["userId", "salt"])
        .drop("salt")
    )
