"""From the raw log to the cleaned log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.functions.columns import instant, state_of, stripped


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def clean_strings(log: DataFrame) -> DataFrame:
    """Strip every string column, in one projection."""
    return log.withColumns({name: stripped(F.col(name)) for name in string_columns(log)})


def event_time(log: DataFrame) -> DataFrame:
    """Add interaction_time (whole seconds), month of the year and date of each event."""
    return (
        log.withColumn("interaction_time", instant(F.col("ts")))
        .withColumns({"month": F.month("interaction_time"), "date": F.to_date("interaction_time")})
    )


def clean_activity(log: DataFrame) -> DataFrame:
    """Cleaned log: stripped strings, event times, numeric users, states for locations.

    Rows without a numeric user and rows of logged-out visitors (or of unknown auth)
    are dropped. Works on any subset of the log's columns that has userId, ts and auth,
    so callers read only what they need.
    """
    known = log.where(F.col("userId").isNotNull() & F.col("auth").isNotNull())
    clean = event_time(clean_strings(known)).withColumn("userId", F.col("userId").try_cast("bigint"))
    if "location" in clean.columns:
        clean = clean.withColumn("location", state_of(F.col("location")))
    return clean.where(F.col("userId").isNotNull() & (F.col("auth") != "LoggedOut"))
