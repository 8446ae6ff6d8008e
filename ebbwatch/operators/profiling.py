"""Profile of a log: counts, ranges, distinct values, nulls, summary statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.functions.columns import instant

# Columns whose distinct values are of interest.
CATEGORIES = ("page", "auth", "level", "gender", "status", "method")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order (a distributed top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


def _one_row_per_column(aggregated: DataFrame, rows: list[Column]) -> DataFrame:
    return aggregated.select(F.inline(F.array(*rows)))


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nullable, n_null) for every column."""
    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"), F.lit(f.nullable).alias("nullable"),
            F.col(f.name).alias("n_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return _one_row_per_column(null_counts(df), rows)


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def null_by_auth(log: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls of the columns per auth state: columns that are null together stand out."""
    return log.groupBy("auth").agg(
        F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns]
    )


def distinct_users(log: DataFrame) -> DataFrame:
    return log.agg(F.countDistinct("userId").alias("n_users"))


def time_range(log: DataFrame) -> DataFrame:
    """First and last date; the dates are taken from the extreme times, not per row."""
    bounds = log.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return bounds.select(
        F.to_date(instant(F.col("lo"))).alias("first_date"), F.to_date(instant(F.col("hi"))).alias("last_date")
    )


def distinct_values(log: DataFrame, columns: Sequence[str] = CATEGORIES) -> DataFrame:
    """(column_name, value, n) for each value of the columns, nulls included.

    Rows are counted per combination first: few combinations exist, so the unpivot
    handles a handful of rows rather than several copies of the log.
    """
    combinations = log.groupBy(*columns).agg(F.count("*").alias("n"))
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    return (
        combinations.select("n", F.inline(F.array(*pairs)))
        .groupBy("column_name", "value").agg(F.sum("n").alias("n"))
    )


def pages_without_null_artist(log: DataFrame) -> DataFrame:
    """Pages that never occur with a null artist.

    The difference of two sets of pages over the same log, taken in one pass.
    """
    return (
        log.groupBy("page").agg(F.count_if(F.col("artist").isNull()).alias("n_null"))
        .where("n_null = 0").select("page")
    )


def rows_where(log: DataFrame, condition: str) -> DataFrame:
    return log.where(condition)


def describe(df: DataFrame) -> DataFrame:
    """(column_name, n, mean, stddev, min_number, max_number, min_text, max_text) per column.

    Text that reads as a number takes part in mean and stddev. Everything is
    computed in one pass with one aggregate.
    """
    aggregates, rows = [], []
    for i, f in enumerate(df.schema.fields):
        text = isinstance(f.dataType, T.StringType)
        number = F.col(f.name).try_cast("double")
        mean = F.avg(number)
        if isinstance(f.dataType, T.IntegralType):
            # Exact whatever the order of the rows; a sum of large longs as doubles is not.
            mean = F.sum(F.col(f.name).cast("decimal(20,0)")).cast("double") / F.nullif(F.count(f.name), F.lit(0))
        aggregates += [
            F.count(f.name).alias(f"n{i}"), mean.alias(f"mean{i}"), F.stddev_samp(number).alias(f"sd{i}"),
            F.min(f.name).alias(f"lo{i}"), F.max(f.name).alias(f"hi{i}"),
        ]
        none_text, none_number = F.lit(None).cast("string"), F.lit(None).cast("double")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"), F.col(f"n{i}").alias("n"),
                F.col(f"mean{i}").alias("mean"), F.col(f"sd{i}").alias("stddev"),
                (none_number if text else F.col(f"lo{i}").cast("double")).alias("min_number"),
                (none_number if text else F.col(f"hi{i}").cast("double")).alias("max_number"),
                (F.col(f"lo{i}") if text else none_text).alias("min_text"),
                (F.col(f"hi{i}") if text else none_text).alias("max_text"),
            )
        )
    return _one_row_per_column(df.agg(*aggregates), rows)
