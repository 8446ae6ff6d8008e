"""Activity cubes: mergeable states of the log by user, day, session, page and attributes.

All user features come from minima, maxima, counts and sums, which can be merged. A cube is made in one scan of a
batch of the log, stored by day, and merged with those of other batches whenever features are asked for, so a new day costs
a scan of that day only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.functions.columns import recency
from ebbwatch.operators.account import ACCOUNT_KEYS, account_table
from ebbwatch.operators.behaviour import discover_pages, user_behaviour
from ebbwatch.operators.label import CANCEL_PAGES, churn_flag
from ebbwatch.sources.batches import land_batch, read_batches

KEYS = (*ACCOUNT_KEYS, "date", "sessionId", "page")


def activity_cube(clean: DataFrame, cancel_pages: Sequence[str] = CANCEL_PAGES) -> DataFrame:
    """One row for each value of ``KEYS``: n, start, end, items, rank, flag, and the sum and number of lengths (0 if the log has none).

    One hash aggregate with fixed-width buffers: a hot user or day is reduced before it is shuffled.
    """
    length = F.col("length") if "length" in clean.columns else F.lit(None).cast("double")
    return clean.groupBy(*KEYS).agg(
        F.count("*").alias("n"), F.min("ts").alias("start"), F.max("ts").alias("end"), F.max("itemInSession").alias("items"),
        F.max(recency(F.col("ts"), F.col("itemInSession"))).alias("rank"), F.max(churn_flag(cancel_pages)).alias("flag"),
        F.coalesce(F.sum(length), F.lit(0.0)).alias("length_sum"), F.count(length).alias("length_n"),
    )


def merged_cube(cubes: DataFrame) -> DataFrame:
    """The cube of all batches together. Features do not need it, since they merge states as they go; smaller tables do."""
    sums, least, most = ("n", "length_sum", "length_n"), ("start",), ("end", "items", "rank", "flag")
    return cubes.groupBy(*KEYS).agg(
        *(F.sum(c).alias(c) for c in sums), *(F.min(c).alias(c) for c in least), *(F.max(c).alias(c) for c in most)
    )


def features_from_cube(
    cube: DataFrame, pages: Sequence[str] | None = None, month_grain: str = "month", with_avg_length: bool = False
) -> DataFrame:
    """The user feature table, from the cube of the whole log or the cubes of its batches."""
    accounts = account_table(
        cube.groupBy(*ACCOUNT_KEYS).agg(F.max("end").alias("seen"), F.max("rank").alias("rank"), F.max("flag").alias("flag"))
    )
    pages = discover_pages(cube) if pages is None else pages
    features = accounts.join(user_behaviour(cube, pages, month_grain=month_grain, from_states=True), "userId")
    if with_avg_length:
        lengths = cube.groupBy("userId").agg((F.sum("length_sum") / F.nullif(F.sum("length_n"), F.lit(0))).alias("avg_length"))
        features = features.join(lengths, "userId")
    return features


def cube_schema(clean: DataFrame) -> T.StructType:
    return activity_cube(clean).schema


def add_to_cubes(clean: DataFrame, path: str, batch: str, cancel_pages: Sequence[str] = CANCEL_PAGES) -> DataFrame:
    """Store the cube of a batch of the cleaned log, and give the cubes of all batches.

    A batch that is stored again replaces itself, so a job that failed half-way is run again.
    """
    cube = activity_cube(clean, cancel_pages)
    land_batch(cube, path, batch)
    return read_batches(clean.sparkSession, path, cube.schema)
