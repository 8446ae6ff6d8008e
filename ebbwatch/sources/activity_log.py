"""Reading and writing activity logs and feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The 18 columns of the raw log, one row per user interaction.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("artist", T.StringType()),
        T.StructField("auth", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("itemInSession", T.LongType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("length", T.DoubleType()),
        T.StructField("level", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("registration", T.LongType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("song", T.StringType()),
        T.StructField("status", T.LongType()),
        T.StructField("ts", T.LongType()),
        T.StructField("userAgent", T.StringType()),
        T.StructField("userId", T.StringType()),
    ]
)


def read_json_log(spark: SparkSession, path: str) -> DataFrame:
    """Scan JSON lines with the declared schema: no inference pass over the data."""
    return spark.read.schema(RAW_SCHEMA).json(path)


def write_json_log(log: DataFrame, path: str) -> None:
    log.write.mode("overwrite").json(path)


def land_clean_log(clean: DataFrame, path: str, files_hold_few_days: bool = False) -> None:
    """Keep the cleaned log as parquet by date, so that later scans prune days and columns.

    The rebalance hint lets the adaptive planner join small dates' blocks and split
    large dates, so a hot day becomes several files rather than one huge task. It costs
    one shuffle, without which every task would write a file for every date it meets.
    Where the log's files hold a day or a few each, the shuffle is not needed.
    """
    rows = clean if files_hold_few_days else clean.hint("rebalance", "date")
    rows.write.mode("overwrite").partitionBy("date").parquet(path)


def read_clean_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a landed log; ``schema`` is that of the frame given to ``land_clean_log``."""
    return spark.read.schema(schema).parquet(path)


def write_features_csv(features: DataFrame, path: str) -> None:
    features.write.mode("overwrite").csv(path, header=True)


def read_features_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)
