"""Repeatable splits and samples.

Membership is a function of the key, so it is the same for any partitioning, file
layout, retry or engine, and all rows of one user fall on the same side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbwatch.functions.columns import hash_uniform

# The share held out at each of the two steps, and the sampling fractions per label.
HOLD_OUT = 0.2
LABEL_FRACTIONS = {0: 1 / 3.5, 1: 1.0}
SEED = 42


def data_split(df: DataFrame, key: str = "userId", hold_out: float = HOLD_OUT, seed: int = SEED) -> DataFrame:
    """Add ``split``: the test share first, then the validation share of the rest."""
    first, second = hash_uniform(F.col(key), seed), hash_uniform(F.col(key), seed + 1)
    return df.withColumn(
        "split",
        F.when(first >= 1 - hold_out, "test").when(second >= 1 - hold_out, "validation").otherwise("train"),
    )


def add_fold(df: DataFrame, folds: int, key: str = "userId", seed: int = SEED) -> DataFrame:
    """Add ``fold``: 0 .. folds - 1."""
    return df.withColumn("fold", F.floor(hash_uniform(F.col(key), seed + 2) * folds).cast("int"))


def stratified_sample(
    df: DataFrame, fractions: Mapping[int, float] = LABEL_FRACTIONS, key: str = "userId", seed: int = SEED
) -> DataFrame:
    """Keep each row with the probability of its label; labels not named are left out."""
    fraction = F.lit(0.0)
    for label, share in fractions.items():
        fraction = F.when(F.col("label") == label, share).otherwise(fraction)
    return df.where(hash_uniform(F.col(key), seed + 3) < fraction)


def class_balance(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count("*").alias("n"))
