"""Distributed histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(values: DataFrame, by: str, value: str, bins: int = 10) -> DataFrame:
    """(by, bin, lo, hi, n): equal-width bins from each group's minimum to its maximum.

    ``by`` is a feature name or a class label, so there are few groups. Bins are closed
    on the left, the last one on both sides; empty bins are listed with n = 0. A group
    of equal values gets a range of width one around its value. Nulls and NaN are left out.
    Values are reduced to (by, bin) counts before any shuffle.
    """
    numbers = values.select(by, F.col(value).cast("double").alias("x")).where("x is not null and not isnan(x)")
    same = F.col("x_min") == F.col("x_max")
    ranges = (
        numbers.groupBy(by).agg(F.min("x").alias("x_min"), F.max("x").alias("x_max"))
        .select(
            by,
            F.when(same, F.col("x_min") - 0.5).otherwise(F.col("x_min")).alias("start"),
            F.when(same, F.col("x_max") + 0.5).otherwise(F.col("x_max")).alias("stop"),
        )
    )
    position = F.floor((F.col("x") - F.col("start")) / (F.col("stop") - F.col("start")) * bins)
    counts = (
        numbers.join(ranges, by)
        .select(by, F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy(by, "bin").agg(F.count("*").alias("n"))
    )
    width = (F.col("stop") - F.col("start")) / bins
    edges = (
        ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .select(
            by, "bin", (F.col("start") + width * F.col("bin")).alias("lo"),
            (F.col("start") + width * (F.col("bin") + 1)).alias("hi"),
        )
    )
    return edges.join(counts, [by, "bin"], "left").fillna(0, ["n"])


def feature_histograms(features: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Histograms of the given numeric columns, keyed by feature name."""
    pairs = [
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns
    ]
    return histogram(features.select(F.inline(F.array(*pairs))), "feature", "value", bins)
