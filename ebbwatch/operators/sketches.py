"""Approximate numbers of distinct users from sketches that can be stored by day and merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_SIZE = 14  # a sketch has up to 2 ** LG_SIZE counters; the standard error is about 1.04 / 2 ** (LG_SIZE / 2), 0.8 %
ERROR = 0.03  # more than three standard errors


def user_sketches(rows: DataFrame, user: str = "userId", by: str = "date") -> DataFrame:
    """(by, sketch): one sketch of the users of each day; null users do not count."""
    return rows.groupBy(by).agg(F.hll_sketch_agg(user, F.lit(LG_SIZE)).alias("sketch"))


def estimated_users(sketches: DataFrame, by: str | None = None) -> DataFrame:
    """(by, n_users): the estimate of each group of sketches, or of all together."""
    merged = sketches.groupBy(*[by] if by else []).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*[by] if by else [], F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("n_users"))
