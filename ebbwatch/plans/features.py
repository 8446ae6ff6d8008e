"""The user feature table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.operators.label import CANCEL_PAGES
from ebbwatch.plans.cubes import activity_cube, features_from_cube
from ebbwatch.session import write_table

# The text columns that are indexed for the models.
INDEXED = ("gender", "location", "valid_level")


def user_features(
    clean: DataFrame,
    pages: Sequence[str] | None = None,
    cancel_pages: Sequence[str] = CANCEL_PAGES,
    month_grain: str = "month",
    with_avg_length: bool = False,
) -> DataFrame:
    """One wide row per user: account attributes, label and behavioural means.

    The log is scanned once, into an activity cube; accounts, sessions and pages, and the names of the pages, all
    come from the written cube.
    """
    cube = write_table(activity_cube(clean, cancel_pages), "cube")
    return features_from_cube(cube, pages, month_grain, with_avg_length)


def feature_columns(features: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Model inputs in schema order: every non-string column but the key and the label."""
    left_out = {"userId", "label", *exclude}
    return [
        f.name for f in features.schema.fields
        if not isinstance(f.dataType, T.StringType) and f.name not in left_out
    ]


def _complete(features: DataFrame, exclude: Sequence[str] = ()) -> Column:
    present = [F.col(f"`{c}`").isNotNull() for c in (*INDEXED, *feature_columns(features, exclude))]
    return reduce(Column.__and__, present)


def complete_rows(features: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """The rows that have all a model needs: the same rows that the preparation pipeline
    keeps, without fitting it."""
    return features.where(_complete(features, exclude))


def user_counts(features: DataFrame) -> DataFrame:
    """Feature rows, and how many of them are complete."""
    return features.agg(F.count("*").alias("n_feature_rows"), F.count_if(_complete(features)).alias("n_model_rows"))


def feature_report(features: DataFrame) -> DataFrame:
    """(position, feature, data_type, n_present): the model inputs and how many rows have them."""
    names = feature_columns(features)
    types = {f.name: f.dataType.simpleString() for f in features.schema.fields}
    present = features.agg(*[F.count(name).alias(name) for name in names])
    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("feature"),
            F.lit(types[name]).alias("data_type"), F.col(f"`{name}`").alias("n_present"),
        )
        for i, name in enumerate(names)
    ]
    return present.select(F.inline(F.array(*rows)))
