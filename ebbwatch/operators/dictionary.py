"""Indexes of the values of a column, however many there are: the dictionary is a table, and is joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbwatch.functions.running import running_totals
from ebbwatch.session import write_table


def value_index(rows: DataFrame, column: str) -> DataFrame:
    """(value, n, idx): the values by falling frequency, ties by value, numbered from 0. Null has no index."""
    value = F.col(f"`{column}`")
    counts = rows.where(value.isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    return running_totals(counts, [F.col("n").desc(), F.col("value")], {"number": F.lit(1)}).withColumnRenamed("number", "idx")


def with_index(rows: DataFrame, column: str, dictionary: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """Adds ``<column>_index``, a double as the classifiers take it.

    Rows whose value has no index are left out, or with ``keep_unknown`` get the number behind the last one. How
    the dictionary gets to the rows is left to the planner, by its size.
    """
    pairs = dictionary.select(F.col("value").alias("_value"), F.col("idx").cast("double").alias(f"{column}_index"))
    joined = rows.join(pairs, F.col(f"`{column}`") == F.col("_value"), "left" if keep_unknown else "inner").drop("_value")
    if not keep_unknown:
        return joined
    last = dictionary.agg(F.count("*").cast("double").alias("_next"))
    filled = joined.crossJoin(F.broadcast(last))  # one row
    return filled.withColumn(f"{column}_index", F.coalesce(f"{column}_index", "_next")).drop("_next")


def index_columns(rows: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Rows with an index for each column, and the dictionaries.

    As the fitted preparation does, each column is counted on the rows that the columns before it have kept.
    """
    dictionaries = {}
    for column in columns:
        dictionaries[column] = write_table(value_index(rows, column), f"values-{column}")
        rows = with_index(rows, column, dictionaries[column])
    return rows, dictionaries
