"""Which columns of a table are null together.

Every row is reduced to a bitmask of its null columns, and rows are counted by mask, in one pass with one
hash aggregate. All else is derived from the patterns, of which a table has few.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 62  # columns in one mask


def _masks(columns: Sequence[str]) -> dict[str, Column]:
    """Bitmasks of the null columns, as many as the columns need."""
    masks = {}
    for first in range(0, len(columns), WORD):
        bits = [F.when(F.col(f"`{c}`").isNull(), 1 << i).otherwise(0).cast("long") for i, c in enumerate(columns[first : first + WORD])]
        masks[f"mask{first // WORD}"] = reduce(Column.bitwiseOR, bits)
    return masks


def _listed(columns: Sequence[str]) -> Column:
    """Names of the columns that the masks mark, in the order of the columns."""
    marked = [
        F.when(F.col(f"mask{i // WORD}").bitwiseAND(F.lit(1 << i % WORD)) != 0, F.lit(c)) for i, c in enumerate(columns)
    ]
    return F.array_compact(F.array(*marked))


def null_patterns(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(columns, n_columns, n): each combination of columns that are null together, and its number of rows.

    ``columns`` is a list of names; that of rows without nulls is empty. A table without rows has no patterns.
    """
    columns = list(rows.columns if columns is None else columns)
    masks = _masks(columns)
    counts = rows.select(*(m.alias(name) for name, m in masks.items())).groupBy(*masks).agg(F.count("*").alias("n"))
    return counts.select(_listed(columns).alias("columns"), "n").select("columns", F.size("columns").alias("n_columns"), "n")


def null_pattern_report(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(pattern, n_columns, n): the patterns with the names as one text."""
    return null_patterns(rows, columns).select(F.array_join("columns", ",").alias("pattern"), "n_columns", "n")


def null_implications(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(if_null, then_null, n_if, n_both, share, always, together) for pairs of columns that are null together in some row.

    ``always``: where the first is null, so is the second. ``together``: the same holds the other way round, so
    the two are null in the same rows. Pairs are made from the patterns, not from the rows.
    """
    marked = null_patterns(rows, columns).where("n_columns > 0")
    alone = marked.select(F.explode("columns").alias("name"), "n").groupBy("name").agg(F.sum("n").alias("n_alone"))
    pairs = marked.select("columns", "n", F.explode("columns").alias("if_null")).select("n", "if_null", F.explode("columns").alias("then_null"))
    both = pairs.where("if_null != then_null").groupBy("if_null", "then_null").agg(F.sum("n").alias("n_both"))
    first = alone.select(F.col("name").alias("if_null"), F.col("n_alone").alias("n_if"))
    second = alone.select(F.col("name").alias("then_null"), F.col("n_alone").alias("n_then"))
    return both.join(first, "if_null").join(second, "then_null").select(
        "if_null", "then_null", "n_if", "n_both", (F.col("n_both") / F.col("n_if")).alias("share"),
        (F.col("n_both") == F.col("n_if")).alias("always"),
        ((F.col("n_both") == F.col("n_if")) & (F.col("n_both") == F.col("n_then"))).alias("together"),
    )


def null_groups(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(columns, n): the sets of columns that are null in exactly the same rows, and in how many; at least two columns each."""
    marked = null_patterns(rows, columns).where("n_columns > 0")
    # A column is known by the patterns it is in; columns in the same patterns are null in the same rows.
    by_column = marked.select(F.explode("columns").alias("name"), "columns", "n").groupBy("name").agg(
        F.array_sort(F.collect_set("columns")).alias("patterns"), F.sum("n").alias("n")
    )
    groups = by_column.groupBy("patterns", "n").agg(F.array_sort(F.collect_list("name")).alias("names"))
    return groups.where(F.size("names") > 1).select(F.array_join("names", ",").alias("columns"), "n")
