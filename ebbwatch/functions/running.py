"""Running totals in a global order, without a window over all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbwatch.session import write_table


def running_totals(rows: DataFrame, order: Sequence[Column], totals: Mapping[str, Column]) -> DataFrame:
    """Adds each total over the rows before this one in the order; a total of ones numbers the rows from 0.

    Rows are dealt by ranges of the order and written with the number of their range; the totals of the ranges, one
    row each, give every range what comes before it, and windows run within ranges only. Rows that are equal
    in the order lie in one range, so they should have been grouped.
    """
    values = {f"_{name}": value.cast("decimal(38,0)") if name == "number" else value for name, value in totals.items()}
    placed = write_table(
        rows.withColumns(values).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_range").agg(*(F.sum(v).alias(f"_sum{v}") for v in values))
    firsts = sums.select("_range", *(F.coalesce(F.sum(f"_sum{v}").over(earlier), F.lit(0)).alias(f"_first{v}") for v in values))
    local = placed.withColumns({f"_in{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values}).join(firsts, "_range")
    kind = {name: "long" if name == "number" else placed.schema[f"_{name}"].dataType.simpleString() for name in totals}
    kept = [F.col(f"`{c}`") for c in rows.columns]
    return local.select(*kept, *((F.col(f"_in_{n}") + F.col(f"_first_{n}")).cast(kind[n]).alias(n) for n in totals))
