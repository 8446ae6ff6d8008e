"""Page features as sparse vectors, for any number of pages: pages are positions, not columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.functions.running import running_totals
from ebbwatch.plans.features import feature_columns
from ebbwatch.session import scratch_path, write_table


def page_positions(means: DataFrame) -> DataFrame:
    """(grain, page, position): a number for each feature that some user has, by grain and page."""
    names = means.select("grain", "page").distinct()
    return running_totals(names, [F.col("grain"), F.col("page")], {"number": F.lit(1)}).withColumnRenamed("number", "position")


def page_vectors(means: DataFrame, users: DataFrame, positions: DataFrame) -> DataFrame:
    """(userId, pages): a sparse vector for each user of ``users``; all zero if the user has no page means.

    ``means`` has the rows of ``page_means_long``. A vector is as long as its user has pages. The vectors are written in
    their storage form and read as vectors, so no row passes through Python.
    """
    size = positions.count()
    entries = means.join(positions, ["grain", "page"]).groupBy("userId").agg(
        F.array_sort(F.collect_list(F.struct(F.col("position").cast("int").alias("i"), F.col("mean").alias("x")))).alias("entries")
    )
    none = F.expr("cast(array() as array<struct<i: int, x: double>>)")
    entries = users.select("userId").distinct().join(entries, "userId", "left").withColumn("entries", F.coalesce("entries", none))
    stored = entries.select(
        "userId",
        F.struct(
            F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
            F.col("entries.i").alias("indices"), F.col("entries.x").alias("values"),
        ).alias("pages"),
    )
    path, spark = scratch_path(users.sparkSession, "page-vectors"), users.sparkSession
    stored.write.parquet(path)
    return spark.read.schema(T.StructType([stored.schema["userId"], T.StructField("pages", VectorUDT())])).parquet(path)


def page_entries(vectors: DataFrame, positions: DataFrame) -> DataFrame:
    """(userId, position, feature, value) for the entries that are not zero."""
    stored = F.unwrap_udt("pages")
    pairs = vectors.select("userId", F.inline(F.arrays_zip(stored["indices"].alias("position"), stored["values"].alias("value"))))
    names = positions.select("position", F.concat(F.lit("avg_"), "grain", F.lit("_"), "page").alias("feature"))
    return pairs.join(names, "position").select("userId", F.col("position").cast("long").alias("position"), "feature", "value")


def assembled(features: DataFrame, vectors: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], DataFrame]:
    """(names of the dense inputs, rows with ``features``): dense inputs in front, pages behind them."""
    inputs = feature_columns(features, exclude)
    rows = write_table(features, "dense-features").join(vectors, "userId")
    return inputs, VectorAssembler(inputCols=[*inputs, "pages"], outputCol="features", handleInvalid="skip").transform(rows)
