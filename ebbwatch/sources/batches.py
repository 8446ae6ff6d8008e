"""Tables that grow by batches, as parquet by date and batch.

A batch writes only the days that it has rows of. Its rows of a day are a partition of their own, so two batches
may share a day, and a batch that comes again replaces its own rows and nothing else.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NULL_DATE = "__HIVE_DEFAULT_PARTITION__"


def land_batch(rows: DataFrame, path: str, batch: str, files_hold_few_days: bool = False) -> None:
    """Add rows with a ``date``, or replace those that an earlier run of the batch left, of all its days.

    The rebalance hint joins small days and splits large ones into several files; see ``land_clean_log``.
    """
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
        raise ValueError(f"letters, digits, dots, hyphens and underscores make a batch name, not {batch!r}")
    spark = rows.sparkSession
    before = _days(spark, path, batch)
    dealt = rows if files_hold_few_days else rows.hint("rebalance", "date")
    dealt.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "date", "batch"
    ).parquet(path)
    if before:
        # Days that the batch had and has no more: partition folders, at most one a day, and no data.
        now = {_NULL_DATE if d is None else str(d) for (d,) in rows.select("date").distinct().collect()}
        for day in set(before) - now:
            before[day][0].delete(before[day][1], True)


def _days(spark: SparkSession, path: str, batch: str) -> dict[str, tuple]:
    """The folders of a batch by day."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.globStatus(jvm.org.apache.hadoop.fs.Path(root, f"date=*/batch={batch}")) or []
    return {f.getPath().getParent().getName().removeprefix("date="): (files, f.getPath()) for f in found}


def read_batches(spark: SparkSession, path: str, schema: T.StructType, with_batch: bool = False) -> DataFrame:
    """All batches; ``schema`` is that of the frame given to ``land_batch``. Filters on ``date`` prune days."""
    whole = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.StringType())])).parquet(path)
    return whole.select(*[F.col(f"`{c}`") for c in schema.names], *(["batch"] if with_batch else []))


def landed_days(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(date, batch, n): what each batch has landed."""
    return read_batches(spark, path, schema, with_batch=True).groupBy("date", "batch").agg(F.count("*").alias("n"))
