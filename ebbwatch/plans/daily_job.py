"""The job that takes in one batch of the log, and keeps the features up to date.

    spark-submit --py-files ebbwatch.zip ebbwatch/plans/daily_job.py LINES_PATH STORE_PATH BATCH

LINES_PATH holds the JSON lines of the batch, a day's as a rule. The store has the cleaned log, the activity cubes
and the quarantine of broken lines, all by batch. Only the batch's lines are read; the features of all users come from the
cubes. A batch that is run again replaces what its first run left.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.operators.clean import clean_activity
from ebbwatch.operators.label import CANCEL_PAGES
from ebbwatch.operators.sketches import user_sketches
from ebbwatch.plans.cubes import add_to_cubes, features_from_cube
from ebbwatch.session import prepare_session, remove_scratch, scratch_path
from ebbwatch.sources.batches import land_batch, read_batches
from ebbwatch.sources.checked_log import land_checked, read_lines, schema_drift


class Intake(NamedTuple):
    log: DataFrame  # the cleaned log of all batches
    features: DataFrame  # of all users
    broken: DataFrame  # (batch, cause, n) of all batches
    drift: DataFrame  # of this batch
    sketches: DataFrame  # (date, sketch) of all batches


def take_in(
    spark: SparkSession, lines_path: str, store: str, batch: str, pages: Sequence[str] | None = None, cancel_pages: Sequence[str] = CANCEL_PAGES
) -> Intake:
    """Add a batch to the store, and give the tables as they then are."""
    prepare_session(spark)
    lines = read_lines(spark, lines_path)
    rows, broken = land_checked(lines, scratch_path(spark, "batch"))
    clean = clean_activity(rows)
    land_batch(clean, f"{store}/log", batch)
    cubes = add_to_cubes(clean, f"{store}/cubes", batch, cancel_pages)
    sketches = user_sketches(clean)
    land_batch(sketches, f"{store}/sketches", batch)
    # One partition of broken lines for each batch, whatever their dates may be.
    kept = broken.withColumn("date", F.lit(None).cast("date"))
    land_batch(kept, f"{store}/quarantine", batch)
    bad = read_batches(spark, f"{store}/quarantine", kept.schema, with_batch=True)
    return Intake(
        read_batches(spark, f"{store}/log", clean.schema), features_from_cube(cubes, pages),
        bad.groupBy("batch", "cause").agg(F.count("*").alias("n")), schema_drift(lines),
        read_batches(spark, f"{store}/sketches", sketches.schema),
    )


def main(arguments: Sequence[str]) -> int:
    if len(arguments) != 3:
        print(__doc__)
        return 2
    spark = SparkSession.builder.appName("ebbwatch-daily").getOrCreate()
    try:
        found = take_in(spark, *arguments)
        found.features.write.mode("overwrite").parquet(f"{arguments[1]}/features")
        for table in (found.broken, found.drift):
            table.show(100, truncate=False)
    finally:
        remove_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
