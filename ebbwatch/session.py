"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare_session(spark: SparkSession) -> SparkSession:
    """Settings that the results (time zone) and the speed (code size) depend on; they stay set in the session.

    Dates and months follow the session time zone; every engine must agree on it.

    HotSpot never compiles methods over 8,000 bytes. Cleaning a dozen text columns makes one
    of that size, which would then be interpreted row by row, several times slower. With the
    limit, Spark runs such a stage from smaller methods instead.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Folder that all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session may do without the setting: its driver and its
    executors are one process, so a folder of its own is shared by definition.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        # The executors of local-cluster are processes with folders of their own.
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ebbwatch-", dir="/tmp"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path per call, so that re-runs never see or overwrite older output.

    The paths of an application share one folder, which can go once the application ends.
    """
    return f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete the application's intermediate tables. Frames that were read from them are gone with them."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once, keep it as a parquet table in the shared folder and read that.

    Cuts the lineage like a reliable checkpoint, but stays columnar: later readers
    prune columns and push filters, and a lost executor costs a re-read only.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
