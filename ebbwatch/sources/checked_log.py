"""Logs as they come: lines that cannot be read, and columns other than those declared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.sources.activity_log import RAW_SCHEMA

_BROKEN = "_broken"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, file) for every line of the log's files."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"))


def _cause(parsed: Column, schema: T.StructType) -> Column:
    """Why a line does not fit the schema: the first reason that holds."""
    value = F.try_parse_json("line")
    wrong = [
        F.when(
            parsed[f.name].isNull(),
            F.when(F.try_variant_get(value, f'$["{f.name}"]', "string").isNotNull(), F.lit(f"type of {f.name}")),
        )
        for f in schema.fields
    ]
    return (
        F.when(F.trim("line") == "", "blank").when(value.isNull(), "not JSON")
        .when(~F.schema_of_variant(value).startswith("OBJECT"), "not an object")
        .otherwise(F.coalesce(*wrong, F.lit("other")))
    )


def checked(lines: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """The columns of the schema, and ``cause``, ``line`` and ``file``; in one pass.

    ``cause`` is null for a line that reads as a row of the schema, whose ``line`` is null as well. A line with a value of another
    type is kept whole as a broken one, not as a row with a null. Columns that are not declared are no fault; see ``schema_drift``.
    """
    with_broken = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    parsed = F.from_json("line", with_broken, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    rows = lines.withColumn("row", parsed)
    broken = F.col("row").isNull() | F.col(f"row.{_BROKEN}").isNotNull() | (F.trim("line") == "")
    rows = rows.withColumn("cause", F.when(broken, _cause(F.col("row"), schema)))
    return rows.select(
        *(F.when(F.col("cause").isNull(), F.col("row")[f.name]).alias(f.name) for f in schema.fields),
        "cause", F.when(F.col("cause").isNotNull(), F.col("line")).alias("line"), "file",
    )


def land_checked(lines: DataFrame, path: str, schema: T.StructType = RAW_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """Read the lines once, and write rows and broken lines side by side: (rows of the log, quarantine).

    The quarantine has (cause, line, file), so broken lines can be mended and landed again.
    """
    spark = lines.sparkSession
    rows = checked(lines, schema).withColumn("fits", F.col("cause").isNull())
    rows.write.mode("overwrite").partitionBy("fits").parquet(path)
    landed = spark.read.schema(rows.schema).parquet(path)
    good = landed.where("fits").select(*[F.col(f"`{c}`") for c in schema.names])
    return good, landed.where("NOT fits").select("cause", "line", "file")


def causes(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("cause").agg(F.count("*").alias("n"))


def _kind(found: Column) -> Column:
    """The type of JSON values in the terms of the schema."""
    decimal = F.regexp_extract(found, r"^DECIMAL\(\d+,\s*(\d+)\)$", 1)
    return (
        F.when(found.isin("BIGINT", "STRING", "BOOLEAN", "DOUBLE"), F.lower(found)).when(found == "FLOAT", "double")
        .when(decimal != "", F.when(decimal == "0", "bigint").otherwise("double"))
        .when(found == "VARIANT", "mixed").when(found == "VOID", "null")
        .when(found.startswith("OBJECT"), "object").when(found.startswith("ARRAY"), "array").otherwise(found)
    )


def schema_drift(lines: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """(column_name, declared, found, n, status): the columns that the lines hold against those declared.

    The types come from the values, merged over all lines in one pass; ``n`` counts values that are not null. ``status`` is
    same, changed (another type, or several), new (not declared), missing (in no line) or empty (null only). Whole numbers
    fit a declared double. Lines that are no JSON objects have no columns.
    """
    spark = lines.sparkSession
    parsed = lines.select(F.try_parse_json("line").alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    pairs = spark.sql("SELECT key, value FROM {parsed}, LATERAL variant_explode(v)", parsed=parsed)
    found = pairs.groupBy(F.col("key").alias("column_name")).agg(
        _kind(F.schema_of_variant_agg("value")).alias("found"), F.count_if(~F.is_variant_null("value")).alias("n")
    )
    declared = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "column_name string, declared string")
    fits = (F.col("declared") == F.col("found")) | ((F.col("declared") == "double") & (F.col("found") == "bigint"))
    status = (
        F.when(F.col("declared").isNull(), "new").when(F.col("found").isNull(), "missing")
        .when(F.col("found") == "null", "empty").when(fits, "same").otherwise("changed")
    )
    return declared.join(found, "column_name", "full").select("column_name", "declared", "found", F.coalesce("n", F.lit(0)).alias("n"), status.alias("status"))
