"""From the feature table to model rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbwatch.plans.features import INDEXED, feature_columns


def preparation_pipeline(inputs: Sequence[str], include_indexed: bool = False) -> Pipeline:
    """Index the text columns and assemble the inputs into ``features``.

    Rows with a null in any of these columns are left out. The indexes themselves enter
    the vector only with ``include_indexed``; by default they act as null filters.
    """
    indexers = [
        StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="skip", stringOrderType="frequencyDesc")
        for c in INDEXED
    ]
    columns = [*inputs, *(f"{c}_index" for c in INDEXED if include_indexed)]
    return Pipeline(stages=[*indexers, VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip")])


def prepare(
    features: DataFrame, exclude: Sequence[str] = (), include_indexed: bool = False
) -> tuple[PipelineModel, list[str], DataFrame]:
    """(fitted pipeline, names along the vector, model rows).

    ``features`` is read several times by the fits; give a written table.
    """
    inputs = feature_columns(features, exclude)
    fitted = preparation_pipeline(inputs, include_indexed).fit(features)
    return fitted, list(fitted.stages[-1].getInputCols()), fitted.transform(features)


def index_values(fitted: PipelineModel, rows: DataFrame) -> DataFrame:
    """(column_name, value, idx): the index of each value that occurs in the rows."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"), F.col(f"{c}_index").alias("idx"))
        for c in INDEXED
    ]
    return fitted.transform(rows).select(F.inline(F.array(*pairs))).distinct()


def vector_entries(model_rows: DataFrame) -> DataFrame:
    """(userId, position, value) for every entry of the feature vectors."""
    return model_rows.select("userId", F.posexplode(vector_to_array("features")).alias("position", "value"))
