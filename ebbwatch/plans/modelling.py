"""From the raw log to train, validation and test rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ebbwatch.ml.prepare import prepare
from ebbwatch.operators.sampling import data_split
from ebbwatch.session import write_table


@dataclass
class ModelData:
    features: DataFrame
    fitted: PipelineModel
    names: list[str]
    rows: DataFrame

    def part(self, split: str) -> DataFrame:
        return self.rows.where(self.rows.split == split)

    @property
    def train(self) -> DataFrame:
        return self.part("train")

    @property
    def validation(self) -> DataFrame:
        return self.part("validation")

    @property
    def test(self) -> DataFrame:
        return self.part("test")


def model_data(features: DataFrame, exclude: Sequence[str] = (), include_indexed: bool = False) -> ModelData:
    """Write the features once, fit the preparation and assign the splits.

    All iterative work that follows (index counts, tree levels, folds) reads the
    written user-grain table and never goes back to the log.
    """
    table = write_table(features, "features")
    fitted, names, rows = prepare(table, exclude, include_indexed)
    return ModelData(table, fitted, names, data_split(rows))
