"""Pipeline stages of our own that save and load like the built-in ones."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ColumnRenamer(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Rename one column inside a pipeline."""

    @keyword_only
    def __init__(self, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumnRenamed(self.getInputCol(), self.getOutputCol())


class TextToVector(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """JSON text of numbers to a vector column."""

    @keyword_only
    def __init__(self, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        parsed = F.from_json(F.col(self.getInputCol()), "array<double>")
        return dataset.withColumn(self.getOutputCol(), array_to_vector(parsed))
