"""Category indexes as a stage of a saved pipeline, for any number of categories."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.operators.features import category_index
from kerbline.plans.durable import durable
from kerbline.plans.limits import limit, table_bytes


class _Columns(HasInputCols, HasOutputCols):
    """Names of the category columns and of their indexes."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)


class CategoryIndex(_Columns, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns an index of each column's categories: most frequent first, ties in alphabetical order."""

    def _fit(self, df: DataFrame) -> CategoryIndexModel:
        def one(name: str) -> DataFrame:
            found = category_index(df.select(F.col(f"`{name}`").cast("string").alias("value")), "value")
            return found.select(F.lit(name).alias("column"), "value", F.col("value_idx").alias("index"))

        names = self.getInputCols()
        table = durable(reduce(DataFrame.unionByName, [one(name) for name in names]))
        found = {row["column"]: row["count"] for row in table.groupBy("column").count().collect()}
        model = CategoryIndexModel(inputCols=names, outputCols=self.getOutputCols())
        return model.holding(table, [found.get(name, 0) for name in names])


class CategoryIndexModel(_Columns, Model, MLReadable, MLWritable):
    """Adds the indexes by joining a table of categories; null and unseen ones share the index after the last.

    The table (column, value, index) is Parquet: in the shared folder after training, in the model's own
    folder once saved. Up to the broadcast limit it is sent whole, beyond that rows are joined by shuffle.
    """

    sizes = Param(Params._dummy(), "sizes", "categories of each column", TypeConverters.toListInt)

    table: DataFrame
    _bytes: int | None = None

    def holding(self, table: DataFrame, sizes: Sequence[int] | None = None) -> CategoryIndexModel:
        self.table = table
        return self if sizes is None else self._set(sizes=list(sizes))

    def _transform(self, df: DataFrame) -> DataFrame:
        if self._bytes is None:
            self._bytes = table_bytes(self.table)
        key = f"{self.uid}_value"
        for name, out, size in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault("sizes"), strict=True):
            lookup = self.table.filter(F.col("column") == name).select(F.col("value").alias(key), F.col("index").alias(out))
            if self._bytes <= limit(df.sparkSession, "broadcastBytes"):
                lookup = F.broadcast(lookup)
            marked = df.withColumn(key, F.col(f"`{name}`").cast("string"))
            index = F.coalesce(F.col(f"`{out}`"), F.lit(float(size)))
            df = marked.join(lookup, key, "left").withColumn(out, index).drop(key)
        return df

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: CategoryIndexModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.table.write.parquet(f"{path}/index")


class _Reader(MLReader):
    def load(self, path: str) -> CategoryIndexModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = CategoryIndexModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model.holding(self.sparkSession.read.parquet(f"{path}/index"))
