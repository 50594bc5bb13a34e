"""Feature preparation as ML Estimators and Models.

Each Estimator has readable and writable params and fits a Model whose state
is a small table; Models are saved as their metadata plus that table, so a
``Pipeline`` of them (and of Spark's own stages) can be fitted, saved to the
shared folder and loaded elsewhere.  Fitted categories stay a table: they are
joined, never held on the driver.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.ml.param.shared import (
    HasInputCol,
    HasInputCols,
    HasLabelCol,
    HasOutputCol,
    Param,
    Params,
    TypeConverters,
)
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

from sparkwright.operators.attribute_ratio import attribute_ratio, select_features
from sparkwright.operators.features import frequency_index, standardize
from sparkwright.session import materialize

# ------------------------------------------------- saving fitted tables


class _Writer(MLWriter):
    def __init__(self, instance: TableModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.parquet(f"{path}/table")
        for name, part in self.instance.parts().items():
            part.write().save(f"{path}/{name}")


class _Reader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        found = self.cls()
        found._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(found, metadata)
        found.table = self.sparkSession.read.parquet(f"{path}/table")
        found.load_parts(path)
        return found


class TableModel(Model, MLReadable, MLWritable):
    """A Model whose fitted state is the DataFrame ``table`` (and, for some,
    further fitted stages)."""

    table: DataFrame | None = None

    def parts(self) -> dict:
        return {}

    def load_parts(self, path: str) -> None:
        pass

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


def _fitted(model: TableModel, estimator: Estimator, table: DataFrame) -> TableModel:
    """A model with the estimator's params and its table, cut from its lineage."""
    model.table = materialize(table)
    return estimator._copyValues(model.setParent(estimator) if hasattr(model, "setParent") else model)


# ------------------------------------------------- H2: frequency index


class _IndexParams(HasInputCol, HasOutputCol):
    unseen = Param(Params._dummy(), "unseen", "'null', 'keep' (the number of values) or 'error'",
                   TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(unseen="null")


class FrequencyIndexer(Estimator, _IndexParams, DefaultParamsReadable, DefaultParamsWritable):
    """Index the values of a column: 0.0 for the most frequent, ties by value."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, unseen="null"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> FrequencyIndexerModel:
        index = frequency_index(df.select(self.getInputCol()), self.getInputCol())
        return _fitted(FrequencyIndexerModel(), self, index.select(F.col(self.getInputCol()).alias("value"), "index"))


class FrequencyIndexerModel(TableModel, _IndexParams):
    """``table``: (value, index)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        name, out, policy = self.getInputCol(), self.getOutputCol(), self.getOrDefault(self.unseen)
        index = self.table.select(F.col("value").alias("_value"), F.col("index").alias("_index"))
        found = df.drop(out).join(index, F.col(name) == F.col("_value"), "left")
        got, known = F.col("_index"), F.col(name).isNull() | F.col("_index").isNotNull()
        if policy == "keep":
            got = F.coalesce(got, F.lit(float(self.table.count())))
        elif policy == "error":
            got = F.when(known, got).otherwise(F.raise_error(F.concat(F.lit("unseen value: "), F.col(name).cast("string"))))
        elif policy != "null":
            raise ValueError(f"unseen must be 'null', 'keep' or 'error', not {policy!r}")
        return found.withColumn(out, got).drop("_value", "_index")


# ----------------------------------------------------- H3: one-hot


class OneHotByFrequency(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot encode a column of any type to a sparse vector with a slot per
    fitted value, in the order of ``FrequencyIndexer``; unseen values and nulls
    give no slot.  Columns with many values stay narrow."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> OneHotByFrequencyModel:
        indexer = FrequencyIndexer(inputCol=self.getInputCol(), outputCol="index").fit(df)
        if not indexer.table.head(1):
            raise ValueError(f"column {self.getInputCol()} has no value to encode")
        model = _fitted(OneHotByFrequencyModel(), self, indexer.table)
        # An invalid index is a last category, and the last one is dropped: all zeros.
        model.encoder = OneHotEncoder(inputCol="index", outputCol="slots", handleInvalid="keep", dropLast=True).fit(
            model.table)
        return model


class OneHotByFrequencyModel(TableModel, HasInputCol, HasOutputCol):
    """``table``: (value, index); ``encoder``: Spark's encoder over the index."""

    encoder: OneHotEncoderModel | None = None

    def parts(self) -> dict:
        return {"encoder": self.encoder}

    def load_parts(self, path: str) -> None:
        self.encoder = OneHotEncoderModel.load(f"{path}/encoder")

    def _transform(self, df: DataFrame) -> DataFrame:
        name, out = self.getInputCol(), self.getOutputCol()
        index = self.table.select(F.col("value").alias("_value"), F.col("index").alias("_slot"))
        found = df.drop(out).join(index, F.col(name) == F.col("_value"), "left").drop("_value")
        size = float(self.encoder.categorySizes[0])
        found = found.withColumn("_slot", F.coalesce("_slot", F.lit(size)))
        return self.encoder.copy({self.encoder.inputCol: "_slot", self.encoder.outputCol: out}).transform(found).drop("_slot")


# ---------------------------------------------------- H4: standardise


class _ScaleParams(HasInputCols):
    withMean = Param(Params._dummy(), "withMean", "subtract the mean", TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(withMean=True)


class Standardizer(Estimator, _ScaleParams, DefaultParamsReadable, DefaultParamsWritable):
    """Replace columns by (x - mean) / sample stddev; no spread gives 0.0."""

    @keyword_only
    def __init__(self, inputCols=None, withMean=True):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> StandardizerModel:
        cells = [F.struct(F.lit(c).alias("column"), F.avg(c).cast("double").alias("mean"),
                          F.stddev_samp(c).cast("double").alias("std")) for c in self.getInputCols()]
        return _fitted(StandardizerModel(), self, df.agg(F.array(*cells).alias("all")).select(F.inline("all")))


class StandardizerModel(TableModel, _ScaleParams):
    """``table``: (column, mean, std), a row per column."""

    def _transform(self, df: DataFrame) -> DataFrame:
        stats = {}
        for r in self.table.collect():
            stats[f"{r['column']}__avg"], stats[f"{r['column']}__std"] = r["mean"], r["std"]
        return standardize(df, stats, self.getInputCols(), with_mean=self.getOrDefault(self.withMean))


# -------------------------------------------- A16: attribute ratio


class _RatioParams(HasLabelCol, HasOutputCol):
    numericCols = Param(Params._dummy(), "numericCols", "numeric features", TypeConverters.toListString)
    binaryCols = Param(Params._dummy(), "binaryCols", "0/1 features", TypeConverters.toListString)
    minRatio = Param(Params._dummy(), "minRatio", "least attribute ratio", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(numericCols=[], binaryCols=[], minRatio=0.01)


class RatioSelector(Estimator, _RatioParams, DefaultParamsReadable, DefaultParamsWritable):
    """Assemble the features whose attribute ratio over the label's classes is
    at least ``minRatio`` into a vector, in the order of the params."""

    @keyword_only
    def __init__(self, numericCols=None, binaryCols=None, labelCol=None, outputCol=None, minRatio=0.01):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> RatioSelectorModel:
        ratios = attribute_ratio(df, self.getOrDefault(self.numericCols), self.getOrDefault(self.binaryCols),
                                 self.getLabelCol())
        return _fitted(RatioSelectorModel(), self, ratios)


class RatioSelectorModel(TableModel, _RatioParams):
    """``table``: (feature, kind, position, ratio) of all features, so that
    ``minRatio`` may be set anew after the fit."""

    def selected(self) -> list[str]:
        """Names of the selected features (as many as the schema has at most)."""
        kept = {r["feature"] for r in select_features(self.table, self.getOrDefault(self.minRatio)).collect()}
        return [c for c in [*self.getOrDefault(self.numericCols), *self.getOrDefault(self.binaryCols)] if c in kept]

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.selected()
        if not names:
            raise ValueError("no feature reaches minRatio")
        return VectorAssembler(inputCols=names, outputCol=self.getOutputCol(), handleInvalid="error").transform(df)
