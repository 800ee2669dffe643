"""Imputation, encoding and scaling as MLlib stages.

Fitted statistics live in the model's params, so a fitted
``PipelineModel`` saves and loads as one object and scores a new month
without refitting. Every fit is one aggregate pass over the training rows.
"""

from __future__ import annotations

import json

from pyspark import SparkContext, keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _ColsParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric input columns",
                        typeConverter=TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical input columns",
                            typeConverter=TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[])


def fill_statistics(df: DataFrame, numeric: list[str], categorical: list[str],
                    group_cols: list[str] | None = None) -> DataFrame:
    """A5 + A6 in one aggregate: means of numeric columns, modes of
    categorical columns (NULLs skipped, smallest value on ties)."""
    aggs = ([F.avg(c).alias(c) for c in numeric] +
            [F.mode(F.col(c), True).alias(c) for c in categorical])
    if group_cols:
        return df.groupBy(*group_cols).agg(*aggs)
    return df.agg(*aggs)


def _fill(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
        for c, v in values.items() if v is not None and c in df.columns})


class MeanModeImputer(Estimator, _ColsParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fill numeric columns with their mean, categorical with their mode,
    using statistics of the fitting frame."""

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "MeanModeImputerModel":
        num, cat = self.getOrDefault("numericCols"), self.getOrDefault("categoricalCols")
        row = fill_statistics(df, num, cat).first().asDict()
        return MeanModeImputerModel(numericCols=num, categoricalCols=cat,
                                    fillValues=json.dumps(row))


class MeanModeImputerModel(Model, _ColsParams, DefaultParamsReadable, DefaultParamsWritable):
    fillValues = Param(Params._dummy(), "fillValues", "json map column -> fill value",
                       typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, fillValues="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def values(self) -> dict:
        return json.loads(self.getOrDefault("fillValues"))

    def _transform(self, df: DataFrame) -> DataFrame:
        return _fill(df, self.values())


def impute_within_groups(df: DataFrame, numeric: list[str], categorical: list[str],
                         group_col: str) -> DataFrame:
    """E1 with the original's behavior: each group (train / test) is filled
    from its own statistics. The statistics table has one row per group."""
    stats = fill_statistics(df, numeric, categorical, [group_col])
    renamed = stats.select(group_col, *[F.col(c).alias(f"_fill_{c}") for c in numeric + categorical])
    out = df.join(F.broadcast(renamed), group_col, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_fill_{c}"))
                            for c in numeric + categorical}).drop(
        *[f"_fill_{c}" for c in numeric + categorical])


class PopulationScaler(Estimator, _ColsParams, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population std, in place; zero variance gives x - mean."""

    @keyword_only
    def __init__(self, *, numericCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        cols = self.getOrDefault("numericCols")
        row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
        means = [row[f"m_{i}"] for i in range(len(cols))]
        stds = [row[f"s_{i}"] for i in range(len(cols))]
        return PopulationScalerModel(numericCols=cols, stats=json.dumps({"mean": means, "std": stds}))


class PopulationScalerModel(Model, _ColsParams, DefaultParamsReadable, DefaultParamsWritable):
    stats = Param(Params._dummy(), "stats", "json with mean and std lists",
                  typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, stats="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        st = json.loads(self.getOrDefault("stats"))
        out = {}
        for c, m, s in zip(self.getOrDefault("numericCols"), st["mean"], st["std"]):
            scale = s if (s is not None and s > 0) else 1.0
            out[c] = (F.col(c) - F.lit(m if m is not None else 0.0)) / F.lit(scale)
        return df.withColumns(out)


def indexer(cols: list[str], suffix: str = "_code") -> StringIndexer:
    """E5: category codes in sorted category order; unseen values get the
    extra code N (``keep``). Output columns carry nominal metadata, which
    tree learners read as categorical features."""
    return StringIndexer(inputCols=cols, outputCols=[c + suffix for c in cols],
                         stringOrderType="alphabetAsc", handleInvalid="keep")


def label_counts(model: StringIndexerModel) -> list[int]:
    """Number of labels of every column, which stay in the JVM."""
    return [len(x) for x in model._java_obj.labelsArray()]


def without_first(model: StringIndexerModel) -> StringIndexerModel:
    """The indexer without the smallest category of each column, so that its rows get the
    code of unseen values, which the encoder drops. (Cutting the slot off the vectors costs
    a step per category and row.) The only category of a column stays. Labels stay in the JVM."""
    sc = SparkContext._active_spark_context
    labels = model._java_obj.labelsArray()
    kept = sc._gateway.new_array(sc._jvm.java.lang.String, len(labels), 0)
    for i, own in enumerate(labels):
        n, first = len(own), int(len(own) > 1)
        rest = sc._gateway.new_array(sc._jvm.java.lang.String, n - first)
        sc._jvm.java.lang.System.arraycopy(own, first, rest, 0, n - first)
        kept[i] = rest
    out = StringIndexerModel(sc._jvm.org.apache.spark.ml.feature.StringIndexerModel(model.uid, kept))
    return out._set(inputCols=model.getInputCols(), outputCols=model.getOutputCols(), handleInvalid=model.getHandleInvalid())


class OneHot(Estimator, _ColsParams, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot over sorted categories, unseen values all zeros.

    ``dropFirst`` removes the slot of the smallest category (for unpenalized
    linear models): see :func:`without_first`. Output: ``{col}_ohe`` sparse vectors."""

    dropFirst = Param(Params._dummy(), "dropFirst", "drop the first category slot",
                      typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, categoricalCols=None, dropFirst=False):
        super().__init__()
        self._setDefault(dropFirst=False)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PipelineModel:
        cols = self.getOrDefault("categoricalCols")
        idx_model = indexer(cols, "_idx").fit(df)
        if self.getOrDefault("dropFirst"):
            idx_model = without_first(idx_model)
        indexed = idx_model.transform(df.limit(0))
        ohe = OneHotEncoder(inputCols=[c + "_idx" for c in cols],
                            outputCols=[c + "_ohe" for c in cols], dropLast=True)
        return PipelineModel([idx_model, ohe.fit(indexed)])


def category_sizes(model: PipelineModel) -> list[int]:
    """Number of fitted categories per column of a fitted :class:`OneHot` (without ``dropFirst``)."""
    return label_counts(model.stages[0])
