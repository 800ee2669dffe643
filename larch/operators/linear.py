"""Penalised linear models as pipeline stages and as columns.

Fits come from :mod:`larch.operators.penalized`. The weights of the wide categorical
column are a Parquet table in the shared folder (value, a coefficient per penalty),
which a saved model names; the other weights are parameters of the stage. Scoring
joins the table by value: Spark broadcasts or shuffles it by its real size, and AQE
splits a value that many rows have.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larch.operators import penalized
from larch.session import unique_path


def _narrow_term(w: list[float], numeric: list[str], slots: list) -> Column:
    """Numeric weights as literals; a value of another column adds its weight."""
    out = F.lit(0.0)
    for x, c in zip(w, numeric):
        out = out + F.lit(float(x)) * F.col(f"`{c}`")
    for x, (c, v) in zip(w[len(numeric):], slots):
        if x:
            out = out + F.when(F.col(f"`{c}`").cast("string") == v, F.lit(float(x))).otherwise(0.0)
    return out


def _with_wide(df: DataFrame, wide: str | None, table: DataFrame | None) -> DataFrame:
    """``df`` with _w, the coefficients of its value (null: none)."""
    if wide is None or table is None:
        return df.withColumn("_w", F.lit(None).cast("array<double>"))
    t = table.select(F.col("value").alias("_value"), F.col("coefficients").alias("_w"))
    return df.join(t, F.col(f"`{wide}`").cast("string") == F.col("_value"), "left").drop("_value")


def predictions(df: DataFrame, fits: penalized.Fits, prefix: str = "pred_") -> DataFrame:
    """Predictions of all penalties as columns ``pred_0 ..`` in one projection."""
    d = fits.design
    out = _with_wide(df, d.wide, fits.wide)
    cols = {f"{prefix}{j}": F.lit(float(b)) + _narrow_term(w.tolist(), d.numeric, d.slots) + F.coalesce(F.col("_w")[j], F.lit(0.0))
            for j, (b, w) in enumerate(zip(fits.intercepts, fits.narrow))}
    return out.withColumns(cols).drop("_w")


def prediction_rows(df: DataFrame, fits: penalized.Fits, keep: list) -> DataFrame:
    """``keep`` columns, fit, prediction, coefficients: a row per row of ``df`` and penalty."""
    d, k = fits.design, len(fits.intercepts)

    def each(x) -> Column:
        return F.array(*[F.lit(float(v)) for v in x])

    parts = [(F.lit(1.0), each(fits.intercepts))] + [(F.col(f"`{c}`"), each(fits.narrow[:, i])) for i, c in enumerate(d.numeric)]
    parts += [(F.when(F.col(f"`{c}`").cast("string") == v, 1.0).otherwise(0.0), each(fits.narrow[:, len(d.numeric) + i]))
              for i, (c, v) in enumerate(d.slots)]

    def prediction(j: Column) -> Column:
        out = F.coalesce(F.col("_w")[j], F.lit(0.0))
        for x, w in parts:
            out = out + x * w[j]
        return out

    scored = _with_wide(df, d.wide, fits.wide)
    found = scored.select(*keep, F.transform(F.sequence(F.lit(0), F.lit(k - 1)), prediction).alias("_all"))
    kept = [c for c in found.columns if c != "_all"]
    return found.select(*kept, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fit"), "_all").select(*kept, "fit", F.col("_all")[F.col("fit")].alias("prediction"))


def saved_table(fits: penalized.Fits, spark) -> str:
    """Where the weights of the wide column were written ("" without one)."""
    if fits.wide is None:
        return ""
    path = unique_path(spark, "weights")
    fits.wide.write.parquet(path)
    return path


class _LinearParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric columns", typeConverter=TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical columns", typeConverter=TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", typeConverter=TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[], labelCol="label", predictionCol="prediction")


class PenalizedRegression(Estimator, _LinearParams, DefaultParamsReadable, DefaultParamsWritable):
    """Over [numeric, one-hot], with an intercept. ``l1Ratio`` < 0 is ridge,
    ``||y - b - Xw||^2 + alpha ||w||^2``; else the elastic net of that ratio."""

    alpha = Param(Params._dummy(), "alpha", "penalty", typeConverter=TypeConverters.toFloat)
    l1Ratio = Param(Params._dummy(), "l1Ratio", "share of the L1 penalty; negative: ridge", typeConverter=TypeConverters.toFloat)
    dropFirst = Param(Params._dummy(), "dropFirst", "drop the first category of each column", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, labelCol="label", predictionCol="prediction",
                 alpha=1.0, l1Ratio=-1.0, dropFirst=False):
        super().__init__()
        self._setDefault(alpha=1.0, l1Ratio=-1.0, dropFirst=False)
        self._set(**self._input_kwargs)

    def design(self, df: DataFrame) -> penalized.Design:
        return penalized.design(df, self.getOrDefault("numericCols"), self.getOrDefault("categoricalCols"),
                                self.getOrDefault("labelCol"), self.getOrDefault("dropFirst"))

    def _fit(self, df: DataFrame) -> LinearPredictorModel:
        d = self.design(df)
        a, r = self.getOrDefault("alpha"), self.getOrDefault("l1Ratio")
        penalty = penalized.ridge_penalty(a) if r < 0 else penalized.enet_penalty(a, r, d.n)
        fits = penalized.fit(d, [penalty])
        model = LinearPredictorModel.of(fits, 0, saved_table(fits, df.sparkSession), self.getOrDefault("predictionCol"))
        d.release()
        return model


class LinearPredictorModel(Model, _LinearParams, DefaultParamsReadable, DefaultParamsWritable):
    """prediction = intercept + numeric and other weights + the weight of the row's
    value of the wide column (0 for values without one)."""

    weights = Param(Params._dummy(), "weights", "json: intercept, narrow weights and their slots, wide column, index",
                    typeConverter=TypeConverters.toString)
    tablePath = Param(Params._dummy(), "tablePath", "table of the wide column's weights", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, predictionCol="prediction", weights="{}", tablePath=""):
        super().__init__()
        self._setDefault(tablePath="")
        self._set(**self._input_kwargs)

    @staticmethod
    def of(fits: penalized.Fits, index: int, table_path: str, prediction: str = "prediction") -> LinearPredictorModel:
        d = fits.design
        payload = {"intercept": float(fits.intercepts[index]), "narrow": fits.narrow[index].tolist(), "slots": d.slots,
                   "wide": d.wide, "index": index}
        return LinearPredictorModel(numericCols=d.numeric, predictionCol=prediction, weights=json.dumps(payload), tablePath=table_path)

    def _transform(self, df: DataFrame) -> DataFrame:
        p, path = json.loads(self.getOrDefault("weights")), self.getOrDefault("tablePath")
        table = df.sparkSession.read.schema("value string, coefficients array<double>").parquet(path) if path else None
        out = F.lit(p["intercept"]) + _narrow_term(p["narrow"], self.getOrDefault("numericCols"), p["slots"])
        scored = _with_wide(df, p["wide"], table)
        return scored.withColumn(self.getOrDefault("predictionCol"), out + F.coalesce(F.col("_w")[p["index"]], F.lit(0.0))).drop("_w")
