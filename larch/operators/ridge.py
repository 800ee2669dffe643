"""Exact ridge regression from one Gram aggregate (M4, H5).

The design is numeric columns plus one-hot categories (optionally without
the first slot). One Spark aggregate yields the d x d sufficient
statistics (:func:`larch.operators.paths.design_gram`); each penalty is a
d x d solve on the driver. All candidates of a search share the pass.

The fitted model predicts with JVM expressions: numeric weights as
literals, category weights through a join with a (value, weight) table
that Spark broadcasts or shuffles by its size. It is a pipeline
stage, so feature stages + ridge save and load as one object.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larch.operators import paths


class _RidgeParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric columns",
                        typeConverter=TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical columns",
                            typeConverter=TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "label column",
                     typeConverter=TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column",
                          typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[], labelCol="label",
                         predictionCol="prediction")


class GramRidge(Estimator, _RidgeParams, DefaultParamsReadable, DefaultParamsWritable):
    """min ||y - b - Xw||^2 + alpha ||w||^2 over [numeric, one-hot]."""

    alpha = Param(Params._dummy(), "alpha", "L2 penalty", typeConverter=TypeConverters.toFloat)
    dropFirst = Param(Params._dummy(), "dropFirst", "drop the first category slot",
                      typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, labelCol="label",
                 predictionCol="prediction", alpha=1.0, dropFirst=False):
        super().__init__()
        self._setDefault(alpha=1.0, dropFirst=False)
        self._set(**self._input_kwargs)

    def gram(self, df: DataFrame) -> paths.Gram:
        return paths.design_gram(df, self.getOrDefault("numericCols"),
                                 self.getOrDefault("categoricalCols"), None,
                                 self.getOrDefault("labelCol"), self.getOrDefault("dropFirst"))

    def model_from_gram(self, g: paths.Gram, alpha: float | None = None) -> "LinearPredictorModel":
        a = self.getOrDefault("alpha") if alpha is None else alpha
        b, w = paths.ridge_coefficients(g, a)
        return LinearPredictorModel.from_weights(
            self.getOrDefault("numericCols"), self.getOrDefault("categoricalCols"),
            g.categories, b, w, self.getOrDefault("predictionCol"))

    def fit_many(self, df: DataFrame, alphas: list[float]) -> list["LinearPredictorModel"]:
        """One aggregate, one model per penalty."""
        g = self.gram(df)
        return [self.model_from_gram(g, a) for a in alphas]

    def _fit(self, df: DataFrame) -> "LinearPredictorModel":
        return self.model_from_gram(self.gram(df))


class LinearPredictorModel(Model, _RidgeParams, DefaultParamsReadable, DefaultParamsWritable):
    """prediction = intercept + sum(w_i x_i) + sum over categorical columns
    of the weight of the row's value (0 for values without a slot)."""

    weights = Param(Params._dummy(), "weights", "json: intercept, numeric, categorical",
                    typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, predictionCol="prediction",
                 weights="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    @staticmethod
    def from_weights(num, cat, categories, intercept, w, prediction="prediction"):
        w = np.asarray(w, dtype=float)
        cat_w, off = {}, len(num)
        for c, cats in zip(cat, categories):
            cat_w[c] = {str(v): float(w[off + j]) for j, v in enumerate(cats)}
            off += len(cats)
        payload = {"intercept": float(intercept), "numeric": [float(x) for x in w[:len(num)]],
                   "categorical": cat_w}
        return LinearPredictorModel(numericCols=num, categoricalCols=cat, predictionCol=prediction,
                                    weights=json.dumps(payload))

    def coefficients(self) -> dict:
        return json.loads(self.getOrDefault("weights"))

    def _transform(self, df: DataFrame) -> DataFrame:
        p = self.coefficients()
        spark = df.sparkSession
        out = df
        expr = F.lit(p["intercept"])
        for c, wi in zip(self.getOrDefault("numericCols"), p["numeric"]):
            expr = expr + F.lit(wi) * F.col(c)
        for i, c in enumerate(self.getOrDefault("categoricalCols")):
            table = spark.createDataFrame(
                [(k, v) for k, v in p["categorical"].get(c, {}).items()],
                f"_k{i} string, _w{i} double")
            out = out.join(table, F.col(c).cast("string") == F.col(f"_k{i}"), "left")
            expr = expr + F.coalesce(F.col(f"_w{i}"), F.lit(0.0))
        drops = [f"_k{i}" for i in range(len(self.getOrDefault("categoricalCols")))] + \
                [f"_w{i}" for i in range(len(self.getOrDefault("categoricalCols")))]
        return out.withColumn(self.getOrDefault("predictionCol"), expr).drop(*drops)


def candidate_predictions(df: DataFrame, numeric: list[str], categorical: list[str],
                          categories: list[list[str]], fits: list[tuple[float, np.ndarray]],
                          prefix: str = "pred_") -> DataFrame:
    """Predictions of many linear fits over the same design as columns
    ``pred_0 .. pred_{k-1}`` in one projection: numeric weights are
    literals, category weights come from one (value, weights array) table
    per categorical column."""
    spark = df.sparkSession
    k = len(fits)
    W = np.array([w for _, w in fits]).reshape(k, -1)
    nn = len(numeric)
    out = df
    off = nn
    cat_terms = []
    for i, (c, cats) in enumerate(zip(categorical, categories)):
        rows = [(str(v), [float(x) for x in W[:, off + j]]) for j, v in enumerate(cats)]
        off += len(cats)
        table = spark.createDataFrame(rows, f"_k{i} string, _w{i} array<double>")
        out = out.join(table, F.col(c).cast("string") == F.col(f"_k{i}"), "left")
        cat_terms.append(f"_w{i}")
    preds = {}
    for j, (b, _) in enumerate(fits):
        e = F.lit(float(b))
        for i, c in enumerate(numeric):
            e = e + F.lit(float(W[j, i])) * F.col(c)
        for t in cat_terms:
            e = e + F.coalesce(F.col(t)[j], F.lit(0.0))
        preds[f"{prefix}{j}"] = e
    drops = [f"_k{i}" for i in range(len(cat_terms))] + cat_terms
    return out.withColumns(preds).drop(*drops)
