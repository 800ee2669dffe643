"""Model fits (M1-M17) as MLlib estimators.

Each factory maps the original library's parameterization onto MLlib's,
so the same hyperparameter value means the same model:

* Ridge ``||y - Xw - b||^2 + alpha ||w||^2`` and elastic net
  ``1/(2n) ||y - Xw - b||^2 + alpha r |w|_1 + alpha (1-r)/2 ||w||^2``:
  MLlib scales the label by its std internally, which shifts the L2 part.
  With ``a = alpha r`` and ``b = alpha (1-r) sd(y)``:
  ``regParam = a + b``, ``elasticNetParam = a / (a + b)``,
  ``standardization = False``. Ridge is ``alpha / n`` with ``r = 0``.
  ``sd(y)`` is the sample std (l-bfgs).
* Logistic ``0.5 ||w||^2 + C sum(logloss)``: ``regParam = 1 / (C n)``.

Linear models use the distributed l-bfgs / OWL-QN solver at every width.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.ml.regression import GBTRegressor, LinearRegression

SEED = 123


@dataclass
class LabelStats:
    n: int
    mean: float
    sd_pop: float
    sd_samp: float
    mode: int | None = None


def label_stats(train: DataFrame, label: str, with_mode: bool = False) -> LabelStats:
    """One aggregate over the training rows."""
    y = F.col(label).cast("double")
    aggs = [F.count(y).alias("n"), F.avg(y).alias("mean"),
            F.stddev_pop(y).alias("sd_pop"), F.stddev_samp(y).alias("sd_samp")]
    if with_mode:
        aggs.append(F.mode(F.col(label), True).alias("mode"))
    r = train.agg(*aggs).first()
    return LabelStats(r["n"], r["mean"], r["sd_pop"] or 0.0, r["sd_samp"] or 0.0,
                      r["mode"] if with_mode else None)


# ---- baselines (M1, M2) -------------------------------------------------

def predict_constant(df: DataFrame, value: float | None, out: str = "prediction") -> DataFrame:
    """Constant prediction (NULL when the training side was empty)."""
    return df.withColumn(out, F.lit(None if value is None else float(value)).cast("double"))


def regression_baseline(train: DataFrame, label: str) -> float:
    """M1: the training mean."""
    return label_stats(train, label).mean


def classification_baseline(train: DataFrame, label: str) -> int:
    """M2: the training mode (smallest class on ties)."""
    return int(train.agg(F.mode(F.col(label), True).alias("m")).first()["m"])


def predict_class_constant(df: DataFrame, cls: int) -> DataFrame:
    """M2 scores: predicted class and P(1) of 1 or 0."""
    return df.withColumn("prediction", F.lit(float(cls))).withColumn(
        "p1", F.lit(1.0 if cls == 1 else 0.0))


# ---- linear models (M3-M6) ----------------------------------------------

def penalty_params(kind: str, stats: LabelStats, alpha: float = 0.0,
                   l1_ratio: float = 0.5) -> tuple[float, float]:
    """(regParam, elasticNetParam) for ``kind`` in ols/ridge/lasso/elastic_net."""
    sd = stats.sd_samp
    if kind == "ols":
        return 0.0, 0.0
    if kind == "ridge":
        return alpha * sd / stats.n, 0.0
    if kind == "lasso":
        return alpha, 1.0
    if kind == "elastic_net":
        a, b = alpha * l1_ratio, alpha * (1.0 - l1_ratio) * sd
        return (a + b), (a / (a + b) if a + b > 0 else 0.0)
    raise ValueError(f"unknown linear model {kind}")


def linear_regression(kind: str, stats: LabelStats, label: str,
                      alpha: float = 0.0, l1_ratio: float = 0.5,
                      features: str = "features", max_iter: int = 1000,
                      tol: float = 1e-12, fit_intercept: bool = True) -> LinearRegression:
    reg, mix = penalty_params(kind, stats, alpha, l1_ratio)
    return LinearRegression(featuresCol=features, labelCol=label, regParam=reg,
                            elasticNetParam=mix, standardization=False, solver="l-bfgs",
                            fitIntercept=fit_intercept, maxIter=max_iter, tol=tol)


# ---- classifiers (M7-M14) -----------------------------------------------

def logistic_regression(C: float, n: int, label: str, max_iter: int = 250,
                        features: str = "features", tol: float = 1e-6) -> LogisticRegression:
    """M7: L2-penalized logistic regression with inverse strength ``C``."""
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (C * n),
                              elasticNetParam=0.0, standardization=False, maxIter=max_iter,
                              tol=tol, family="binomial")


def decision_tree(label: str, max_depth: int = 5, max_bins: int = 32,
                  features: str = "features", seed: int = SEED) -> DecisionTreeClassifier:
    """M11."""
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=int(max_depth),
                                  maxBins=int(max_bins), seed=seed, impurity="gini")


def random_forest(label: str, max_depth: int, max_features: float, n_trees: int = 5,
                  min_leaf_fraction: float = 0.05, max_bins: int = 32,
                  features: str = "features", seed: int = SEED) -> RandomForestClassifier:
    """``min_samples_leaf`` as a fraction maps to the minimum weight
    fraction per child; ``max_features`` as a fraction string."""
    return RandomForestClassifier(
        featuresCol=features, labelCol=label, numTrees=int(n_trees), maxDepth=int(max_depth),
        minWeightFractionPerNode=float(min_leaf_fraction),
        featureSubsetStrategy=repr(float(max_features)), maxBins=int(max_bins), seed=seed)


def linear_svm(label: str, features: str = "features", reg: float = 0.0,
               max_iter: int = 100) -> LinearSVC:
    """Linear kernel only; no probabilities, AUC from the margin."""
    return LinearSVC(featuresCol=features, labelCol=label, regParam=reg, maxIter=max_iter)


def p_one(col: str = "probability") -> Column:
    """P(class 1) from an MLlib probability vector."""
    return vector_to_array(F.col(col))[1]


def margin(col: str = "rawPrediction") -> Column:
    return vector_to_array(F.col(col))[1]
