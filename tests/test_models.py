"""Model mappings against numpy solutions of the published objectives."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from larch.operators import models, targets
from larch.operators.linear import PenalizedRegression
from larch.plans import training as tr
from tests.conftest import SF01


@pytest.fixture(scope="module")
def cls_small(spark):
    raw = tr.raw_task_frame(spark, SF01, "classification").filter(~F.col("is_test"))
    cols = ["trip_distance", "extra"]
    d = VectorAssembler(inputCols=cols, outputCol="features").transform(raw)
    pdf = d.select(*cols, "tipped").toPandas()
    return d, pdf[cols].to_numpy(), pdf["tipped"].to_numpy().astype(float)


def numpy_logistic(X, y, C):
    """min 0.5||w||^2 + C sum logloss (intercept unpenalized), Newton."""
    n, d = X.shape
    Z = np.hstack([X, np.ones((n, 1))])
    beta = np.zeros(d + 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-Z @ beta))
        g = C * Z.T @ (p - y)
        g[:d] += beta[:d]
        H = C * (Z.T * (p * (1 - p))) @ Z
        H[:d, :d] += np.eye(d)
        step = np.linalg.solve(H, g)
        beta -= step
        if np.abs(step).max() < 1e-12:
            break
    return beta


def test_logistic_mapping(cls_small):
    d, X, y = cls_small
    C = 0.3
    ref = numpy_logistic(X, y, C)
    m = models.logistic_regression(C, len(y), "tipped", tol=1e-12, max_iter=1000).fit(d)
    got = np.append(m.coefficients.toArray(), m.intercept)
    assert np.abs(got - ref).max() < 1e-4


def test_ridge_stage_equals_mllib(spark):
    td = tr.prepare(spark, SF01, "regression", drop_first=True)
    num, cat = targets.feature_lists("regression")
    own = PenalizedRegression(numericCols=num, categoricalCols=cat, labelCol=td.label, alpha=2.0, dropFirst=True).fit(td.train)
    m = models.linear_regression("ridge", td.stats, td.label, alpha=2.0).fit(td.train)
    a = tr.scores(td, own).select("trip_id", "prediction").toPandas().set_index("trip_id")
    b = tr.scores(td, m).select("trip_id", "prediction").toPandas().set_index("trip_id")
    assert (a.prediction - b.prediction.loc[a.index]).abs().max() < 1e-4
    ols_rmse = tr.fit_and_evaluate(td, models.linear_regression("ols", td.stats,
                                                                td.label))[1]["rmse_train"]
    assert ols_rmse <= tr.baseline_metrics(td)["rmse_train"] + 1e-9
    td.release()
