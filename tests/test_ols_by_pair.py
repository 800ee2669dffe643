"""Least squares of the comparison, with pair coefficients in closed form, against all columns at once."""

import numpy as np
from pyspark.sql import functions as F

from larch.plans import experiments as ex, training as tr
from tests.conftest import SF001


def test_ols_equals_numpy_least_squares(spark):
    td = tr.prepare(spark, SF001, "regression", drop_first=True)
    found = ex.linear_candidates(td, "ols", [{}])[0]["metrics"]
    rows = [(r["is_test"], r["features"].toArray(), r[td.label]) for r in td.frame.select("is_test", "features", F.col(td.label)).collect()]
    x = np.array([[*f, 1.0] for _, f, _ in rows])
    y, test = np.array([v for *_, v in rows], dtype=float), np.array([t for t, *_ in rows])
    w = np.linalg.lstsq(x[~test], y[~test], rcond=None)[0]
    assert abs(found["rmse_train"] - np.sqrt(np.mean((x[~test] @ w - y[~test]) ** 2))) < 1e-6
    td.release()
