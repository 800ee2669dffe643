"""Penalised linear fits against dense numpy solutions, and at 40,000 columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larch.operators import models, penalized as pz
from larch.plans import experiments as ex, paths as P, training as tr
from tests.conftest import SF001


@pytest.fixture(scope="module")
def small(spark):
    """(design, dense matrix, label, names) of the train side of sf0.001."""
    rows = P.train_rows(spark, SF001).persist()
    d = P.regression_design(rows)
    pdf = rows.toPandas()
    names, columns = list(d.numeric), [pdf[c].to_numpy(dtype=float) for c in d.numeric]
    for c in ("PU_DO", "store_and_fwd_flag"):
        for v in sorted(pdf[c].unique()):
            names.append(f"{c}={v}")
            columns.append((pdf[c] == v).to_numpy(dtype=float))
    return d, np.stack(columns, axis=1), pdf["duration"].to_numpy(dtype=float), names


def dense(fits, names):
    """(penalties, columns) of all coefficients."""
    d = fits.design
    wide = {f"{d.wide}={r['value']}": r["coefficients"] for r in fits.wide.collect()}
    return np.array([wide[n] if n in wide else fits.narrow[:, d.names.index(n)] for n in names]).T


def breach(X, y, w, b, p):
    """How far the worst column is from its optimality condition."""
    g = X.T @ (y - b - X @ w) - p.l2 * w
    return np.where(w == 0, np.maximum(np.abs(g) - p.l1, 0), np.abs(g - p.l1 * np.sign(w))).max()


def test_ridge_equals_the_closed_form(small):
    d, X, y, names = small
    alphas = [0.01, 0.7, 30.0]
    fits = pz.fit(d, [pz.ridge_penalty(a) for a in alphas])
    xc, yc = X - X.mean(0), y - y.mean()
    for a, b, w in zip(alphas, fits.intercepts, dense(fits, names)):
        exact = np.linalg.solve(xc.T @ xc + a * np.eye(X.shape[1]), xc.T @ yc)
        assert np.abs(w - exact).max() < 1e-8 and abs(b - (y.mean() - X.mean(0) @ exact)) < 1e-8
    assert fits.rounds <= 2


@pytest.mark.parametrize("ratio", [1.0, 0.5])
def test_paths_meet_their_conditions(small, ratio):
    d, X, y, names = small
    alphas = pz.alpha_grid(d, ratio)
    assert abs(alphas[0] - np.abs(X.T @ y).max() / len(y) / ratio) < 1e-9 * alphas[0]
    penalties = [pz.enet_penalty(a, ratio, d.n) for a in alphas]
    fits = pz.fit(d, penalties, intercept=False)
    W = dense(fits, names)
    for w, p in zip(W, penalties):
        assert breach(X, y, w, 0.0, p) <= 1e-6 * p.l1
    nonzero = (W != 0).sum(axis=1)
    assert nonzero[0] == 0 and nonzero[-1] > nonzero[1]


def test_intercept_and_full_support(small):
    """So small a penalty that every pair has a coefficient: singular along the intercept."""
    d, X, y, names = small
    penalties = [pz.enet_penalty(a, r, d.n) for a, r in ((0.05, 0.3), (0.8, 0.7), (0.01, 1.0))]
    fits = pz.fit(d, penalties)
    for w, b, p in zip(dense(fits, names), fits.intercepts, penalties):
        assert breach(X, y, w, b, p) < 1e-6 * p.l1 and abs((y - b - X @ w).sum()) < 1e-6 * np.abs(y).sum()


def test_small_lasso_against_coordinate_descent():
    rng = np.random.default_rng(5)
    for _ in range(20):
        z = rng.standard_normal((30, 7))
        h, g, w = z.T @ z, 20 * rng.standard_normal(7), rng.standard_normal(7)
        l1, l2 = rng.uniform(0, 30, 7) * (rng.uniform(size=7) < 0.8), rng.uniform(0, 2, 7)
        x = pz.small_lasso(h, g, w, l1, l2)
        grad = -(g + h @ (x - w)) - l2 * x
        assert np.where(x == 0, np.maximum(np.abs(grad) - l1, 0), np.abs(grad - l1 * np.sign(x))).max() < 1e-8


def test_forty_thousand_columns(spark):
    """No bound on the width: 40,000 values, of which one has a third of the rows."""
    n, width = 120_000, 40_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("v0")).otherwise(F.concat(F.lit("v"), F.pmod(F.xxhash64("id"), F.lit(width)))).alias("pair"),
        F.when(F.col("id") % 2 == 0, "N").otherwise("Y").alias("flag"),
        (F.pmod(F.col("id") * 7919, F.lit(101)) / 10).alias("x"), F.pmod(F.col("id") * 104729, F.lit(997)).cast("double").alias("y")).persist()
    d = pz.design(rows, ["x"], ["pair", "flag"], "y")
    assert d.wide == "pair" and d.groups.count() > 30_000
    penalties = [pz.ridge_penalty(2.0)]
    ridge = pz.fit(d, penalties)
    assert P.optimality(rows, ridge, penalties, "y", True).first()["breach"] < 1e-10
    alphas = pz.alpha_grid(d, 1.0, 4, eps=1e-6)
    penalties = [pz.enet_penalty(a, 1.0, d.n) for a in alphas]
    lasso = pz.fit(d, penalties, intercept=False)
    assert max(r["breach"] for r in P.optimality(rows, lasso, penalties, "y", False).collect()) < 1e-10
    assert lasso.wide.where("coefficients[3] != 0").count() > 0
    rows.unpersist()
    d.release()


@pytest.mark.parametrize("kind", ["lasso", "elastic_net"])
def test_candidates_match_mllib_fits(spark, kind):
    """A search of all candidates together gives the metrics of separate MLlib fits
    under the penalty mapping."""
    td = tr.prepare(spark, SF001, "regression", drop_first=True)
    cands = [{"alpha": 0.05, "l1_ratio": 0.3}, {"alpha": 0.8, "l1_ratio": 0.7}]
    got = ex.linear_candidates(td, kind, cands)
    for p, r in zip(cands, got):
        est = models.linear_regression(kind, td.stats, td.label,
                                       alpha=p["alpha"], l1_ratio=p["l1_ratio"])
        ref = tr.fit_and_evaluate(td, est)[1]
        for k, v in ref.items():
            assert abs(r["metrics"][k] - v) <= 1e-6 * abs(v)
    td.release()
