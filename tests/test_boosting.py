"""Histogram boosting against an exact greedy search in plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larch.operators import boosting as bo


def exact_trees(x, y, n_numeric, n_trees, depth, eta, l2, splits):
    """Margins of exact second-order boosting over integer columns."""
    margin = np.zeros(len(y))
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)

        def grow(rows, level):
            G, H = g[rows].sum(), h[rows].sum()
            best = (bo.LEAST_GAIN, None)
            if level < depth:
                for c in range(x.shape[1]):
                    v = x[rows, c]
                    kinds = np.unique(v)
                    if c >= n_numeric and splits == "partition":
                        kinds = kinds[np.argsort([g[rows][v == k].sum() / (h[rows][v == k].sum() + l2) for k in kinds], kind="stable")]
                    for i in range(len(kinds) - (1 if c < n_numeric or splits == "partition" else 0)):
                        left = np.isin(v, kinds[:i + 1]) if c < n_numeric or splits == "partition" else v != kinds[i]
                        gl, hl = g[rows][left].sum(), h[rows][left].sum()
                        if min(hl, H - hl) < 1:
                            continue
                        gain = (gl ** 2 / (hl + l2) + (G - gl) ** 2 / (H - hl + l2) - G ** 2 / (H + l2)) / 2
                        if gain > best[0] + 1e-12:
                            best = gain, rows[left], rows[~left]
            if best[1] is None:
                margin[rows] += -eta * G / (H + l2)
            else:
                grow(best[1], level + 1)
                grow(best[2], level + 1)

        grow(np.arange(len(y)), 0)
    return margin


@pytest.mark.parametrize("splits", ["partition", "onehot"])
def test_margins_equal_exact_boosting(spark, splits):
    rng = np.random.default_rng(3)
    n = 600
    x = np.stack([rng.integers(0, 12, n), rng.integers(0, 5, n), rng.integers(0, 9, n)], axis=1)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.4 * x[:, 0] - 2 + np.where(np.isin(x[:, 2], [1, 4, 7]), 1.5, -1))))).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(x, y)], "a double, b double, c double, y double").repartition(3)
    rows, columns = bo.binned_rows(df, ["a", "b"], ["c"], [9], "y")
    boosters = [bo.Booster(3, 2, 1.3), bo.Booster(2, 3, 0.4)]
    fits = bo.fit(rows, columns, boosters, "logistic", splits)
    bins = columns.bins(x.astype(float))
    for b, trees in zip(boosters, fits.trees):
        got = sum(t.margin(bins, columns.first) for t in trees)
        assert np.abs(got - exact_trees(x, y, 2, b.n_trees, b.max_depth, b.eta, b.l2, splits)).max() < 1e-9


def test_patience_on_a_made_up_series():
    losses = [0.9, 0.7, 0.71, 0.6, 0.61, 0.62, 0.63, 0.64]
    assert bo.patience_end(losses, 5) == (4, False)
    assert bo.patience_end([*losses, 0.65], 5) == (4, True)
    assert bo.patience_end([0.5, 0.5, 0.5], 0) == (1, False)


def test_saved_model_scores_the_same(spark, tmp_path):
    df = spark.range(400).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("c"),
                                 ((F.col("id") % 7 > 3) | (F.col("id") % 3 == 1)).cast("int").alias("y"))
    from pyspark.ml.feature import VectorAssembler
    v = VectorAssembler(inputCols=["a", "c"], outputCol="features").transform(df)
    rows, columns = bo.vector_rows(v, "features", 1, [3], "y")
    model = bo.BoostedTreesModel.of(bo.fit(rows, columns, [bo.Booster(4, 2, 0.7)]), 0)
    model.write().overwrite().save(str(tmp_path / "m"))
    a, b = (m.transform(v).select("p1").toPandas()["p1"].to_numpy() for m in (model, bo.BoostedTreesModel.load(str(tmp_path / "m"))))
    assert (a == b).all() and ((a > 0.5) == v.select("y").toPandas()["y"].to_numpy()).all()
