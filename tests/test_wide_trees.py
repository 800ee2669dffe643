"""Trees over a category column with more codes than bins, whose sums stay in tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larch.operators import boosting as bo
from tests.test_boosting import exact_trees

CODES = 400


def _rows(spark, n=2400):
    rng = np.random.default_rng(5)
    x = np.stack([rng.integers(0, 8, n), rng.integers(0, 4, n), np.where(rng.random(n) < 0.2, 7, rng.integers(0, CODES, n))], axis=1)
    lift = rng.normal(0, 1.5, CODES)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.4 * x[:, 0] - 2 + lift[x[:, 2]])))).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t), i) for i, ((a, b, c), t) in enumerate(zip(x, y))],
                               "a double, b double, c double, y double, id long").repartition(5)
    return x, y, df


@pytest.mark.parametrize("splits,heavy", [("partition", False), ("onehot", False), ("onehot", True)])
def test_wide_column_equals_exact_boosting(spark, splits, heavy, monkeypatch):
    if heavy:  # code 7 is dealt out over tasks
        monkeypatch.setattr(bo, "HEAVY_ROWS", 100)
    monkeypatch.setattr(bo, "target_partitions", lambda n: 4)
    x, y, df = _rows(spark)
    rows, columns = bo.binned_rows(df, ["a", "b"], ["c"], [CODES], "y")
    assert columns.wide == 2
    boosters = [bo.Booster(2, 3, 0.8), bo.Booster(12, 1, 0.5)]
    fits = bo.fit(rows, columns, boosters, "logistic", splits)
    bins = columns.bins(x.astype(float))
    for b, trees in zip(boosters, fits.trees):
        got = sum(t.margin(bins, columns.first) for t in trees)
        assert np.abs(got - exact_trees(x, y, 2, b.n_trees, b.max_depth, b.eta, b.l2, splits)).max() < 1e-9


def test_a_split_is_told_in_few_bytes(spark):
    _, _, df = _rows(spark)
    rows, columns = bo.binned_rows(df, ["a", "b"], ["c"], [100_000], "y")
    for splits, most in (("onehot", 1_000), ("partition", 1_500)):
        model = bo.BoostedTreesModel.of(bo.fit(rows, columns, [bo.Booster(3, 2, 0.7)], "logistic", splits), 0)
        assert len(model.getOrDefault("trees")) < most


def test_kept_rows_hold_the_margin_of_every_model(spark):
    x, y, df = _rows(spark)
    _, columns = bo.binned_rows(df, ["a", "b"], ["c"], [CODES], "y")
    rows = df.select(F.col("y").alias("label"), F.lit(False).alias("valid"), F.array("a", "b", "c").alias("x"), "id")
    fits = bo.fit(rows, columns, [bo.Booster(11, 2, 0.5), bo.Booster(3, 1, 1.0)], "logistic", "onehot", lambda f: np.stack([f["id"] % 2 == 0, f["id"] >= 0], axis=1), keep_rows=True)
    found = fits.rows.orderBy("id").collect()
    bins = columns.bins(x.astype(float))
    for j, trees in enumerate(fits.trees):
        assert np.allclose([r["margin"][j] for r in found], sum(t.margin(bins, columns.first) for t in trees))
    fits.rows.unpersist()
