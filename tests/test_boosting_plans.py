"""The plans of boosting stay small however many trees there are."""

import numpy as np
from pyspark.sql import functions as F

from larch.operators import boosting as bo


def test_plans_dont_grow_with_trees(spark, monkeypatch):
    df = spark.range(400).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("int").alias("c"),
                                 (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).cast("double").alias("y"))
    rows, columns = bo.binned_rows(df, ["a"], ["c"], [5], "y")
    texts, kept = [], bo._kept
    monkeypatch.setattr(bo, "KEEP", 2)
    monkeypatch.setattr(bo, "_kept", lambda *a: (texts.append(len((out := kept(*a))._jdf.queryExecution().toString())), out)[1])
    b = [bo.Booster(9, 2, 0.3)]
    often = bo.fit(rows, columns, b, keep_rows=True)
    assert len(texts) > 3 and max(texts) < 1.2 * min(texts)
    monkeypatch.setattr(bo, "KEEP", 100)
    once = bo.fit(rows, columns, b, keep_rows=True)
    a, c = (np.sort([r["margin"][0] for r in f.rows.select("margin").collect()]) for f in (often, once))
    assert (a == c).all() and len(np.unique(a)) > 5
