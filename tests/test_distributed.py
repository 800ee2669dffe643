"""Distributed rank / AUC / folds against brute force."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from larch.operators import evaluate, ranking, split
from larch.plans import training as tr
from tests.conftest import SF01


def brute_auc(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p, q in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_many_buckets_equals_pairwise(spark):
    raw = tr.raw_task_frame(spark, SF01, "classification").select("tipped", "fare_amount", "trip_id")
    pdf = raw.toPandas()
    exact = brute_auc(pdf.tipped.tolist(), pdf.fare_amount.tolist())
    one = evaluate.roc_auc(raw, "tipped", "fare_amount").first()["roc_auc"]
    many = evaluate.roc_auc(raw, "tipped", "fare_amount", rows_per_bucket=7).first()["roc_auc"]
    assert one == pytest.approx(exact, abs=1e-12)
    assert many == pytest.approx(exact, abs=1e-12)


def test_running_totals_bucketed(spark):
    df = spark.range(0, 5000).withColumn("g", F.col("id") % 3).withColumn(
        "o", F.pmod(F.col("id") * 7919, F.lit(4999)))
    b = ranking.uniform_bucket(F.col("o"), 0, 4999, 13)
    out = ranking.running_totals(df, ["o", "id"], {"c": F.lit(1)}, b, ["g"]).toPandas()
    out = out.sort_values(["g", "o", "id"])
    expect = out.groupby("g").cumcount()
    assert (out["c_before"].values == expect.values).all()


def test_stratified_folds_balanced(spark):
    raw = tr.raw_task_frame(spark, SF01, "classification").filter(~F.col("is_test"))
    f = split.with_stratified_folds(raw.select("trip_id", "tipped"), "tipped", 10, n_rows=3)
    counts = f.groupBy("tipped", "fold").count().toPandas()
    for _, g in counts.groupby("tipped"):
        assert g["count"].max() - g["count"].min() <= 1
        assert len(g) == 10


def test_split_independent_of_partitioning(spark):
    raw = tr.raw_task_frame(spark, SF01, "regression").select("trip_id", "is_test")
    a = sorted(map(tuple, raw.collect()))
    b = sorted(map(tuple, raw.repartition(13).collect()))
    assert a == b
    share = np.mean([x[1] for x in a])
    assert 0.25 < share < 0.35
