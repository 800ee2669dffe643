"""Dropping the first category: no step, parameter or saved number per category."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from larch.operators import features as fe


def test_drop_first_costs_nothing_per_category(spark, tmp_path):
    n = 3000
    train = spark.range(n).select(F.format_string("k%05d", "id").alias("wide"), F.lit("only").alias("one"),
                                  F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.col("id") % 3)).alias("gaps"))
    enc = fe.OneHot(categoricalCols=["wide", "one", "gaps"], dropFirst=True).fit(train)
    params = [str(v) for s in enc.stages for p, v in s.extractParamMap().items()]
    assert max(map(len, params)) < 1000
    enc.write().overwrite().save(str(tmp_path / "m"))
    rows = spark.createDataFrame([("k00000", "only", "v1"), ("k00001", "only", "v2"), ("k02999", "else", None), ("new", None, "v3")], "wide string, one string, gaps string")
    for model in (enc, PipelineModel.load(str(tmp_path / "m"))):
        got = model.transform(rows).select("wide_ohe", "one_ohe", "gaps_ohe").collect()
        assert [[v.size for v in r] for r in got] == [[n - 1, 1, 1]] * 4
        slots = [[v.indices.tolist() for v in r] for r in got]
        assert slots == [[[], [0], []], [[0], [0], [0]], [[n - 2], [], []], [[], [], []]]
