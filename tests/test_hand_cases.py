"""Hand-checkable cases (FIXTURES.md C)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larch.functions import scalar as S
from larch.operators import evaluate, features as fe, models, reduce as rd, targets


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_duration_bounds_and_subsecond(spark):
    base = ts("2022-01-01 00:00:00")
    rows = [(1, base, base + dt.timedelta(minutes=m)) for m in (0.99, 1.0, 60.0, 60.01)]
    rows.append((5, ts("2022-01-01 00:00:00.900000"), ts("2022-01-01 00:01:00.100000")))
    df = spark.createDataFrame(rows, "trip_id long, lpep_pickup_datetime timestamp_ntz, "
                                     "lpep_dropoff_datetime timestamp_ntz")
    d = targets.with_duration(df)
    sub = d.filter("trip_id = 5").first()["duration"]
    assert sub == pytest.approx(0.98667, abs=1e-5)
    kept = sorted(r["duration"] for r in targets.duration_in_range(d).collect())
    assert kept == pytest.approx([1.0, 60.0])


def test_tip_and_payment_rules(spark):
    df = spark.createDataFrame(
        [(1, 1.0, None), (2, None, 3.0), (3, 1.0, 2.0), (4, 2.0, 5.0)],
        "trip_id long, payment_type double, tip_amount double")
    out = {r["trip_id"]: r["tipped"] for r in targets.card_trips_with_tip_label(df).collect()}
    assert out == {1: 0, 3: 1}
    assert "tip_amount" not in targets.card_trips_with_tip_label(df).columns


def test_iso_week_and_weekday(spark):
    df = spark.createDataFrame([(ts("2022-01-01 10:00:00"), ts("2022-01-03 10:00:00"))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(S.iso_week("a").alias("w"), S.weekday_monday0("b").alias("d")).first()
    assert r["w"] == 52 and r["d"] == 0


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "c string")
    r = fe.fill_statistics(df, [], ["c"]).first()
    assert r["c"] == "a"


def test_pair_key_null_propagates(spark):
    df = spark.createDataFrame([("1", "2"), ("1", None)], "a string, b string")
    assert [r[0] for r in df.select(S.pair_key("a", "b")).collect()] == ["1_2", None]


def test_pair_count_strict(spark):
    rows = [(i, "2022-01", "1", "1") for i in range(10)] + \
           [(100 + i, "2022-01", "2", "2") for i in range(11)]
    df = spark.createDataFrame(rows, "trip_id long, year_month string, "
                                     "PULocationID string, DOLocationID string")
    kept = rd.reduce_trips(df)
    assert kept.count() == 11
    assert sorted(r["trip_id"] for r in kept.collect()) == list(range(100, 111))


def test_encoder_no_drop_unknown_zero(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    enc = fe.OneHot(categoricalCols=["c"]).fit(train)
    v = enc.transform(spark.createDataFrame([("zz",), ("b",)], "c string")).collect()
    assert v[0]["c_ohe"].size == 3 and v[0]["c_ohe"].numNonzeros() == 0
    assert list(v[1]["c_ohe"].toArray()) == [0.0, 1.0, 0.0]


def test_encoder_drop_first(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    enc = fe.OneHot(categoricalCols=["c"], dropFirst=True).fit(train)
    v = enc.transform(spark.createDataFrame([("a",), ("c",), ("q",)], "c string")).collect()
    assert v[0]["c_ohe"].size == 2 and v[0]["c_ohe"].numNonzeros() == 0
    assert list(v[1]["c_ohe"].toArray()) == [0.0, 1.0]
    assert v[2]["c_ohe"].numNonzeros() == 0


def test_threshold_tie_gives_zero(spark):
    df = spark.createDataFrame([(0.5,), (0.49,)], "p0 double")
    assert [r[0] for r in df.select(S.label_from_p0("p0", 0.5)).collect()] == [0, 1]


def test_constant_score_auc_half(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 1.0), (1, 1.0), (0, 1.0), (0, 1.0)], "y int, s double")
    assert evaluate.roc_auc(df, "y", "s").first()["roc_auc"] == pytest.approx(0.5)


def test_baseline_class_tie_is_zero(spark):
    df = spark.createDataFrame([(0,), (1,), (0,), (1,)], "y int")
    assert models.classification_baseline(df, "y") == 0


def test_task_dispatch_errors():
    with pytest.raises(TypeError):
        targets.target_for("ranking")


def test_missing_target_requested(spark):
    df = spark.createDataFrame([(1, 1.0)], "trip_id long, payment_type double")
    with pytest.raises(TypeError):
        targets.task_frame(df, "classification", request_target=True)
    assert targets.task_frame(df, "classification", request_target=False).count() == 1


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    m = fe.PopulationScaler(numericCols=["x", "k"]).fit(df)
    out = m.transform(df).collect()
    assert [r["x"] for r in out] == pytest.approx([-1.0, 1.0])
    assert [r["k"] for r in out] == [0.0, 0.0]
