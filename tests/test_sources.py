"""Trip files with the real schema: several months in one scan."""

import pytest
from pyspark.sql import functions as F

from larch.operators import reduce as rd, targets
from larch.session import unique_path
from larch.sources import trips as ts
from tests.conftest import SF01


def test_read_trip_months(spark):
    t = ts.trips(spark, SF01)
    base = unique_path(spark, "test_trip_files")
    files = []
    # two "monthly" files: the fixture month and the same rows a month later
    for shift, name in ((0, "2024-01"), (31, "2024-02")):
        m = t.withColumn("lpep_pickup_datetime",
                         F.timestamp_add("DAY", F.lit(shift) + F.when(F.col("trip_id") % 50 == 0, -6000).otherwise(0),
                                         "lpep_pickup_datetime")) \
             .withColumn("lpep_dropoff_datetime",
                         F.timestamp_add("DAY", F.lit(shift), "lpep_dropoff_datetime")) \
             .withColumn("PULocationID", F.col("PULocationID").cast("long")) \
             .withColumn("DOLocationID", F.col("DOLocationID").cast("long")) \
             .withColumn("trip_id", F.col("trip_id") + F.lit(shift * 1_000_000)) \
             .drop("year_month")
        path = f"{base}/green_tripdata_{name}.parquet"
        m.write.mode("overwrite").parquet(path)
        files.append(path)
    both = ts.read_trips(spark, files, key="trip_id")
    per_month = {r["year_month"]: r["n"] for r in
                 both.groupBy("year_month").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = t.count()
    # the month is the file's, whatever the pickup says (January holds stray pickups)
    assert per_month == {"2024-01": n, "2024-02": n}
    strays = both.where("year_month <> date_format(lpep_pickup_datetime, 'yyyy-MM')")
    assert strays.count() > 0
    assert dict(both.dtypes)["PULocationID"] == "string"
    # the reduction runs per month inside one plan
    report = {r["year_month"]: r for r in
              rd.reduction_report(rd.pair_counts(rd.with_pair(both))).collect()}
    assert sum(r["total_rows"] for r in report.values()) == 2 * n
    # kept-row total equals the sum of kept counts (the original's assertion)
    kept = rd.reduce_trips(both).count()
    assert kept == sum(r["kept_rows"] for r in report.values())


def test_missing_columns_fail_early(spark):
    path = unique_path(spark, "test_trip_files") + "/green_tripdata_2024-03.parquet"
    month = ts.trips(spark, SF01).limit(50).drop("year_month", "tip_amount").withColumn(
        "PULocationID", F.col("PULocationID").cast("long")).withColumn("DOLocationID", F.col("DOLocationID").cast("long"))
    month.write.parquet(path)
    with pytest.raises(ValueError, match="tip_amount"):
        ts.read_trips(spark, path, key="trip_id")
    unlabelled = ts.read_trips(spark, path, key="trip_id", optional=["tip_amount"])
    with pytest.raises(TypeError):
        targets.task_frame(unlabelled, "classification", request_target=True)
