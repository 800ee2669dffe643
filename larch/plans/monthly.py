"""Real monthly files (S1, S2, S7): one file per month, the month in its name.

The given events make four of them, a quarter of the trips each. Everything after the
writing goes through :func:`larch.sources.trips.read_trips`: declared schema, the month
from the file's path, only the columns used, and only the files of the months asked for.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.operators import reduce as rd, targets
from larch.operators.linear import PenalizedRegression
from larch.plans import scoring
from larch.session import unique_path
from larch.sources import runs as runlog, trips as ts

#: As the original: three months to learn from, the next to score.
MONTHS = ("2022-01", "2022-02", "2022-03", "2022-04")
ALPHA = 1.0
LABEL_COLUMNS = ("lpep_dropoff_datetime", "tip_amount")


def write_files(spark: SparkSession, sf: str) -> list[str]:
    """One folder per month; the month to score has no dropoff and no tip."""
    base = unique_path(spark, "monthly")
    trips = ts.trips(spark, sf).drop("year_month")
    ids = {c: F.col(c).cast("long") for c in ("PULocationID", "DOLocationID")}
    paths = [f"{base}/green_tripdata_{m}.parquet" for m in MONTHS]
    for k, path in enumerate(paths):
        trips.where(F.col("trip_id") % len(MONTHS) == k).withColumns(ids).write.parquet(path)
    return paths


def summary(spark: SparkSession, sf: str) -> DataFrame:
    """Trips, distinct pairs and tipped trips of every file, in one scan."""
    t = rd.with_pair(ts.read_trips(spark, write_files(spark, sf), key="trip_id"))
    return t.groupBy("year_month").agg(F.count("*").alias("trips"), F.countDistinct("PU_DO").alias("distinct_pairs"),
                                       F.sum(F.coalesce(F.col("tip_amount") > 0, F.lit(False)).cast("long")).alias("tipped"))


def next_month(spark: SparkSession, sf: str) -> DataFrame:
    """trip_id, predicted_duration of the last month's trips."""
    paths = write_files(spark, sf)
    train = targets.task_frame(ts.read_trips(spark, paths[:-1], key="trip_id"), "regression")
    pipe = Pipeline(stages=[PenalizedRegression(categoricalCols=["PU_DO"], labelCol="duration", alpha=ALPHA)])
    model = pipe.fit(targets.feature_columns(train, "regression"))
    path = runlog.save_model(model, unique_path(spark, "models", "pairs"))
    later = ts.read_trips(spark, paths[-1:], key="trip_id").drop(*LABEL_COLUMNS)
    rows = targets.feature_columns(targets.task_frame(later, "regression", request_target=False), "regression")
    out = unique_path(spark, "predictions")
    scoring.score(runlog.load_model(path), rows).write.parquet(out)
    return spark.read.parquet(out)
