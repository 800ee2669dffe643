"""Saved pipelines and batch scoring of a month.

The fitted feature stages and the model are one ``PipelineModel`` saved
in the shared folder; scoring loads it and needs no label. Scoring is
stateless, so the same plan runs on a stream (``larch.streaming``).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.operators import targets
from larch.operators.linear import PenalizedRegression
from larch.plans import training as tr
from larch.session import unique_path
from larch.sources import runs as runlog
from larch.sources import trips as ts

SCORING_ALPHA = 1.0


def train_and_save(spark: SparkSession, sf: str, path: str | None = None) -> tuple[str, dict]:
    """Fit features + ridge on the train month, save one pipeline, log the run."""
    td = tr.prepare(spark, sf, "regression", drop_first=True)
    num, cat = targets.feature_lists("regression")
    est = PenalizedRegression(numericCols=num, categoricalCols=cat, labelCol=td.label, alpha=SCORING_ALPHA, dropFirst=True)
    model, metrics = tr.fit_and_evaluate(td, est)
    full = PipelineModel(stages=list(td.feature_model.stages) + [model])
    path = path or unique_path(spark, "models", "ridge")
    runlog.save_model(full, path)
    runlog.log_runs(spark, [runlog.run_row("scoring", "ridge", {"alpha": SCORING_ALPHA},
                                           metrics, tags={"data": sf, "task": "regression"}, artifact=path)])
    td.release()
    return path, metrics


def label_free_rows(trips: DataFrame) -> DataFrame:
    """A month to score: no dropoff, no tip -> no label can be derived."""
    rows = targets.task_frame(trips.drop("lpep_dropoff_datetime", "tip_amount"),
                              "regression", request_target=False)
    return targets.feature_columns(rows, "regression")


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).select("trip_id", F.col("prediction").alias("predicted_duration"))


def score_month(spark: SparkSession, sf: str) -> DataFrame:
    """Train on the (reduced) month, reload the saved pipeline, score
    every trip of the month without its label, write the predictions and read
    them back."""
    path, _ = train_and_save(spark, sf)
    out = unique_path(spark, "predictions")
    score(runlog.load_model(path), label_free_rows(ts.trips(spark, sf))).write.parquet(out)
    return spark.read.parquet(out)
