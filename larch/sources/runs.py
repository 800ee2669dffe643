"""Run log (S4), saved pipelines (S5, S6) and the leaderboard.

Every fit appends one row -- tags, params, metrics and the path of its
saved pipeline -- to ONE parquet table in the shared folder, so today's runs
compare with yesterday's. Picking the winner is a query over that table.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larch.session import workspace_path

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("experiment", T.StringType(), False),
    T.StructField("run_name", T.StringType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("run_group", T.StringType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("artifact", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])


#: A reader of one experiment or group opens its folders alone.
FOLDERS = ("experiment", "run_group")
#: A group of at most so many files is read as it is.
MANY_FILES = 32


def runs_path(spark: SparkSession) -> str:
    return workspace_path(spark, "runs")


def run_row(experiment: str, model_type: str, params: dict, metrics: dict,
            run_name: str = "base", tags: dict | None = None,
            artifact: str | None = None, run_group: str | None = None) -> dict:
    """One run. ``tags`` say what it was run on (data, task, threshold);
    ``run_group`` is shared by the runs of one comparison."""
    return {
        "run_id": uuid.uuid4().hex,
        "experiment": experiment,
        "run_name": run_name,
        "model_type": model_type,
        "run_group": run_group or new_group(),
        "tags": {k: str(v) for k, v in (tags or {}).items()},
        "params": {k: str(v) for k, v in params.items()},
        "metrics": {k: (None if v is None else float(v)) for k, v in metrics.items()},
        "artifact": artifact,
        "created_at": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
    }


def log_runs(spark: SparkSession, rows: list[dict], path: str | None = None) -> str:
    """Append run rows, in a folder per experiment and group."""
    path = path or runs_path(spark)
    spark.createDataFrame(rows, RUNS_SCHEMA).coalesce(1).write.mode("append").partitionBy(*FOLDERS).parquet(path)
    return path


def new_group() -> str:
    return uuid.uuid4().hex


def read_runs(spark: SparkSession, path: str | None = None, run_group: str | None = None, experiment: str | None = None) -> DataFrame:
    """All runs ever logged, or those of one experiment or group, whose folders alone are read."""
    runs = spark.read.schema(RUNS_SCHEMA).parquet(path or runs_path(spark))
    if experiment is not None:
        runs = runs.filter(F.col("experiment") == experiment)
    return runs if run_group is None else runs.filter(F.col("run_group") == run_group)


def compact_runs(spark: SparkSession, path: str, to: str) -> DataFrame:
    """The run table written anew with one file per group (S4): each log call leaves a
    small one. Old files stay until the caller has moved to the new table."""
    read_runs(spark, path).repartition(*FOLDERS).write.partitionBy(*FOLDERS).parquet(to)
    return read_runs(spark, to)


def winner(runs: DataFrame, metric: str, maximize: bool) -> DataFrame:
    """H3: per experiment and group, the run with the best metric (ties: the smallest
    model type, parameters and id), by one aggregate."""
    m = F.col("metrics")[metric]
    key = F.struct((-m if maximize else m).alias("m"), "model_type", F.to_json("params").alias("p"), "run_id")
    return runs.where(m.isNotNull()).groupBy("experiment", "run_group").agg(
        F.min_by(F.struct("run_id", "model_type", "params", "metrics", "artifact"), key).alias("best")).select("experiment", "run_group", "best.*")


def save_model(model: PipelineModel, path: str) -> str:
    """Fitted feature stages and model as one pipeline."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def leaderboard(runs: DataFrame, metric: str, maximize: bool) -> DataFrame:
    """Runs ranked inside each experiment by one metric; ties by model
    type and parameters, so the ranking doesn't change between runs."""
    m = F.col("metrics")[metric]
    order = m.desc_nulls_last() if maximize else m.asc_nulls_last()
    w = Window.partitionBy("experiment").orderBy(order, "model_type", F.to_json("params"), "run_id")
    return runs.withColumn(metric, m).withColumn("rank", F.row_number().over(w))
