"""Stateless streaming scoring with a saved pipeline (S7 on a stream).

``events`` files arriving in a folder are projected to trips, turned into
features and scored by the saved ``PipelineModel``; predictions go to a
parquet sink with a checkpoint in the shared folder (exactly-once file
sink, restartable after a failure).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from larch.plans import scoring
from larch.session import unique_path
from larch.sources import trips as ts


def start_scoring(spark: SparkSession, model: PipelineModel, source: str, schema,
                  out_path: str, checkpoint: str, available_now: bool = True,
                  file_glob: str | None = None):
    """Start the scoring stream over parquet files arriving in ``source``
    (a folder); ``file_glob`` restricts which file names are read."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    stream = reader.parquet(source)
    scored = scoring.score(model, scoring.label_free_rows(ts.project_events(stream)))
    writer = (scored.writeStream.format("parquet").option("path", out_path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start()


def stream_score_month(spark: SparkSession, sf: str) -> DataFrame:
    """Score the month's events as a stream (available-now trigger) and
    read the sink back."""
    path, _ = scoring.train_and_save(spark, sf)
    model = PipelineModel.load(path)
    schema = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").schema
    out = unique_path(spark, "stream_scores")
    q = start_scoring(spark, model, sf, schema, out + "/data", out + "/checkpoint",
                      file_glob="events.parquet")
    q.awaitTermination()
    return spark.read.parquet(out + "/data")
