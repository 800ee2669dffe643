"""Saved pipelines, scoring, run table."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from larch.plans import scoring
from larch.sources import runs as runlog
from larch.sources import trips as ts
from larch.session import unique_path
from tests.conftest import SF001, SF01


def test_save_load_same_predictions(spark):
    path, metrics = scoring.train_and_save(spark, SF01, unique_path(spark, "test_model"))
    assert metrics["rmse_test"] > 0
    model = PipelineModel.load(path)
    rows = scoring.label_free_rows(ts.trips(spark, SF01))
    a = scoring.score(model, rows)
    b = scoring.score(PipelineModel.load(path), rows)
    j = a.join(b.withColumnRenamed("predicted_duration", "p2"), "trip_id")
    assert j.count() == rows.count()
    assert j.filter(F.abs(F.col("predicted_duration") - F.col("p2")) > 1e-12).count() == 0
    assert "duration" not in rows.columns


def test_runs_and_leaderboard(spark):
    path = unique_path(spark, "test_runs")
    runlog.log_runs(spark, [runlog.run_row("e", "a", {"x": 1}, {"m": 2.0}),
                            runlog.run_row("e", "b", {"x": 2}, {"m": 1.0})], path)
    b = runlog.leaderboard(runlog.read_runs(spark, path), "m", maximize=False)
    top = b.filter("rank = 1").first()
    assert top["model_type"] == "b"


def test_winner_of_the_run_table_reloads_and_scores(spark):
    from larch.plans import experiments as ex

    runs, group = ex.regression_comparison(spark, SF001)
    top = runlog.leaderboard(runs, "rmse_test", maximize=False).filter("rank = 1 AND artifact IS NOT NULL OR rank = 2").orderBy("rank").first()
    assert runs.count() == 17 and {r["run_group"] for r in runs.collect()} == {group}
    assert top["tags"]["task"] == "regression" and runlog.read_runs(spark).count() >= 17
    rows = scoring.label_free_rows(ts.trips(spark, SF001))
    scored = scoring.score(runlog.load_model(top["artifact"]), rows)
    assert scored.count() == rows.count() and scored.filter("predicted_duration IS NULL").count() == 0
