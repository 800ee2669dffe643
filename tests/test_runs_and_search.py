"""Run table, seeded priors, the sink's file sizes, and many logistic models at once."""

import glob

import numpy as np
from pyspark.sql import functions as F

from larch.operators import many_logistic as many, reduce as rd, search
from larch.plans import experiments as ex
from larch.session import unique_path
from larch.sources import runs as runlog


def _runs(spark, path, group, values):
    for model, v in values:
        runlog.log_runs(spark, [runlog.run_row("exp", model, {"a": 1}, {"auc": v}, run_group=group)], path)


def test_winner_leaderboard_and_compaction(spark):
    path = unique_path(spark, "test_runs")
    _runs(spark, path, "g1", [("b", 0.7), ("a", 0.9), ("c", 0.9), ("d", None)])
    _runs(spark, path, "g2", [("z", 0.1)])
    for runs in (runlog.read_runs(spark, path), runlog.compact_runs(spark, path, path + "_compact")):
        best = {r["run_group"]: r for r in runlog.winner(runs, "auc", True).collect()}
        assert best["g1"]["model_type"] == "a" and best["g2"]["model_type"] == "z"  # ties go to the smallest type
        assert runlog.winner(runs, "auc", False).where("run_group = 'g1'").first()["model_type"] == "b"
        board = runlog.leaderboard(runs.where("run_group = 'g1'"), "auc", True).orderBy("rank").collect()
        assert [r["model_type"] for r in board] == ["a", "c", "b", "d"]
    files = glob.glob((path + "_compact").removeprefix("file:") + "/*/*/*.parquet")
    assert len(files) == 2
    plan = runlog.read_runs(spark, path, run_group="g1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_group" in plan


def test_draws_are_the_same_in_spark_and_python(spark):
    space = {"l": search.lognormal(-1, 0.5), "u": search.uniform(0.5, 2), "c": search.choice(1, 2, 3, 4), "q": search.quniform(3, 5, 1), "fixed": 7}
    table = search.candidates(spark, space, 300, 5).orderBy("candidate").collect()
    for row, own in zip(table, search.sample(space, 300, 5)):
        assert all(abs(row[k] - v) < 1e-9 for k, v in own.items())
    logs = np.log([r["l"] for r in table])
    assert abs(logs.mean() + 1) < 0.1 and abs(logs.std() - 0.5) < 0.06
    assert {r["c"] for r in table} == {1, 2, 3, 4} and {r["q"] for r in table} == {3.0, 4.0, 5.0}


def test_best_candidate_is_the_first_of_ties(spark):
    table = spark.createDataFrame([(0, None), (1, 0.5), (2, 0.9), (3, 0.9)], "candidate long, auc double")
    assert [r["candidate"] for r in ex.with_best(table, "auc", True).where("is_best").collect()] == [2]


def test_sink_files_follow_the_rows(spark):
    rows = spark.range(1000).select(F.col("id").alias("trip_id"), F.when(F.col("id") == 0, "2022-02").otherwise("2022-01").alias("year_month"))
    path = unique_path(spark, "test_sink")
    rd.write_reduced(rows, path, rows_per_file=200)
    local = path.removeprefix("file:")
    sizes = {m: [spark.read.parquet(f).count() for f in glob.glob(f"{local}/year_month={m}/*.parquet")] for m in ("2022-01", "2022-02")}
    assert sizes["2022-02"] == [1] and sum(sizes["2022-01"]) == 999 and max(sizes["2022-01"]) <= 200 and len(sizes["2022-01"]) <= 12


def numpy_logistic(x, y, c):
    """Newton on mean logloss + 1 / (2 c n) |w|^2, intercept last."""
    z, beta = np.hstack([x, np.ones((len(y), 1))]), np.zeros(x.shape[1] + 1)
    pen = np.append(np.full(x.shape[1], 1 / (c * len(y))), 0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ beta))
        beta -= np.linalg.solve((z.T * (p * (1 - p))) @ z / len(y) + np.diag(pen) + 1e-14 * np.eye(len(beta)), z.T @ (p - y) / len(y) + pen * beta)
    return beta


def test_many_models_equal_single_fits(spark):
    rng = np.random.default_rng(1)
    n = 500
    x = np.stack([rng.normal(0, 3, n), rng.random(n) < 0.1, 20 + 5 * rng.random(n)], axis=1).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] / 2 + 2 * x[:, 1])))).astype(float)
    part = rng.integers(0, 4, n)
    rows = spark.createDataFrame(
        [(float(t), [j for j in range(3) if r[j]], [float(v) for v in r if v], int(k)) for t, r, k in zip(y, x, part)],
        "label double, columns array<int>, values array<double>, part int").repartition(3).persist()
    strengths = [0.3, 1.0, 5.0, 0.3, 1.0]
    out_of = [0, 1, 2, 9, 77]  # the rows of one part are left out; 9 and 77: none is

    def members(frame):
        return frame["part"].to_numpy()[:, None] != np.array(out_of)

    fits = many.fit_many(rows, 3, strengths, members, tol=1e-9)
    for j, (c, k) in enumerate(zip(strengths, out_of)):
        beta = numpy_logistic(x[part != k], y[part != k], c)
        assert np.abs(np.append(fits.weights[j], fits.intercepts[j]) - beta).max() < 1e-4
        assert fits.n[j] == (part != k).sum()
    nobody = many.fit_many(rows, 3, [1.0], lambda f: np.zeros((len(f), 1), dtype=bool))
    assert nobody.n[0] == 0 and not nobody.weights.any()
    rows.unpersist()


def test_a_comparison_prepares_each_kind_of_features_once(spark, tmp_path, monkeypatch):
    import datetime as dt

    from larch.plans import training as tr

    start = dt.datetime(2022, 1, 1)
    kinds = ["view", "click", "purchase", "error"]
    rows = [(i, start + dt.timedelta(minutes=37 * i), (i * i) % 3, kinds[i % 4], float(i * 7919 % 97) + 0.5, "{}") for i in range(900)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(
        str(tmp_path / "events.parquet"))
    made, prepare = [], tr.prepare

    def counted(*a, **k):
        made.append(bool(k.get("enable_categorical")))
        return prepare(*a, **k)

    monkeypatch.setattr(tr, "prepare", counted)
    runs, group = ex.classification_comparison(spark, str(tmp_path))
    assert sorted(made) == [False, True]
    assert {r["model_type"]: r["n"] for r in runs.groupBy("model_type").agg(F.count("*").alias("n")).collect()} == {
        "baseline": 1, "logistic_regression": 5, "decision_tree": 1, "random_forest": 5, "gradient_boosting": 5, "linear_svm": 1}
    assert runs.where("run_group != '" + group + "'").count() == 0
