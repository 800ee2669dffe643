"""Experiments: searches, comparisons, refits.

Each experiment prepares its feature frame once (persisted), computes the
baseline, runs the candidate fits on Spark, logs every run to the run
table and returns one row per run. Search spaces and evaluation counts are
those of the original course notebooks.
"""

from __future__ import annotations

import math
import threading
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from larch.operators import boosting, evaluate, features as fe, models, penalized, search, split, targets, wide_logistic
from larch.operators import linear as lin
from larch.operators.search import choice, lognormal, quniform, uniform
from larch.plans import training as tr
from larch.sources import runs as runlog

SEED = 123

# Search spaces and evaluation counts of the original notebooks.
RIDGE_SPACE = {"alpha": lognormal(0, 1)}
LASSO_SPACE = {"alpha": lognormal(0, 1)}
ELASTIC_NET_SPACE = {"alpha": lognormal(0, 1), "l1_ratio": uniform(0, 1)}
LOGISTIC_SPACE = {"C": lognormal(-1, 0.5), "max_iter": 250}
BOOSTED_SPACE = {"n_estimators": 100, "max_depth": choice(1, 2, 3, 4), "eta": uniform(0.5, 2)}
FOREST_SPACE = {"n_estimators": 5, "min_samples_leaf": 0.05,
                "max_features": uniform(0.2, 0.6), "max_depth": quniform(3, 5, 1)}
GRADIENT_BOOSTING_SPACE = {"n_estimators": 5, "validation_fraction": 0.1,
                           "max_depth": quniform(3, 5, 1), "learning_rate": uniform(0.05, 0.1), "patience": 5}
BOOSTED_REGRESSION_SPACE = {"n_estimators": 5, "max_depth": choice(3, 4),
                            "eta": uniform(0.05, 0.5), "validation_fraction": 0.1, "patience": 5}
EVALS = {"ridge": 5, "lasso": 5, "elastic_net": 10, "comparison": 5, "logistic": 5,
         "boosted": 3, "forest": 5, "gradient_boosting": 5, "boosted_regression": 5}
TREE_BINS = 32
#: Classifier families of a comparison that are fitted at a time.
FAMILIES_AT_ONCE = 5
#: Appends to the run table, one at a time: a folder takes one Spark write.
_LOGGING = threading.Lock()
LEARNING_CURVE_FOLDS = 10
LEARNING_CURVE_FRACTIONS = [round(0.1 * i, 1) for i in range(1, 11)]


def results_frame(spark: SparkSession, experiment: str, model_type: str,
                   results: list[dict], loss: str, maximize: bool) -> DataFrame:
    """One row per run with params and metrics as columns; the best is found by a query."""
    rows = []
    for i, r in enumerate(results):
        d = {"experiment": experiment, "model_type": r.get("model_type", model_type), "candidate": i}
        d.update({f"param_{k}": float(v) for k, v in r["params"].items()
                  if isinstance(v, (int, float))})
        d.update({k: (None if v is None else float(v)) for k, v in r["metrics"].items()})
        rows.append(d)
    keys = sorted({k for d in rows for k in d})
    table = spark.createDataFrame([Row(**{k: d.get(k) for k in keys}) for d in rows])
    return with_best(table, loss, maximize)


def with_best(table: DataFrame, loss: str, maximize: bool) -> DataFrame:
    """H3: flags the candidate of the best metric (the first on ties)."""
    m = -F.col(loss) if maximize else F.col(loss)
    best = table.where(F.col(loss).isNotNull()).agg(F.min_by("candidate", F.struct(m, "candidate")).alias("_best"))
    return table.join(best, F.col("candidate") == F.col("_best"), "left").withColumn("is_best", F.col("_best").isNotNull()).drop("_best")


def _log(td: tr.TaskData, sf: str, experiment: str, model_type: str, results: list[dict], run_group: str | None) -> None:
    """The runs of a search, in the one run table."""
    tags = {"data": sf, "task": td.task, "threshold": 0.5, **{k: v for k, v in td.options.items()}}
    rows = [runlog.run_row(experiment, r.get("model_type", model_type), r["params"], r["metrics"], tags=tags,
                           artifact=r.get("artifact"), run_group=run_group or runlog.new_group()) for r in results]
    if rows:
        with _LOGGING:
            runlog.log_runs(td.frame.sparkSession, rows)


# ---- regression ----------------------------------------------------------

def linear_search(spark: SparkSession, sf: str, kind: str, drop_first: bool = False,
                  td: tr.TaskData | None = None, run_group: str | None = None,
                  experiment: str | None = None) -> DataFrame:
    """H2 over ridge / lasso / elastic net, loss = test rmse."""
    own = td is None
    td = td or tr.prepare(spark, sf, "regression", drop_first=drop_first)
    space = {"ridge": RIDGE_SPACE, "lasso": LASSO_SPACE, "elastic_net": ELASTIC_NET_SPACE}[kind]
    n = EVALS[kind] if experiment is None else EVALS["comparison"]
    cands = search.sample(space, n, SEED)
    results = linear_candidates(td, kind, cands)
    experiment = experiment or f"{kind}_search"
    _log(td, sf, experiment, kind, results, run_group)
    out = results_frame(spark, experiment, kind, results, "rmse_test", False)
    if own:
        td.release()
    return out


def linear_candidates(td: tr.TaskData, kind: str, cands: list[dict]) -> list[dict]:
    """Every candidate of a linear search (or least squares) together: one aggregate of the train side,
    a few rounds for all penalties (one for ridge), and one aggregate that scores all
    candidates on both sides. The weights are written once, as one table."""
    num, cat = targets.feature_lists("regression")
    d = penalized.design(td.train, num, cat, td.label, drop_first=bool(td.options.get("drop_first")))
    if kind == "ols":
        penalties = [penalized.Penalty(0.0, 0.0) for _ in cands]
    elif kind == "ridge":
        penalties = [penalized.ridge_penalty(p["alpha"]) for p in cands]
    else:
        penalties = [penalized.enet_penalty(p["alpha"], 1.0 if kind == "lasso" else float(p["l1_ratio"]), d.n) for p in cands]
    fits = penalized.fit(d, penalties)
    path = lin.saved_table(fits, td.frame.sparkSession)
    if fits.wide is not None:
        fits.wide = td.frame.sparkSession.read.schema("value string, coefficients array<double>").parquet(path)
    metrics = evaluate.regression_reports(lin.predictions(td.frame, fits), td.label, [f"pred_{j}" for j in range(len(cands))])
    d.release()
    saved = search.run(lambda j: {"path": tr.save_pipeline(td, lin.LinearPredictorModel.of(fits, j, path), kind)}, list(range(len(cands))))
    return [{"params": p, "metrics": m, "artifact": a["metrics"]["path"]} for p, m, a in zip(cands, metrics, saved)]


def regression_comparison(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """H9: baseline, OLS, ridge, lasso and elastic net on the same split
    and drop-first features; every run logged to one run table."""
    td = tr.prepare(spark, sf, "regression", drop_first=True)
    group = runlog.new_group()
    exp = "linear_regression_comparison"
    base = [{"params": {}, "metrics": tr.baseline_metrics(td), "model_type": "baseline"}]
    base += [{**r, "model_type": "ols"} for r in linear_candidates(td, "ols", [{}])]
    _log(td, sf, exp, "baseline", base, group)
    for kind in ("ridge", "lasso", "elastic_net"):
        linear_search(spark, sf, kind, td=td, run_group=group, experiment=exp)
    td.release()
    return runlog.read_runs(spark, run_group=group), group


# ---- classification ------------------------------------------------------

def _classifier_search(spark, sf, name, space, n, make, enable_categorical=False,
                       td=None, run_group=None, experiment=None):
    own = td is None
    td = td or tr.prepare(spark, sf, "classification", enable_categorical=enable_categorical)
    cands = search.sample(space, n, SEED)

    def objective(p):
        return tr.fit_evaluate_save(td, make(td, p), name)

    results = search.run(objective, cands)
    experiment = experiment or f"{name}_search"
    _log(td, sf, experiment, name, results, run_group)
    out = results_frame(spark, experiment, name, results, "roc_auc_test", True)
    if own:
        td.release()
    return out


def logistic_fits(td: tr.TaskData, cands: list[dict]) -> tuple[wide_logistic.Blocks, wide_logistic.WideFits]:
    """The logistic models of all candidates together, on the train side of a frame of codes."""
    def side(frame, test: bool):
        return np.tile((frame["is_test"].to_numpy(dtype=bool) == test)[:, None], (1, len(cands)))

    num, _ = targets.feature_lists(td.task)
    b = wide_logistic.blocks(td.frame, "features", len(num), code_sizes(td), td.label, len(cands), lambda f: side(f, False), lambda f: side(f, True), "is_test")
    return b, wide_logistic.fit(b, [p["C"] for p in cands], int(cands[0]["max_iter"]))


def logistic_candidates(td: tr.TaskData, cands: list[dict], name: str = "logistic_regression") -> list[dict]:
    """Every candidate of a logistic search, fitted together; each scored and saved."""
    b, fits = logistic_fits(td, cands)
    path = wide_logistic.saved_table(b, fits)

    def one(j: int) -> tuple[dict, str]:
        model = wide_logistic.WideLogisticModel.of(b, fits, j, path)
        return tr.evaluate_model(td, model), tr.save_pipeline(td, model, name)

    results = [{**r, "params": p} for r, p in zip(search.run(one, list(range(len(cands)))), cands)]
    b.release()
    return results


def logistic_search(spark, sf, td=None, run_group=None, experiment=None, codes=None):
    """M7 + H2: C ~ lognormal(-1, 0.5), 250 iterations, best = highest test AUC."""
    # a coefficient per category: rows come as codes, not as one-hot columns
    own = codes or tr.prepare(spark, sf, "classification", enable_categorical=True)
    results = logistic_candidates(own, search.sample(LOGISTIC_SPACE, EVALS["logistic"], SEED))
    experiment = experiment or "logistic_regression_search"
    _log(td or own, sf, experiment, "logistic_regression", results, run_group)
    if codes is None:
        own.release()
    return results_frame(spark, experiment, "logistic_regression", results, "roc_auc_test", True)


def code_sizes(td: tr.TaskData) -> list[int]:
    """Codes of every categorical column: its categories and one for unseen values."""
    for st in td.feature_model.stages:
        if isinstance(st, StringIndexerModel):
            return [n + 1 for n in fe.label_counts(st)]
    raise ValueError("no category codes in the feature pipeline")


def boosted_candidates(td: tr.TaskData, cands: list[dict], name: str, splits: str, l2: float = 1.0, min_child: float = 1.0) -> list[dict]:
    """Every candidate of a boosted search, grown side by side on the train rows."""
    num, _ = targets.feature_lists(td.task)
    objective = "logistic" if td.task == "classification" else "squared"
    valid = "is_valid" if any(p.get("validation_fraction") for p in cands) else None
    train = split.with_validation(td.train, cands[0]["validation_fraction"]) if valid else td.train
    rows, columns = boosting.vector_rows(train, "features", len(num), code_sizes(td), td.label, valid=valid)
    fits = boosting.fit(rows, columns, [
        boosting.Booster(int(p["n_estimators"]), int(p["max_depth"]), float(p.get("eta", p.get("learning_rate"))), l2, min_child, int(p.get("patience", 0)))
        for p in cands], objective, splits)
    rows.unpersist()

    def one(j: int) -> tuple[dict, str]:
        model = boosting.BoostedTreesModel.of(fits, j)
        return {**tr.evaluate_model(td, model), "n_trees": float(len(fits.trees[j]))}, tr.save_pipeline(td, model, name)

    return [{**r, "params": p} for r, p in zip(search.run(one, list(range(len(cands)))), cands)]


def _boosted(spark, sf, name: str, task: str, space: dict, n: int, splits: str, td=None, run_group=None, experiment=None, codes=None, **how) -> DataFrame:
    # both ways read category codes: with "onehot" a split parts one category from the rest
    own = codes or tr.prepare(spark, sf, task, enable_categorical=True)
    results = boosted_candidates(own, search.sample(space, n, SEED), name, splits, **how)
    experiment = experiment or f"{name}_search"
    _log(own, sf, experiment, name, results, run_group)
    if codes is None:
        own.release()
    loss, maximize = ("roc_auc_test", True) if task == "classification" else ("rmse_test", False)
    return results_frame(spark, experiment, name, results, loss, maximize)


def boosted_search(spark, sf, enable_categorical: bool, **kw):
    """M8 (category codes) / M9 (one-hot): 100 second-order trees, depth 1-4, eta 0.5-2."""
    return _boosted(spark, sf, "boosted_trees_" + ("categorical" if enable_categorical else "onehot"), "classification",
                    BOOSTED_SPACE, EVALS["boosted"], "partition" if enable_categorical else "onehot", **kw)


def _draws(tree: int, row_hash: np.ndarray) -> np.ndarray:
    """How often a row is drawn for a tree of a forest: a Poisson number of mean 1 from a
    hash of its key, so any cluster draws the same."""
    z = row_hash.astype(np.int64).view(np.uint64) + np.uint64((SEED * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(by)
    u = (z ^ (z >> np.uint64(31))) / 2.0 ** 64
    below = np.cumsum(np.exp(-1) / np.array([math.factorial(k) for k in range(20)]))
    return np.searchsorted(below, u, side="right").astype(np.uint8)


def tree_candidates(td: tr.TaskData, cands: list[dict], name: str) -> list[dict]:
    """Classification trees and forests of every candidate, grown side by side on the train
    rows: Gini impurity, one category against the others. A forest's trees draw their rows
    with replacement and each node its columns; ``min_samples_leaf`` is a share of the rows."""
    num, _ = targets.feature_lists(td.task)
    rows, columns = boosting.vector_rows(td.train, "features", len(num), code_sizes(td), td.label, F.xxhash64("trip_id").alias("row_hash"),
                                         n_bins=TREE_BINS)
    trees = [(i, t) for i, p in enumerate(cands) for t in range(int(p.get("n_estimators", 1)))]
    boosters = [boosting.Booster(1, int(p["max_depth"]), 1 / int(p.get("n_estimators", 1)), 0.0, max(1.0, p.get("min_samples_leaf", 0.0) * td.stats.n),
                                 share=float(p.get("max_features", 1.0)), seed=(SEED, i, t)) for i, t in trees for p in [cands[i]]]
    forest = [int(cands[i].get("n_estimators", 1)) > 1 for i, _ in trees]

    def members(frame):
        key = frame["row_hash"].to_numpy()
        drawn = {t: _draws(t, key) for t in {t for (_, t), f in zip(trees, forest) if f}}
        return np.stack([drawn[t] if f else np.ones(len(key), dtype=np.uint8) for (_, t), f in zip(trees, forest)], axis=1)

    fits = boosting.fit(rows, columns, boosters, "gini", "onehot", members)
    rows.unpersist()
    fits.trees = [[fits.trees[k][0] for k, (i, _) in enumerate(trees) if i == c] for c in range(len(cands))]

    def one(j: int) -> tuple[dict, str]:
        model = boosting.BoostedTreesModel.of(fits, j)
        return tr.evaluate_model(td, model), tr.save_pipeline(td, model, name)

    return [{**r, "params": p} for r, p in zip(search.run(one, list(range(len(cands)))), cands)]


def _trees(spark, sf, name: str, space: dict, n: int, td=None, run_group=None, experiment=None, codes=None) -> DataFrame:
    # one category against the others is a split of its one-hot column: rows come as codes
    own = codes or tr.prepare(spark, sf, "classification", enable_categorical=True)
    results = tree_candidates(own, search.sample(space, n, SEED), name)
    experiment = experiment or f"{name}_search"
    _log(td or own, sf, experiment, name, results, run_group)
    if codes is None:
        own.release()
    return results_frame(spark, experiment, name, results, "roc_auc_test", True)


def forest_search(spark, sf, **kw):
    """5 trees, leaf share 0.05, feature share and depth searched."""
    return _trees(spark, sf, "random_forest", FOREST_SPACE, EVALS["forest"], **kw)


def gradient_boosting_search(spark, sf, **kw):
    """5 trees without L2 penalty, 10% of train held out, patience of 5 trees."""
    return _boosted(spark, sf, "gradient_boosting", "classification", GRADIENT_BOOSTING_SPACE, EVALS["gradient_boosting"], "onehot",
                    l2=0.0, min_child=1e-6, **kw)


def decision_tree_fit(spark, sf, **kw):
    """One tree, library defaults."""
    return _trees(spark, sf, "decision_tree", {"max_depth": 5}, 1, **kw)


def svm_fit(spark, sf, **kw):
    """Linear support vector machine."""
    return _classifier_search(spark, sf, "linear_svm", {"reg": 0.0}, 1,
                              lambda td, p: models.linear_svm(td.label, reg=p["reg"]), **kw)


def boosted_regression_search(spark: SparkSession, sf: str) -> DataFrame:
    """Squared error over category codes, 10% of train held out, patience of 5 trees."""
    return _boosted(spark, sf, "boosted_regression", "regression", BOOSTED_REGRESSION_SPACE, EVALS["boosted_regression"], "partition")


def classification_comparison(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """Baseline, logistic, tree, forest, boosting and SVM on one
    split, one-hot + scaled features, all runs in one table. Families that read category
    codes share one frame of them; all are fitted side by side."""
    td = tr.prepare(spark, sf, "classification")
    codes = tr.prepare(spark, sf, "classification", enable_categorical=True)
    group = runlog.new_group()
    exp = "classification_comparison"
    _log(td, sf, exp, "baseline", [{"params": {}, "metrics": tr.baseline_metrics(td),
                                    "model_type": "baseline"}], group)
    kw = dict(td=td, run_group=group, experiment=exp)
    of_codes = dict(kw, codes=codes)
    with ThreadPoolExecutor(max_workers=FAMILIES_AT_ONCE) as pool:
        fits = [pool.submit(svm_fit, spark, sf, **kw)]
        fits += [pool.submit(f, spark, sf, **of_codes) for f in (logistic_search, gradient_boosting_search, forest_search, decision_tree_fit)]
        for f in fits:
            f.result()
    codes.release()
    td.release()
    return runlog.read_runs(spark, run_group=group), group
