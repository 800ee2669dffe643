"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory. Every query reads the driver tables (the trips
view is a projection of ``events``) and runs over whole tables.

Float outputs are rounded to 6 decimals so that results compare across
engines; model-fit queries return parameters and metrics, not raw scores.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.functions import scalar as S
from larch.operators import (evaluate, features as fe, models, reduce as rd, split,
                             targets)
from larch.plans import training as tr
from larch.session import unique_path
from larch.sources import trips as ts

R = 6  # rounding digits of float outputs


def _round(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), R) for c in cols})


def _float_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]


def _rounded(df: DataFrame) -> DataFrame:
    return _round(df, _float_cols(df))


def _pair_counts(spark, sf):
    return rd.pair_counts(rd.with_pair(ts.trips(spark, sf)))


# ---- scans, reduction (S1-S3, A1-A4, A10, J1, D1) ------------------------

def trip_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The trip table, timestamps as epoch microseconds."""
    t = ts.trips(spark, sf)
    return t.select(
        "trip_id", ts.epoch_micros("lpep_pickup_datetime").alias("pickup_us"),
        ts.epoch_micros("lpep_dropoff_datetime").alias("dropoff_us"),
        *[c for c in ts.TRIP_COLUMNS if c not in ("trip_id", "lpep_pickup_datetime",
                                                    "lpep_dropoff_datetime")],
        "year_month")


def month_summary(spark, sf):
    """All months in one scan, one row per month."""
    t = rd.with_pair(ts.trips(spark, sf))
    return t.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("trips"),
        F.countDistinct("PU_DO").alias("distinct_pairs"),
        F.min(ts.epoch_micros("lpep_pickup_datetime")).alias("first_pickup_us"),
        F.max(ts.epoch_micros("lpep_pickup_datetime")).alias("last_pickup_us"))


def pair_counts(spark, sf):
    """A1."""
    return _pair_counts(spark, sf)


def frequent_pair_trips(spark, sf):
    """A2 + J1 + A3: trips of pairs seen more than 10 times in their month."""
    red = rd.reduce_trips(ts.trips(spark, sf))
    return red.select("trip_id", "year_month", "PULocationID", "DOLocationID")


def reduction_report(spark, sf):
    """A4."""
    return rd.reduction_report(_pair_counts(spark, sf))


def top_pairs(spark, sf):
    """A10: top 5 pairs per month."""
    return rd.top_pairs(_pair_counts(spark, sf)).withColumn("rank", F.col("rank").cast("long"))


def reduced_sink_roundtrip(spark, sf):
    """S3: reduced trips written one directory per month, read back."""
    path = unique_path(spark, "reduced_trips")
    red = rd.reduce_trips(ts.trips(spark, sf))
    rd.write_reduced(red.select("trip_id", "PULocationID", "DOLocationID", "fare_amount",
                                "year_month"), path)
    back = rd.read_reduced(spark, path)
    return back.select("trip_id", F.col("year_month").cast("string").alias("year_month"),
                       "PULocationID", "DOLocationID", "fare_amount")


def sampled_trips(spark, sf):
    """Key-hash sample (half of the reduced trips)."""
    red = rd.reduce_trips(ts.trips(spark, sf), fraction=0.5)
    return red.select("trip_id", "year_month")


def sample_then_split(spark, sf):
    """D1 followed by D2: rows of each side of the split in a 30% sample. The
    two hashes are independent, so the sample keeps the split's share."""
    red = rd.reduce_trips(ts.trips(spark, sf), fraction=0.3)
    return split.with_split(red.select("trip_id")).groupBy("is_test").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("trip_id").alias("key_sum"))


def validation_share(spark, sf):
    """Rows of each side, and those held out for early stopping."""
    raw = split.with_validation(tr.raw_task_frame(spark, sf, "classification"))
    return raw.groupBy("is_test").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("is_valid").cast("long")).alias("valid_rows"))


# ---- targets and raw features (P2-P11, F1-F6) ----------------------------

def duration_target(spark, sf):
    """P3 + P4 on reduced trips."""
    rows = targets.task_frame(rd.reduce_trips(ts.trips(spark, sf)), "regression")
    return _round(rows.select("trip_id", "duration"), ["duration"])


def tipped_target(spark, sf):
    """P5 + P6 + P7 on reduced trips."""
    rows = targets.task_frame(rd.reduce_trips(ts.trips(spark, sf)), "classification")
    return rows.select("trip_id", "tipped", F.lit("tip_amount" in rows.columns).alias("has_tip"))


def regression_columns(spark, sf):
    """P10 + F1-F6: raw regression features and label."""
    return _rounded(tr.raw_task_frame(spark, sf, "regression").drop("is_test"))


def classification_columns(spark, sf):
    """P11 + F1-F6: raw classification features and label."""
    return _rounded(tr.raw_task_frame(spark, sf, "classification").drop("is_test"))


def split_assignment(spark, sf):
    """Key-hash 70/30 split of the regression rows."""
    return tr.raw_task_frame(spark, sf, "regression").select("trip_id", "is_test")


# ---- imputation, scaling, encoding (A5, A6, E1-E6) -----------------------

def _fill_stats(spark, sf, task):
    raw = tr.raw_task_frame(spark, sf, task)
    num, cat = targets.feature_lists(task)
    return _rounded(fe.fill_statistics(raw, num, cat, ["is_test"]))


def regression_fill_statistics(spark, sf):
    """A5 + A6 per split side (each side's own statistics, as the original)."""
    return _fill_stats(spark, sf, "regression")


def classification_fill_statistics(spark, sf):
    return _fill_stats(spark, sf, "classification")


def imputed_regression_features(spark, sf):
    """Both sides filled from train statistics."""
    raw = tr.raw_task_frame(spark, sf, "regression")
    num, cat = targets.feature_lists("regression")
    model = fe.MeanModeImputer(numericCols=num, categoricalCols=cat).fit(raw.filter(~F.col("is_test")))
    return _rounded(model.transform(raw).select("trip_id", "is_test", *num, *cat))


def imputed_within_sides(spark, sf):
    """E1, original behavior: each side filled from its own statistics."""
    raw = tr.raw_task_frame(spark, sf, "classification")
    num, cat = targets.feature_lists("classification")
    return _rounded(fe.impute_within_groups(raw, num, cat, "is_test")
                    .select("trip_id", "is_test", *num, *cat))


def scaled_classification_features(spark, sf):
    """E6 after E1: numeric columns standardized with train mean and
    population std."""
    raw = tr.raw_task_frame(spark, sf, "classification")
    num, cat = targets.feature_lists("classification")
    train = raw.filter(~F.col("is_test"))
    imp = fe.MeanModeImputer(numericCols=num, categoricalCols=cat).fit(train)
    filled = imp.transform(raw)
    scaler = fe.PopulationScaler(numericCols=num).fit(filled.filter(~F.col("is_test")))
    return _rounded(scaler.transform(filled).select("trip_id", "is_test", *num))


def onehot_slots(spark, sf):
    """The active one-hot slot of each row (NULL = all zeros)
    under the encoder fitted on train, without and with drop-first."""
    raw = tr.raw_task_frame(spark, sf, "regression")
    num, cat = targets.feature_lists("regression")
    train = raw.filter(~F.col("is_test"))
    filled = fe.MeanModeImputer(numericCols=num, categoricalCols=cat).fit(train).transform(raw)
    enc = fe.OneHot(categoricalCols=cat).fit(filled.filter(~F.col("is_test")))
    out = enc.transform(filled)
    sizes = fe.category_sizes(enc)
    cols = []
    for c, n in zip(cat, sizes):
        idx = F.col(c + "_idx").cast("long")
        cols.append(F.when(idx < n, idx).alias(f"{c}_slot"))
        cols.append(F.when((idx >= 1) & (idx < n), idx - 1).alias(f"{c}_slot_drop_first"))
        cols.append(F.lit(n).cast("long").alias(f"{c}_width"))
    return out.select("trip_id", "is_test", *cols)


def category_codes(spark, sf):
    """E5: sorted category codes fitted on train; unseen -> N."""
    raw = tr.raw_task_frame(spark, sf, "classification")
    num, cat = targets.feature_lists("classification")
    train = raw.filter(~F.col("is_test"))
    filled = fe.MeanModeImputer(numericCols=num, categoricalCols=cat).fit(train).transform(raw)
    model = fe.indexer(cat).fit(filled.filter(~F.col("is_test")))
    return model.transform(filled).select(
        "trip_id", *[F.col(c + "_code").cast("long").alias(c + "_code") for c in cat])


# ---- baselines and evaluation (M1, M2, V1-V9, F7, F9) --------------------

def regression_baseline(spark, sf):
    """M1 + V8: train-mean prediction, rmse/mae of both sides."""
    raw = tr.raw_task_frame(spark, sf, "regression").select("trip_id", "is_test", "duration")
    mean = models.regression_baseline(raw.filter(~F.col("is_test")), "duration")
    return _rounded(evaluate.regression_report(models.predict_constant(raw, mean), "duration"))


def classification_baseline(spark, sf):
    """M2 + V9: train-mode prediction, 10 metrics."""
    raw = tr.raw_task_frame(spark, sf, "classification").select("trip_id", "is_test", "tipped")
    cls = models.classification_baseline(raw.filter(~F.col("is_test")), "tipped")
    pred = models.predict_class_constant(raw, cls)
    return _rounded(evaluate.classification_report(pred, "tipped", p1="p1", predicted="prediction"))


def fare_score_auc(spark, sf):
    """V7: exact ROC AUC (ties half) of the raw fare as a tip score, per side."""
    raw = tr.raw_task_frame(spark, sf, "classification")
    return _rounded(evaluate.roc_auc(raw, "tipped", "fare_amount", ["is_test"]))


def threshold_report(spark, sf):
    """V9 + F9: metrics of a probability with threshold 0.5 on P(0).
    The probability is the share of tipped trips of the pair on train
    (a frequency score), so the report exercises thresholding and AUC."""
    raw = tr.raw_task_frame(spark, sf, "classification")
    train = raw.filter(~F.col("is_test"))
    rate = train.groupBy("PU_DO").agg(F.avg("tipped").alias("pair_rate")).persist()
    prior = train.agg(F.avg("tipped")).first()[0]
    scored = raw.join(rate, ["PU_DO"], "left").withColumn(
        "p1", F.coalesce(F.col("pair_rate"), F.lit(prior)))
    out = _rounded(evaluate.classification_report(scored, "tipped", p1="p1", threshold=0.5))
    rate.unpersist()
    return out


# ---- linear models with closed forms (M3-M6, SQL*) -----------------------

def _one_feature_fit(spark, sf, kind, feature, alpha=0.0, l1_ratio=0.5):
    from pyspark.ml.feature import VectorAssembler
    raw = tr.raw_task_frame(spark, sf, "regression").filter(F.col(feature).isNotNull())
    d = VectorAssembler(inputCols=[feature], outputCol="features").transform(raw)
    train = d.filter(~F.col("is_test"))
    stats = models.label_stats(train, "duration")
    est = models.linear_regression(kind, stats, "duration", alpha=alpha, l1_ratio=l1_ratio)
    m = est.fit(train)
    pred = m.transform(d)
    rep = evaluate.regression_report(pred, "duration")
    return _rounded(rep.select(F.lit(float(m.intercept)).alias("intercept"),
                               F.lit(float(m.coefficients[0])).alias("coefficient"), "*"))


def ols_one_feature(spark, sf):
    """M3: duration ~ pickup hour, with intercept; metrics of both sides."""
    return _one_feature_fit(spark, sf, "ols", "lpep_pickup_datetime_hour")


def ridge_one_feature(spark, sf):
    """M4 with alpha = 1 (penalty mapping of ``||r||^2 + alpha ||w||^2``)."""
    return _one_feature_fit(spark, sf, "ridge", "passenger_count", 1.0)


def lasso_one_feature(spark, sf):
    """M5 with alpha = 0.05 on ``1/(2n)||r||^2 + alpha |w|``."""
    return _one_feature_fit(spark, sf, "lasso", "passenger_count", 0.05)


def elastic_net_one_feature(spark, sf):
    """M6 with alpha = 0.05, l1_ratio = 0.5."""
    return _one_feature_fit(spark, sf, "elastic_net", "passenger_count", 0.05, 0.5)


def lineitem_price_ols(spark, sf):
    """M3 at bench size: extended price ~ quantity over all lineitem rows
    (l-bfgs)."""
    from pyspark.ml.feature import VectorAssembler
    li = ts.read_table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    d = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li)
    stats = models.label_stats(d, "l_extendedprice")
    m = models.linear_regression("ols", stats, "l_extendedprice").fit(d)
    s = m.summary
    return _rounded(spark.createDataFrame(
        [(float(m.intercept), float(m.coefficients[0]), float(s.rootMeanSquaredError),
          int(s.numInstances))], "intercept double, coefficient double, rmse double, n long"))


def ridge_one_feature_search(spark, sf):
    """H1-H3, H11 with a closed form: the ridge search's seeded penalties on
    duration ~ passenger count; metrics and rank (by test rmse) of each."""
    from larch.operators import linear, penalized, search
    from larch.plans import experiments as ex
    feature = ["passenger_count"]
    raw = tr.raw_task_frame(spark, sf, "regression").filter(F.col(feature[0]).isNotNull()).select(
        "trip_id", "is_test", "duration", *feature).persist(StorageLevel.MEMORY_AND_DISK)
    alphas = [c["alpha"] for c in search.sample(ex.RIDGE_SPACE, ex.EVALS["ridge"], ex.SEED)]
    d = penalized.design(raw.filter(~F.col("is_test")), feature, [], "duration")
    found = penalized.fit(d, [penalized.ridge_penalty(a) for a in alphas])
    fits = [(float(b), w) for b, w in zip(found.intercepts, found.narrow)]
    scored = linear.predictions(raw, found)
    metrics = evaluate.regression_reports(scored, "duration", [f"pred_{j}" for j in range(len(fits))])
    raw.unpersist()
    from larch.sources import runs as runlog
    group = runlog.new_group()
    path = unique_path(spark, "one_feature_runs")
    for j, a in enumerate(alphas):  # a log call per run, as runs end one by one
        runlog.log_runs(spark, [runlog.run_row("ridge_one_feature", "ridge", {"candidate": j, "alpha": a}, {
            **metrics[j], "intercept": fits[j][0], "coefficient": float(fits[j][1][0])}, run_group=group)], path)
    runs = runlog.read_runs(spark, path, run_group=group)
    board = runlog.leaderboard(runs, "rmse_test", False)
    best = runlog.winner(runs, "rmse_test", False).select(F.col("run_id").alias("best_id"))
    m = {c: F.col("metrics")[c] for c in ("intercept", "coefficient", "rmse_train")}
    return _rounded(board.join(best, F.col("run_id") == F.col("best_id"), "left").select(
        F.col("params")["candidate"].cast("long").alias("candidate"), F.col("params")["alpha"].cast("double").alias("alpha"),
        *[c.alias(n) for n, c in m.items()], "rmse_test", F.col("rank").cast("long").alias("rank"), F.col("best_id").isNotNull().alias("wins")))


def search_candidates(spark, sf):
    """H1: all four priors as a table of seeded draws, 20 candidates per trip month."""
    from larch.operators import search
    space = {"alpha": search.lognormal(-1, 0.5), "eta": search.uniform(0.5, 2), "max_depth": search.choice(1, 2, 3, 4),
             "leaf_depth": search.quniform(3, 5, 1)}
    months = ts.trips(spark, sf).select("year_month").distinct()
    rows = months.select("year_month", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(19).cast("long"))).alias("candidate"))
    return _rounded(rows.select("year_month", "candidate", *search.candidate_columns(space, 123)))


def logistic_one_flag(spark, sf):
    """M7 with a closed form: logistic regression of the tip on the stored-trip flag
    with next to no penalty (C = 1e9); the coefficients are log odds (4 decimals)."""
    from pyspark.ml.feature import VectorAssembler
    raw = tr.raw_task_frame(spark, sf, "classification").filter(~F.col("is_test") & F.col("store_and_fwd_flag").isNotNull())
    flag = raw.select("tipped", (F.col("store_and_fwd_flag") == "Y").cast("double").alias("flag"))
    d = VectorAssembler(inputCols=["flag"], outputCol="features").transform(flag)
    m = models.logistic_regression(1e9, d.count(), "tipped", max_iter=500, tol=1e-12).fit(d)
    return spark.createDataFrame([(round(m.intercept, 4), round(float(m.coefficients[0]), 4))], "intercept double, coefficient double")


def elastic_net_path_alphas(spark, sf):
    """H7 grid: the penalty of every path step and its -log10."""
    from larch.plans import paths as P
    return _rounded(P.elastic_net_path_alphas(spark, sf))


# ---- folds and growing subsets (D3, D4) ----------------------------------

LC_FOLDS = 10
LC_FRACTIONS = [round(0.1 * i, 1) for i in range(1, 11)]


def stratified_folds(spark, sf):
    """D3: 10 stratified folds of the classification train rows."""
    raw = tr.raw_task_frame(spark, sf, "classification").filter(~F.col("is_test"))
    return split.with_stratified_folds(raw.select("trip_id", "tipped"), "tipped", LC_FOLDS)


def fold_class_shares(spark, sf):
    """D3 check: rows per fold and class."""
    return stratified_folds(spark, sf).groupBy("fold", "tipped").agg(
        F.count(F.lit(1)).alias("rows"))


def learning_curve_subsets(spark, sf):
    """For each fold and train share 0.1..1.0 the nested train subset
    (first rows of the fold's train part in a second hash order):
    row count and key sum per subset."""
    folds = stratified_folds(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
    n = folds.count()
    ranked = split.with_fold_train_ranks(folds, LC_FOLDS, n_rows=n)
    n0 = folds.filter(F.col("fold") != 0).count()
    sizes = split.train_sizes(n0, LC_FRACTIONS)
    # each (row, fold it trains) lands in the first subset whose size exceeds
    # its rank; subset totals are running sums over the small (fold, size) table
    expanded = ranked.select("trip_id", "fold", F.posexplode("train_rank").alias("f", "r")) \
        .filter(F.col("fold") != F.col("f"))
    size_arr = F.array(*[F.lit(s) for s in sizes])
    first = F.size(F.filter(size_arr, lambda s: s <= F.col("r")))
    cells = expanded.filter(F.col("r") < F.lit(sizes[-1])).groupBy(
        F.col("f").cast("long").alias("fold"), first.alias("j")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("trip_id").alias("ks"))
    grid = ranked.sparkSession.createDataFrame(
        [(f, j, s) for f in range(LC_FOLDS) for j, s in enumerate(sizes)],
        "fold long, j int, train_size long")
    from pyspark.sql import Window
    w = Window.partitionBy("fold").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    per = grid.join(cells, ["fold", "j"], "left").withColumn(
        "rows", F.coalesce(F.sum("n").over(w), F.lit(0)).cast("long")).withColumn(
        "key_sum", F.coalesce(F.sum("ks").over(w), F.lit(0)).cast("long"))
    return per.select("fold", "train_size", "rows", "key_sum")


# ---- searches, comparisons, leaderboards (H1-H4, H9-H11, M7-M14) ---------

def _exp():
    from larch.plans import experiments
    return experiments


def ridge_search(spark, sf):
    """M4 + H2: 5 ridge fits, alpha ~ lognormal(0, 1)."""
    return _exp().linear_search(spark, sf, "ridge")


def lasso_search(spark, sf):
    """M5 + H2: 5 lasso fits."""
    return _exp().linear_search(spark, sf, "lasso")


def elastic_net_search(spark, sf):
    """M6 + H2: 10 elastic-net fits, l1_ratio ~ uniform(0, 1)."""
    return _exp().linear_search(spark, sf, "elastic_net")


def logistic_search(spark, sf):
    """M7 + H2: 5 logistic fits, C ~ lognormal(-1, 0.5), 250 iterations."""
    return _exp().logistic_search(spark, sf)


def boosted_trees_categorical_search(spark, sf):
    """M8 + H2: 3 boosted-tree fits (100 trees) over category codes."""
    return _exp().boosted_search(spark, sf, True)


def boosted_trees_onehot_search(spark, sf):
    """M9 + H2: 3 boosted-tree fits (100 trees) over one-hot features."""
    return _exp().boosted_search(spark, sf, False)


def random_forest_search(spark, sf):
    """M12 + H2."""
    return _exp().forest_search(spark, sf)


def gradient_boosting_search(spark, sf):
    """M13 + H2 with a validation share for early stopping."""
    return _exp().gradient_boosting_search(spark, sf)


def decision_tree_fit(spark, sf):
    """M11."""
    return _exp().decision_tree_fit(spark, sf)


def linear_svm_fit(spark, sf):
    """M14."""
    return _exp().svm_fit(spark, sf)


def boosted_regression_search(spark, sf):
    """M10 + H2."""
    return _exp().boosted_regression_search(spark, sf)


def _board(runs: DataFrame, metric: str, maximize: bool) -> DataFrame:
    from larch.sources import runs as runlog
    b = runlog.leaderboard(runs, metric, maximize)
    return b.select("experiment", "model_type", F.col("rank").cast("long").alias("rank"),
                    F.col(metric), F.to_json("params").alias("params"))


def regression_leaderboard(spark, sf):
    """H9 + S4 + H11: baseline, OLS, ridge, lasso, elastic net runs in one
    run table, ranked by test rmse."""
    runs, _ = _exp().regression_comparison(spark, sf)
    return _board(runs, "rmse_test", False)


def classification_leaderboard(spark, sf):
    """H10 + S4 + H11: five classifier families and the baseline, ranked by
    test AUC."""
    runs, _ = _exp().classification_comparison(spark, sf)
    return _board(runs, "roc_auc_test", True)


def logistic_refit(spark, sf):
    """H3 + H4: best C of the search, refit, metrics."""
    from larch.plans import curves
    return curves.logistic_refit(spark, sf)


def logistic_learning_curve(spark, sf):
    """H8 + A9: 10 folds x 10 train shares of the best logistic model."""
    from larch.plans import curves
    return curves.logistic_learning_curve(spark, sf)


def boosted_learning_curve(spark, sf):
    """H8 + A9 for boosted trees over one-hot features."""
    from larch.plans import curves
    return curves.boosted_learning_curve(spark, sf)


# ---- paths (H5-H7, F8) ---------------------------------------------------

def ridge_path(spark, sf):
    from larch.plans import paths
    return paths.ridge_path(spark, sf)


def lasso_path(spark, sf):
    from larch.plans import paths
    return paths.lasso_path(spark, sf)


def elastic_net_path(spark, sf):
    from larch.plans import paths
    return paths.elastic_net_path(spark, sf)


def lasso_path_alphas(spark, sf):
    from larch.plans import paths
    return _rounded(paths.lasso_path_alphas(spark, sf))


def path_optimality(spark, sf):
    """H5-H7: every fit of the three paths against its optimality conditions, from the rows."""
    from larch.plans import paths
    return paths.path_optimality(spark, sf)


def lasso_path_summary(spark, sf):
    """H6 per step: non-zero count and L1 norm (zero at the first step)."""
    from larch.plans import paths
    return paths.path_summary(paths.lasso_path(spark, sf))


# ---- unsupervised, scoring (M15, M16, S5-S7) -----------------------------

def kmeans_clusters(spark, sf):
    from larch.plans import unsupervised as U
    return U.kmeans_clusters(spark, sf)


def kmeans_assign_label_centers(spark, sf):
    from larch.plans import unsupervised as U
    return U.kmeans_assign_label_centers(spark, sf)


def pca_components(spark, sf):
    from larch.plans import unsupervised as U
    return U.pca_components(spark, sf)


def pca_projection_summary(spark, sf):
    from larch.plans import unsupervised as U
    return U.pca_projection_summary(spark, sf)


def embedding_covariance(spark, sf):
    from larch.plans import unsupervised as U
    return _rounded(U.embedding_covariance(spark, sf))


def saved_model_scoring(spark, sf):
    """S5 + S6 + S7: fit, save the pipeline, reload, score label-free trips."""
    from larch.plans import scoring
    return scoring.score_month(spark, sf)


def streaming_scoring(spark, sf):
    """S7 on a stream: the saved pipeline scores the events files."""
    from larch.streaming import scoring as ss
    return ss.stream_score_month(spark, sf)


# ---- second binary task: documents (M2, M7, V7) --------------------------

def document_quality_baseline(spark, sf):
    from larch.plans import documents
    return _rounded(documents.quality_baseline(spark, sf))


def document_length_auc(spark, sf):
    from larch.plans import documents
    return _rounded(documents.length_auc(spark, sf))


def document_quality_logistic(spark, sf):
    from larch.plans import documents
    return documents.quality_logistic(spark, sf)


# ---- closed-form checks of a tree, scoring and the row guard -------------

def decision_stump(spark, sf):
    """M11 at depth 1 on the fare band floor(fare / 10) (few values, so
    every midpoint is a candidate split): chosen threshold, Gini gain, leaf
    predictions. MLlib prunes a split whose leaves predict the same class."""
    from pyspark.ml.feature import VectorAssembler
    raw = tr.raw_task_frame(spark, sf, "classification").filter(~F.col("is_test")) \
        .withColumn("fare_band", F.floor(F.col("fare_amount") / 10).cast("double"))
    d = VectorAssembler(inputCols=["fare_band"], outputCol="features").transform(raw)
    m = models.decision_tree("tipped", max_depth=1, max_bins=32).fit(d)
    node = m._call_java("rootNode")
    if node.getClass().getSimpleName() != "InternalNode":
        return spark.createDataFrame([], "threshold double, gain double, left_class long, right_class long")
    thr = float(node.split().threshold())
    gain = float(node.gain())
    left = int(node.leftChild().prediction())
    right = int(node.rightChild().prediction())
    return _rounded(spark.createDataFrame(
        [(thr, gain, left, right)],
        "threshold double, gain double, left_class long, right_class long"))


def saved_ols_scoring(spark, sf):
    """S5-S7 with a closed form: OLS duration ~ hour fitted on the train
    side, saved as a pipeline, reloaded, and applied to every trip of the
    month without its label."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from larch.plans import scoring
    from larch.sources import runs as runlog
    raw = tr.raw_task_frame(spark, sf, "regression").filter(~F.col("is_test"))
    stats = models.label_stats(raw, "duration")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["lpep_pickup_datetime_hour"],
                                            outputCol="features"),
                            models.linear_regression("ols", stats, "duration")])
    path = runlog.save_model(pipe.fit(raw), unique_path(spark, "models", "ols_hour"))
    rows = scoring.label_free_rows(ts.trips(spark, sf))
    return _rounded(scoring.score(PipelineModel.load(path), rows))


def monthly_files_summary(spark, sf):
    """S1 + S2: four monthly files in one scan, the month from the file's name."""
    from larch.plans import monthly
    return monthly.summary(spark, sf)


def next_month_scoring(spark, sf):
    """A ridge of the pairs fitted on three monthly files, saved, reloaded, and
    applied to the file of the next month, which has neither label nor all pairs."""
    from larch.plans import monthly
    return _rounded(monthly.next_month(spark, sf))


def boosted_one_round(spark, sf):
    """M8 with a closed form: one second-order tree of depth 1 (l2 = 1, eta = 1.5) of the
    tip on whether the fare is above 17.5; each side's leaf is -eta G / (H + l2)."""
    from larch.operators import boosting
    raw = tr.raw_task_frame(spark, sf, "classification").filter(~F.col("is_test") & F.col("fare_amount").isNotNull())
    flag = raw.select("tipped", F.when(F.col("fare_amount") > 17.5, 1.0).otherwise(0.0).alias("flag"))
    rows, columns = boosting.binned_rows(flag, [], ["flag"], [2], "tipped")
    fits = boosting.fit(rows, columns, [boosting.Booster(1, 1, 1.5)])
    tree = fits.trees[0][0]
    import numpy as np
    margins = tree.margin(columns.bins(np.array([[0.0], [1.0]])), columns.first)
    return _rounded(spark.createDataFrame([(False, float(margins[0])), (True, float(margins[1]))], "above boolean, leaf double"))


def boosted_patience(spark, sf):
    """M13 + early stopping: with a tenth of the train side held out and a patience of 5,
    whether the model ends at the least validation loss, and stopped as soon as 5 more
    trees had not lowered it."""
    from larch.operators import boosting
    from larch.plans import experiments as ex
    td = tr.prepare(spark, sf, "classification", enable_categorical=True)
    num, _ = targets.feature_lists("classification")
    held = split.with_validation(td.train, 0.1)
    rows, columns = boosting.vector_rows(held, "features", len(num), ex.code_sizes(td), td.label, valid="is_valid")
    booster = boosting.Booster(40, 3, 1.0, patience=5)
    fits = boosting.fit(rows, columns, [booster])
    n = held.groupBy().agg(F.sum(F.col("is_valid").cast("long")).alias("v")).first()["v"]
    td.release()
    rows.unpersist()
    losses, kept = fits.losses[0], len(fits.trees[0])
    best = min(range(len(losses)), key=lambda i: losses[i]) + 1
    grown = len(losses)
    return spark.createDataFrame([(int(n), bool(kept == best), bool(grown == 40 or grown == best + 5), bool(losses[best - 1] <= losses[0]))],
                                 "valid_rows long, kept_best boolean, stopped_in_time boolean, not_worse boolean")


def feature_row_guard(spark, sf):
    """Rows before and after the feature pipeline, per task and side."""
    out = None
    for task in ("regression", "classification"):
        raw = tr.raw_task_frame(spark, sf, task)
        td = tr.prepare(spark, sf, task)
        before = raw.groupBy("is_test").agg(F.count(F.lit(1)).alias("rows_before"))
        after = td.frame.groupBy("is_test").agg(F.count(F.lit(1)).alias("rows_after"))
        part = before.join(after, "is_test").withColumn("task", F.lit(task))
        out = part if out is None else out.unionByName(part)
    return out
