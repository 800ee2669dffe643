"""Coefficient paths of the regression design (H5-H7, F8)."""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from larch.functions.scalar import neg_log10
from larch.operators import features as fe, linear as lin, penalized, targets
from larch.plans import training as tr

SEED = 123
# Path lengths and priors of the original notebooks.
RIDGE_PATH_ALPHAS = 10
RIDGE_PATH_PRIOR = (0.0, 0.5)   # lognormal(mu, sigma)
LASSO_PATH_ALPHAS = 30
ENET_PATH_ALPHAS = 30
ENET_PATH_L1_RATIO = 0.5
PATH_EPS = 1e-3


def train_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The train side with imputed columns (train statistics)."""
    raw = tr.raw_task_frame(spark, sf, "regression")
    num, cat = targets.feature_lists("regression")
    train = raw.filter(~F.col("is_test"))
    return fe.MeanModeImputer(numericCols=num, categoricalCols=cat).fit(train).transform(train)


def regression_design(rows: DataFrame) -> penalized.Design:
    """Imputed numeric columns + one-hot of the categorical columns (no drop)."""
    num, cat = targets.feature_lists("regression")
    return penalized.design(rows, num, cat, "duration")


def _long_table(fits: penalized.Fits, alphas, with_intercept: bool) -> DataFrame:
    """(alpha_idx, alpha, feature, coefficient): numeric columns and small categorical
    columns from the driver, the wide column's from its table."""
    spark, d = fits.design.groups.sparkSession, fits.design
    rows = [(n, [float(x) for x in fits.narrow[:, i]]) for i, n in enumerate(d.names)]
    if with_intercept:
        rows.append(("intercept", [float(x) for x in fits.intercepts]))
    table = spark.createDataFrame(rows, "feature string, coefficients array<double>").unionByName(
        fits.wide.select(F.concat(F.lit(f"{d.wide}="), "value").alias("feature"), "coefficients"))
    grid = F.array(*[F.lit(float(a)) for a in alphas])
    long = table.select("feature", F.posexplode("coefficients").alias("i", "coefficient"))
    return long.select(F.col("i").cast("long").alias("alpha_idx"), grid[F.col("i")].alias("alpha"), "feature", "coefficient").withColumn(
        "neg_log10_alpha", neg_log10("alpha"))


def ridge_alphas() -> np.ndarray:
    return np.random.default_rng(SEED).lognormal(*RIDGE_PATH_PRIOR, RIDGE_PATH_ALPHAS)


def _ridge(d: penalized.Design, alphas) -> penalized.Fits:
    return penalized.fit(d, [penalized.ridge_penalty(a) for a in alphas])


def _enet(d: penalized.Design, alphas, l1_ratio: float) -> penalized.Fits:
    return penalized.fit(d, [penalized.enet_penalty(a, l1_ratio, d.n) for a in alphas], intercept=False)


# ---- registered paths ----------------------------------------------------

def ridge_path(spark: SparkSession, sf: str) -> DataFrame:
    """H5: 10 lognormal(0, 0.5) penalties, with intercept."""
    alphas = ridge_alphas()
    return _long_table(_ridge(regression_design(train_rows(spark, sf)), alphas), alphas, True)


def _l1_path(spark: SparkSession, sf: str, l1_ratio: float, n: int) -> DataFrame:
    d = regression_design(train_rows(spark, sf))
    alphas = penalized.alpha_grid(d, l1_ratio, n, PATH_EPS)
    return _long_table(_enet(d, alphas, l1_ratio), alphas, False)


def lasso_path(spark: SparkSession, sf: str) -> DataFrame:
    """H6: 30 penalties down from the all-zero one, no intercept."""
    return _l1_path(spark, sf, 1.0, LASSO_PATH_ALPHAS)


def elastic_net_path(spark: SparkSession, sf: str) -> DataFrame:
    """H7: as H6 with l1_ratio 0.5."""
    return _l1_path(spark, sf, ENET_PATH_L1_RATIO, ENET_PATH_ALPHAS)


def optimality(rows: DataFrame, fits: penalized.Fits, penalties: list[penalized.Penalty], label: str, intercept: bool) -> DataFrame:
    """(alpha_idx, breach): how far the worst column of each fit is from its optimality
    condition, beside the label's total. Computed from the rows: predictions, residuals,
    and one sum per column and penalty, apart from the solver."""
    d, k = fits.design, len(penalties)
    cats = [*d.others, d.wide]
    rows = lin.prediction_rows(rows, fits, [label, *d.numeric, *[F.col(c).cast("string").alias(c) for c in cats]])
    left = F.col(label) - F.col("prediction")
    # one sum per penalty and column: of numeric columns, and of each value of the others
    sums = rows.groupingSets([["fit"], *[["fit", c] for c in cats]], "fit", *cats).agg(
        F.sum(left).alias("one"), F.sum(F.abs(label)).alias("size"), *[F.sum(F.col(c) * left).alias(f"g{i}") for i, c in enumerate(d.numeric)],
        *[F.grouping(c).alias(f"no{i}") for i, c in enumerate(cats)])
    sums = sums.persist(StorageLevel.MEMORY_AND_DISK)
    spark = sums.sparkSession
    total = sums.where(" AND ".join(f"no{i} = 1" for i in range(len(cats))))
    columns = [("one", fits.intercepts, False)] * intercept + [(f"g{i}", fits.narrow[:, i], True) for i in range(len(d.numeric))]
    weights = [(j, float(w[j]), c, bool(held)) for c, w, held in columns for j in range(k)]
    own = spark.createDataFrame(weights, "fit int, w double, name string, held boolean")
    by_column = total.select("fit", F.explode(F.create_map(*[x for c, _, _ in columns for x in (F.lit(c), F.col(c))])).alias("name", "g"))
    parts = [by_column.join(own, ["fit", "name"]).select("fit", "g", "w", "held")]
    for i, c in enumerate(cats):
        table = fits.wide.select("value", F.posexplode("coefficients").alias("fit", "w")) if c == d.wide else spark.createDataFrame(
            [(v, j, float(fits.narrow[j, len(d.numeric) + x])) for x, (o, v) in enumerate(d.slots) if o == c for j in range(k)],
            "value string, fit int, w double")
        of = sums.where(" AND ".join(f"no{j} = {int(j != i)}" for j in range(len(cats))))
        parts.append(of.select("fit", F.col(c).alias("value"), F.col("one").alias("g")).join(table, ["value", "fit"]).select("fit", "g", "w", F.lit(True).alias("held")))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    l1, l2 = (F.array(*[F.lit(float(getattr(p, x))) for p in penalties])[F.col("fit")] for x in ("l1", "l2"))
    g, w = F.col("g"), F.col("w")
    breach = F.when(~F.col("held"), F.abs(g)).when(w == 0, F.greatest(F.abs(g) - l1, F.lit(0.0))).otherwise(F.abs(g - l2 * w - l1 * F.signum(w)))
    worst = found.groupBy("fit").agg(F.max(breach).alias("breach"))
    return worst.join(total.select("fit", "size"), "fit").select(F.col("fit").cast("long").alias("alpha_idx"), (F.col("breach") / F.col("size")).alias("breach"))


#: A path's fits may be this far from optimal, beside the label's total.
OPTIMAL = 1e-9


def path_optimality(spark: SparkSession, sf: str) -> DataFrame:
    """H5-H7: whether every fit of the three paths meets its optimality conditions."""
    rows = train_rows(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
    d = regression_design(rows)
    out = []
    for name, ratio, n in (("ridge", None, RIDGE_PATH_ALPHAS), ("lasso", 1.0, LASSO_PATH_ALPHAS), ("elastic_net", ENET_PATH_L1_RATIO, ENET_PATH_ALPHAS)):
        alphas = ridge_alphas() if ratio is None else penalized.alpha_grid(d, ratio, n, PATH_EPS)
        fits = _ridge(d, alphas) if ratio is None else _enet(d, alphas, ratio)
        penalties = [penalized.ridge_penalty(a) if ratio is None else penalized.enet_penalty(a, ratio, d.n) for a in alphas]
        rest = optimality(rows, fits, penalties, "duration", ratio is None)
        out += [(name, r["alpha_idx"], r["breach"] <= OPTIMAL) for r in rest.collect()]  # a row per penalty
    d.release()
    rows.unpersist()
    return spark.createDataFrame(out, "path string, alpha_idx long, optimal boolean")


def path_summary(path: DataFrame) -> DataFrame:
    """Per penalty: number of non-zero coefficients and the L1 norm."""
    return path.filter(F.col("feature") != "intercept").groupBy(
        "alpha_idx", "alpha", "neg_log10_alpha").agg(
        F.sum((F.abs("coefficient") > 1e-12).cast("long")).alias("nonzero"),
        F.sum(F.abs("coefficient")).alias("l1_norm"))


def _alphas(spark: SparkSession, sf: str, l1_ratio: float, n: int) -> DataFrame:
    d = regression_design(train_rows(spark, sf))
    alphas = penalized.alpha_grid(d, l1_ratio, n, PATH_EPS)
    d.release()
    df = spark.createDataFrame([Row(alpha_idx=i, alpha=float(a)) for i, a in enumerate(alphas)],
                               "alpha_idx long, alpha double")
    return df.withColumn("neg_log10_alpha", neg_log10("alpha"))


def lasso_path_alphas(spark: SparkSession, sf: str) -> DataFrame:
    """H6 grid: the penalty of every path step and its -log10."""
    return _alphas(spark, sf, 1.0, LASSO_PATH_ALPHAS)


def elastic_net_path_alphas(spark: SparkSession, sf: str) -> DataFrame:
    """H7 grid."""
    return _alphas(spark, sf, ENET_PATH_L1_RATIO, ENET_PATH_ALPHAS)
