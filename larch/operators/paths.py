"""Regularization paths from sufficient statistics (H5-H7, F8).

A path is many fits of the same design at different penalties. Instead
of one distributed fit per penalty, the design's Gram matrix ``X'X``,
``X'y``, column sums and ``n`` are aggregated once on Spark, and every
penalty is solved on the d x d statistics. The design here is numeric
columns plus one-hot categories, so the Gram blocks are plain group-by
aggregates (JVM side, partial aggregation, skew-safe):

* numeric x numeric: one aggregate of products,
* numeric x category: per category sums of each numeric column,
* category x category: per category-pair counts,
* X'y: products with the label / per category label sums.

Their size depends on the number of features, not rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Gram:
    names: list[str]
    xtx: np.ndarray
    xty: np.ndarray
    col_sum: np.ndarray
    y_sum: float
    yty: float
    n: int
    categories: list[list[str]] | None = None


# A d x d Gram matrix lives on the driver: 16384^2 doubles are 2 GiB. A wider
# design is refused; fit it with ``models.linear_regression``, whose solver is
# distributed.
GRAM_MAX_FEATURES = 16_384


#: Every L1 solution stops when its largest coefficient step is this small
#: beside its largest coefficient, in searches and paths alike.
PATH_TOLERANCE = 1e-10


class GramTooLarge(ValueError):
    """The design is wider than :data:`GRAM_MAX_FEATURES`."""

    def __init__(self, width: int, limit: int):
        super().__init__(f"design width {width} exceeds the Gram bound {limit}")
        self.width = width
        self.limit = limit


def design_width(df: DataFrame, numeric: list[str], categorical: list[str],
                 categories: list[list[str]] | None, drop_first: bool = False) -> int:
    """Number of design columns; one small aggregate when the categories
    are not given (distinct non-null values per column)."""
    if categories is not None:
        counts = [len(c) for c in categories]
    elif categorical:
        r = df.agg(*[F.count_distinct(F.col(c)).alias(f"n{i}")
                     for i, c in enumerate(categorical)]).first()
        counts = [int(r[f"n{i}"]) for i in range(len(categorical))]
    else:
        counts = []
    return len(numeric) + sum(max(0, n - 1) if drop_first else n for n in counts)


def design_gram(df: DataFrame, numeric: list[str], categorical: list[str],
                categories: list[list[str]] | None, label: str,
                drop_first: bool = False, max_features: int | None = None) -> Gram:
    """Sufficient statistics of ``[numeric, one-hot(categorical)]`` and the
    label in ONE aggregate. ``categories[i]`` lists the one-hot slots of
    column i in order; other values (unseen, NULL) are all-zero rows, as in
    the encoder.

    The aggregate uses grouping sets: the empty set (numeric blocks), each
    categorical column (category x numeric, diagonal, X'y) and each pair of
    categorical columns (category x category counts). What reaches the
    driver is bounded by the Gram size, never by rows, and the width is
    checked against ``max_features`` before anything is collected."""
    limit = GRAM_MAX_FEATURES if max_features is None else max_features
    width = design_width(df, numeric, categorical, categories, drop_first)
    if width > limit:
        raise GramTooLarge(width, limit)
    y = F.col(label).cast("double")
    nn, nc = len(numeric), len(categorical)
    aggs = [F.count(F.lit(1)).alias("cnt"), F.sum(y).alias("ys"), F.sum(y * y).alias("yy")]
    pairs = [(i, j) for i in range(nn) for j in range(i, nn)]
    aggs += [F.sum(F.col(a)).alias(f"s{i}") for i, a in enumerate(numeric)]
    aggs += [F.sum(F.col(a) * y).alias(f"xy{i}") for i, a in enumerate(numeric)]
    aggs += [F.sum(F.col(numeric[i]) * F.col(numeric[j])).alias(f"g{i}_{j}") for i, j in pairs]
    keys = [f"k{i}" for i in range(nc)]
    if keys:
        keyed = df.select(*[F.col(c).cast("string").alias(k) for c, k in zip(categorical, keys)],
                          *numeric, F.col(label))
        sets = [[]] + [[k] for k in keys] + [[keys[i], keys[j]]
                                             for i in range(nc) for j in range(i + 1, nc)]
        cells = keyed.groupingSets(sets, *keys).agg(
            *aggs, *[F.grouping(k).alias(f"gr{i}") for i, k in enumerate(keys)]).toPandas()
        grouped = [cells[f"gr{i}"] == 0 for i in range(nc)]
    else:
        cells = df.agg(*aggs).toPandas()
        grouped = []
    cells = cells.fillna({c: 0.0 for c in cells.columns if not c.startswith("k")})
    n_grouped = sum(g.astype(int) for g in grouped) if grouped else None
    total = cells[n_grouped == 0] if grouped else cells
    if categories is None:
        # sorted distinct values seen in the data (the encoder's slot order)
        categories = [sorted(cells.loc[grouped[i] & (n_grouped == 1), f"k{i}"].dropna()
                             .unique().tolist()) for i in range(nc)]
    if drop_first:
        categories = [list(c)[1:] for c in categories]
    names = list(numeric)
    offsets = []
    off = nn
    for c, cats in zip(categorical, categories):
        offsets.append(off)
        names += [f"{c}={v}" for v in cats]
        off += len(cats)
    d = off

    xtx = np.zeros((d, d))
    xty = np.zeros(d)
    col_sum = np.zeros(d)
    for i in range(nn):
        col_sum[i] = total[f"s{i}"].sum()
        xty[i] = total[f"xy{i}"].sum()
    for i, j in pairs:
        xtx[i, j] = xtx[j, i] = total[f"g{i}_{j}"].sum()
    slot_cols = []
    for ci, cats in enumerate(categories):
        index = {str(v): offsets[ci] + j for j, v in enumerate(cats)}
        slot_cols.append(cells[f"k{ci}"].map(index))
    for ci in range(nc):
        sl = slot_cols[ci]
        single = grouped[ci] & (n_grouped == 1) & sl.notna()
        per = cells[single].groupby(sl[single].astype(int))[
            ["cnt", "ys"] + [f"s{i}" for i in range(nn)]].sum()
        k = per.index.to_numpy()
        xtx[k, k] = per["cnt"].to_numpy()
        col_sum[k] = per["cnt"].to_numpy()
        xty[k] = per["ys"].to_numpy()
        for i in range(nn):
            xtx[i, k] = xtx[k, i] = per[f"s{i}"].to_numpy()
        for cj in range(ci + 1, nc):
            sl2 = slot_cols[cj]
            both = grouped[ci] & grouped[cj] & (n_grouped == 2) & sl.notna() & sl2.notna()
            cross = cells[both].groupby([sl[both].astype(int), sl2[both].astype(int)])["cnt"].sum()
            a = cross.index.get_level_values(0).to_numpy()
            b = cross.index.get_level_values(1).to_numpy()
            xtx[a, b] = xtx[b, a] = cross.to_numpy()
    return Gram(names, xtx, xty, col_sum, float(total["ys"].sum()), float(total["yy"].sum()),
                int(total["cnt"].sum()), [list(c) for c in categories])


def ridge_coefficients(g: Gram, alpha: float) -> tuple[float, np.ndarray]:
    """Ridge with intercept: min ||y - b - Xw||^2 + alpha ||w||^2."""
    m = g.col_sum / g.n
    my = g.y_sum / g.n
    gc = g.xtx - g.n * np.outer(m, m)
    bc = g.xty - g.n * m * my
    w = np.linalg.solve(gc + alpha * np.eye(len(m)), bc)
    return float(my - m @ w), w


def centered(g: Gram) -> Gram:
    """The Gram of the column-centered design and label: penalized fits
    with an unpenalized intercept solve on it without an intercept."""
    m = g.col_sum / g.n
    my = g.y_sum / g.n
    return Gram(g.names, g.xtx - g.n * np.outer(m, m), g.xty - g.n * m * my,
                np.zeros_like(m), 0.0, g.yty - g.n * my * my, g.n, g.categories)


def enet_coefficients(g: Gram, alpha: float, l1_ratio: float,
                      tol: float = PATH_TOLERANCE) -> tuple[float, np.ndarray]:
    """Elastic net / lasso with intercept:
    ``1/(2n)||y - b - Xw||^2 + alpha r |w|_1 + alpha (1-r)/2 ||w||^2``."""
    w = enet_path(centered(g), np.array([alpha]), l1_ratio, tol=tol)[0]
    return float(g.y_sum / g.n - (g.col_sum / g.n) @ w), w


def alpha_grid(g: Gram, l1_ratio: float = 1.0, n_alphas: int = 30,
               eps: float = 1e-3) -> np.ndarray:
    """Geometric grid from the smallest penalty that zeroes every
    coefficient (no intercept), down by ``eps``."""
    a_max = np.max(np.abs(g.xty)) / (g.n * l1_ratio)
    return np.logspace(np.log10(a_max), np.log10(a_max * eps), n_alphas)


def enet_path(g: Gram, alphas: np.ndarray, l1_ratio: float = 1.0, tol: float = PATH_TOLERANCE,
              max_iter: int = 10_000) -> np.ndarray:
    """Coordinate descent on the Gram matrix, warm-started along the grid,
    for ``1/(2n)||y - Xw||^2 + a r |w|_1 + a (1-r)/2 ||w||^2`` (no intercept).
    Sweeps alternate between the active (non-zero) set and a full check.
    Returns coefficients, shape (len(alphas), d)."""
    d = len(g.xty)
    w = np.zeros(d)
    rho = g.xty.copy()            # X'y - X'X w
    diag = np.diag(g.xtx).copy()
    out = np.zeros((len(alphas), d))
    every = np.flatnonzero(diag > 0)

    def sweep(idx, l1, l2):
        w_max = d_max = 0.0
        for j in idx:
            wj = w[j]
            z = rho[j] + diag[j] * wj
            new = np.sign(z) * max(abs(z) - l1, 0.0) / (diag[j] + l2)
            if new != wj:
                rho[:] -= g.xtx[:, j] * (new - wj)
                w[j] = new
                d_max = max(d_max, abs(new - wj))
            w_max = max(w_max, abs(new))
        return w_max, d_max

    for ai, a in enumerate(alphas):
        l1 = a * l1_ratio * g.n
        l2 = a * (1.0 - l1_ratio) * g.n
        for _ in range(max_iter):
            w_max, d_max = sweep(every, l1, l2)
            if w_max == 0.0 or d_max / w_max < tol:
                break
            active = np.flatnonzero(w)
            for _ in range(max_iter):
                w_max, d_max = sweep(active, l1, l2)
                if w_max == 0.0 or d_max / w_max < tol:
                    break
        out[ai] = w
    return out
