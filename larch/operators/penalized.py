"""Ridge, lasso and elastic net at any number of categories (M4-M6, H5-H7).

The design is numeric columns and one-hot categories. The categorical column with
the most values (the location pairs) is the *wide* one. Its one-hot columns are
orthogonal, so for given other coefficients w each of its own has a closed form,

    v_p = soft(y_p - u_p . w, l1) / (n_p + l2),

where n_p, y_p and u_p are the rows, label sum and column sums of value p. What is
left to minimise is a convex, piecewise quadratic function of w alone, whose
gradient and generalised Hessian are sums over the values of the wide column. So:

* rows are aggregated once to a Spark table with a row per value (``Design``);
* a round is one aggregate over that table, for all penalties of a path or search at
  once: gradients, Hessians, objectives (``_sums``), added up in a tree;
* the driver makes a proximal Newton step in the working set of each penalty:
  numeric columns, intercept and those other one-hot columns that have violated the
  optimality conditions so far. Every round checks the conditions of all columns
  outside the working set (with their gradients at hand, no rule screens them
  wrongly) and adds the violators; those of the wide column hold by construction;
* coefficients of the wide column are a Spark table (value, one coefficient per
  penalty). They never come to the driver.

A round's cost and what reaches the driver depend on the working set, not on the
wide column: 10 million pairs cost as many rows of the table as that, and nothing
else. Ridge has no kinks and needs the first step alone, which is the exact solve.

Objective for penalty k: ``1/2 ||y - b - Xw||^2 + l1_k |w|_1 + l2_k/2 ||w||^2``; the
intercept b, if any, has no penalty. NULL and unseen values have no column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larch.operators.vectors import added
from larch.session import show_package

MAX_ROUNDS = 200
#: A fit ends when no optimality condition of the working set is off by more than
#: this, beside the length of the label times that of the longest column.
TOLERANCE = 1e-13
LEAST_DAMPING = 1e-10
#: Columns outside the working set may exceed the penalty by this share.
SLACK = 1e-9
#: Entries of the dense blocks that a task forms at a time.
BATCH_ENTRIES = 4_000_000


@dataclass(frozen=True)
class Penalty:
    """l1 and l2 of the summed (not averaged) objective."""

    l1: float
    l2: float


def ridge_penalty(alpha: float) -> Penalty:
    return Penalty(0.0, alpha)


def enet_penalty(alpha: float, l1_ratio: float, n: int) -> Penalty:
    """Of ``1/(2n) ||.||^2 + alpha r |w|_1 + alpha (1 - r)/2 ||w||^2``."""
    return Penalty(n * alpha * l1_ratio, n * alpha * (1.0 - l1_ratio))


@dataclass
class Design:
    """Sufficient statistics of the rows."""

    numeric: list[str]
    wide: str | None
    others: list[str]
    slots: list[tuple[str, str]]   # (column, value) of the other one-hot columns
    groups: DataFrame              # a row per value of the wide column
    n: int
    y_sum: float
    yy: float
    x_sum: np.ndarray
    xy: np.ndarray
    xx: np.ndarray

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *(f"{c}={v}" for c, v in self.slots)]

    def release(self) -> None:
        self.groups.unpersist()


def design(df: DataFrame, numeric: list[str], categorical: list[str], label: str, drop_first: bool = False) -> Design:
    """Aggregate rows to a :class:`Design`. The driver gets the totals and the
    values of the categorical columns but the widest; a row of the table has at most
    one cell per combination of those values."""
    show_package(df.sparkSession)
    y = F.col(label).cast("double")
    nn = len(numeric)
    pairs = [(i, j) for i in range(nn) for j in range(i, nn)]
    total = df.agg(
        F.count("*").alias("n"), F.sum(y).alias("y"), F.sum(y * y).alias("yy"),
        *[F.sum(c).alias(f"s{i}") for i, c in enumerate(numeric)], *[F.sum(F.col(c) * y).alias(f"y{i}") for i, c in enumerate(numeric)],
        *[F.sum(F.col(numeric[i]) * F.col(numeric[j])).alias(f"x{i}_{j}") for i, j in pairs],
        *[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(categorical)]).first()
    xx = np.zeros((nn, nn))
    for i, j in pairs:
        xx[i, j] = xx[j, i] = total[f"x{i}_{j}"] or 0.0
    sizes = [total[f"d{i}"] for i in range(len(categorical))]
    wide = categorical[int(np.argmax(sizes))] if categorical else None
    others = [c for c in categorical if c != wide]
    key = F.col(wide).cast("string") if wide else F.lit(None).cast("string")
    keyed = df.select(key.alias("value"), *[F.col(c).cast("string").alias(f"o{j}") for j, c in enumerate(others)], y.alias("y"),
                      *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(numeric)])
    own = [f"o{j}" for j in range(len(others))]
    cells = keyed.groupBy("value", *own).agg(
        F.count("*").cast("double").alias("n"), F.sum("y").alias("y"), *[F.sum(f"x{i}").alias(f"x{i}") for i in range(nn)])
    cells = cells.persist(StorageLevel.MEMORY_AND_DISK)
    slots: list[tuple[str, str]] = []
    spark = df.sparkSession
    placed = cells
    for j, c in enumerate(others):
        values = sorted(r[0] for r in cells.select(f"o{j}").distinct().collect() if r[0] is not None)[1 if drop_first else 0:]
        table = spark.createDataFrame([(v, len(slots) + i) for i, v in enumerate(values)], f"o{j} string, k{j} int")
        slots += [(c, v) for v in values]
        placed = placed.join(table, f"o{j}", "left")
    cell = F.struct("n", "y", F.array(*[F.col(f"x{i}") for i in range(nn)]).cast("array<double>").alias("x"),
                    F.array(*[F.coalesce(F.col(f"k{j}"), F.lit(-1)) for j in range(len(others))]).cast("array<int>").alias("k"))
    groups = placed.groupBy("value").agg(F.collect_list(cell).alias("cells"))
    first = cells.agg(F.min("value")).first()[0] if drop_first and wide else None
    has_column = F.col("value").isNotNull() if first is None else F.col("value").isNotNull() & (F.col("value") != F.lit(first))
    groups = groups.select("value", has_column.alias("own"), F.col("cells.n").alias("n"), F.col("cells.y").alias("y"),
                           F.flatten("cells.x").alias("x"), F.flatten("cells.k").alias("k")).persist(StorageLevel.MEMORY_AND_DISK)
    groups.count()
    cells.unpersist()
    zero = [total[f"s{i}"] or 0.0 for i in range(nn)], [total[f"y{i}"] or 0.0 for i in range(nn)]
    return Design(numeric, wide, others, slots, groups, total["n"], total["y"] or 0.0, total["yy"] or 0.0, np.array(zero[0]), np.array(zero[1]), xx)


# ---- one round -----------------------------------------------------------------

@dataclass
class _Set:
    """The working set: (intercept) + numeric columns + some slots."""

    intercept: bool
    n_numeric: int
    n_others: int
    slots: np.ndarray

    @property
    def head(self) -> int:
        return self.intercept + self.n_numeric

    @property
    def size(self) -> int:
        return self.head + len(self.slots)


class _Cells:
    """Some rows of ``Design.groups`` as arrays."""

    def __init__(self, frame: pd.DataFrame, s: _Set) -> None:
        size = frame["n"].map(len).to_numpy()
        self.first = np.cumsum(size) - size
        self.of = np.repeat(np.arange(len(frame)), size)
        self.n, self.y = (np.concatenate(frame[c].tolist()).astype(float) for c in ("n", "y"))
        x = np.concatenate(frame["x"].tolist()).astype(float).reshape(len(self.n), s.n_numeric)
        self.k = np.concatenate(frame["k"].tolist()).astype(np.int64).reshape(len(self.n), s.n_others)
        self.own = frame["own"].to_numpy(dtype=bool)
        self.masks = [(self.k == slot).any(axis=1) for slot in s.slots]
        columns = [self.n[:, None]] * s.intercept + [x] + [np.where(m, self.n, 0.0)[:, None] for m in self.masks]
        self.cols = np.concatenate(columns, axis=1)

    def by_group(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.first, axis=0)


def _wide_coefficients(c: _Cells, w: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> tuple[np.ndarray, ...]:
    """(columns, rows, coefficients, whether they move) of the values; a coefficient per penalty."""
    u, n, y = c.by_group(c.cols), c.by_group(c.n), c.by_group(c.y)
    t = y[:, None] - u @ w.T
    moves = (np.abs(t) > l1) & c.own[:, None]
    v = np.where(moves, (t - np.sign(t) * l1) / (n[:, None] + l2), 0.0)
    return u, n, v, moves


def _batches(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    rows = max(1, BATCH_ENTRIES // max(1, width))
    for b in batches:
        for i in range(0, len(b), rows):
            yield b.iloc[i:i + rows]


@dataclass
class _Sums:
    base: np.ndarray       # X'X of the working set but for numeric x numeric
    wide: np.ndarray       # per penalty: columns' . coefficients of the wide column
    bent: np.ndarray       # per penalty: what the wide column takes from X'X
    squares: np.ndarray    # per penalty: sum of v^2 (n + l2)
    slots: np.ndarray      # per slot and penalty: minus the column times the residuals
    slot_y: np.ndarray


def _sums(d: Design, s: _Set, w: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> _Sums:
    """One aggregate over the values of the wide column, for all penalties."""
    k, m, r = len(w), s.size, len(d.slots)
    shapes = [(m, m), (k, m), (k, m, m), (k,), (r, k), (r,)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        out = [np.zeros(x) for x in shapes]
        for frame in _batches(batches, max(m, k)):
            c = _Cells(frame, s)
            u, n, v, moves = _wide_coefficients(c, w, l1, l2)
            if s.intercept:
                out[0][0] += c.cols.sum(axis=0)
            for i, mask in enumerate(c.masks):
                out[0][s.head + i] += c.cols[mask].sum(axis=0)
            out[1] += v.T @ u
            for j in range(k):
                z = u[moves[:, j]]
                out[2][j] += z.T @ (z / (n[moves[:, j]] + l2[j])[:, None])
            out[3] += (v * v * (n[:, None] + l2)).sum(axis=0)
            left = c.cols @ w.T + c.n[:, None] * v[c.of] - c.y[:, None]
            for column in c.k.T:
                has = column >= 0
                np.add.at(out[4], column[has], left[has])
                np.add.at(out[5], column[has], c.y[has])
        flat = np.concatenate([x.ravel() for x in out])
        yield pd.DataFrame({"at": [TaskContext.get().partitionId()], "v": [flat.tobytes()]})

    flat = added(d.groups.mapInPandas(run, "at long, v binary"), d.groups.rdd.getNumPartitions())
    sizes = [int(np.prod(x)) for x in shapes]
    flat = np.zeros(sum(sizes)) if flat is None else flat
    return _Sums(*(x.reshape(shape) for x, shape in zip(np.split(flat, np.cumsum(sizes)[:-1]), shapes, strict=True)))


def _working_gram(d: Design, s: _Set, base: np.ndarray) -> np.ndarray:
    """X'X of the working set from the rows of intercept and slots."""
    a, i, h = base.copy(), int(s.intercept), s.head
    a[i:h, i:h] = d.xx
    if s.intercept:
        a[i:h, 0] = a[0, i:h]
    a[i:h, h:] = a[h:, i:h].T
    if s.intercept:
        a[0, h:] = a[h:, 0]
    return a


def small_lasso(h: np.ndarray, g: np.ndarray, w: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """The minimiser x of ``g'(x - w) + 1/2 (x - w)' h (x - w) + l1 |x| + l2/2 x^2``: coordinate
    descent finds signs, a solve on them the numbers, until the signs hold."""
    a = h + np.diag(l2)
    c = h @ w - g
    x, diag = w.copy(), np.maximum(np.diag(a), 1e-12 * max(float(np.diag(a).max(initial=0.0)), 1e-300))
    tiny = 1e-12 * max(float(np.abs(c).max(initial=0.0)), 1e-300)
    for _ in range(1000):
        on = np.flatnonzero((x != 0) | (l1 == 0))
        z = np.zeros_like(x)
        if len(on):
            z[on] = np.linalg.lstsq(a[np.ix_(on, on)], c[on] - l1[on] * np.sign(x[on]), rcond=1e-14)[0]
        rest = c - a @ z
        off = np.setdiff1d(np.arange(len(x)), on)
        if (np.sign(z[on]) == np.sign(x[on]))[l1[on] > 0].all() and (np.abs(rest[off]) <= l1[off] + tiny).all():
            return z
        for _ in range(20):
            for j in range(len(x)):
                r = c[j] - a[j] @ x + a[j, j] * x[j]
                x[j] = np.sign(r) * max(abs(r) - l1[j], 0.0) / diag[j]
    return x


def _curved(a: np.ndarray, bent: np.ndarray, least: float) -> np.ndarray:
    """a - bent, where no direction is flatter than ``least``, beside columns of length one."""
    length = np.sqrt(np.maximum(np.diag(a), 1e-300))
    h = (a - bent) / length / length[:, None]
    values, vectors = np.linalg.eigh((h + h.T) / 2)
    if len(values) and values[0] < least:
        h = (vectors * np.maximum(values, least)) @ vectors.T
    return h * length * length[:, None]


@dataclass
class Fits:
    """Coefficients of all penalties. ``narrow``: (penalties, numeric + slots)."""

    design: Design
    intercepts: np.ndarray
    narrow: np.ndarray
    wide: DataFrame | None    # value, coefficients (array, one per penalty)
    objective: np.ndarray
    rounds: int
    residual: np.ndarray      # per penalty: largest breach of the optimality conditions


def fit(d: Design, penalties: list[Penalty], intercept: bool = True) -> Fits:
    """All penalties together; see the module's text.

    Where all values of the wide column have a coefficient and l2 is 0, the Hessian
    is singular along the intercept. So steps are damped along flat directions: more
    after a step that didn't lower the objective, which is taken back, less after
    others."""
    k, nn = len(penalties), len(d.numeric)
    l1, l2 = (np.array([getattr(p, x) for p in penalties]) for x in ("l1", "l2"))
    kinks = bool(l1.any())
    # no kinks: all columns are in the set from the start
    s = _Set(intercept, nn, len(d.others), np.zeros(0, dtype=np.int64) if kinks else np.arange(len(d.slots)))
    w, step, gradient = np.zeros((k, s.size)), np.zeros((k, s.size)), np.zeros((k, s.size))
    bent = np.zeros((k, s.size, s.size))
    best, damping = np.full(k, np.inf), np.full(k, LEAST_DAMPING if kinks else 0.0)
    done, residual = np.zeros(k, dtype=bool), np.full(k, np.inf)
    for rounds in range(1, MAX_ROUNDS + 1):
        trial = w + step
        t = _sums(d, s, trial, l1, l2)
        a = _working_gram(d, s, t.base)
        b = np.concatenate([[d.y_sum] * s.intercept, d.xy, t.slot_y[s.slots]])
        held = np.ones(s.size)  # the intercept has no penalty
        held[:s.intercept] = 0
        value = 0.5 * d.yy - trial @ b + 0.5 * np.einsum("ki,ij,kj->k", trial, a, trial) - 0.5 * t.squares + (
            held * (l1[:, None] * np.abs(trial) + 0.5 * l2[:, None] * trial ** 2)).sum(axis=1)
        good = np.isfinite(value) & ((value <= best + 1e-12 * max(d.yy, 1e-300)) | ~step.any(axis=1))
        damping = np.where(good, damping / 10, np.maximum(damping * 100, 1e-10))
        damping[damping < LEAST_DAMPING] = LEAST_DAMPING if kinks else 0.0
        w[good], best[good], bent[good] = trial[good], value[good], t.bent[good]
        gradient[good] = (trial @ a + t.wide - b)[good]
        outside = np.setdiff1d(np.arange(len(d.slots)), s.slots)
        breach = np.maximum(np.abs(t.slots[outside]) - l1, 0) * good
        least = 1e-9 * max(1.0, float(np.abs(b).max(initial=0.0)))
        add = outside[(breach > SLACK * l1 + least).any(axis=1)]
        for j in range(k):
            new = small_lasso(_curved(a, bent[j], damping[j]), gradient[j], w[j], held * l1[j], held * l2[j])
            step[j] = new - w[j]
            if good[j]:
                full = gradient[j] + held * l2[j] * w[j]
                zero = (w[j] == 0) & (held == 1)
                off = np.where(zero, np.maximum(np.abs(full) - l1[j], 0), np.abs(full + held * l1[j] * np.sign(w[j])))
                residual[j] = max(off.max(initial=0.0), breach[:, j].max(initial=0.0))
                done[j] = residual[j] <= TOLERANCE * np.sqrt(max(d.yy, 1e-300) * max(float(np.diag(a).max(initial=0.0)), d.n)) or not step[j].any()
        if done.all() and not len(add):
            break
        step[done] = 0.0
        if len(add):
            done[:] = False
            s = _Set(intercept, nn, len(d.others), np.concatenate([s.slots, add]))
            step[~good] = 0.0  # they are looked at again, with the new columns
            w, step, gradient = (np.concatenate([x, np.zeros((k, len(add)))], axis=1) for x in (w, step, gradient))
            bent = np.pad(bent, ((0, 0), (0, len(add)), (0, len(add))))
    narrow = np.zeros((k, nn + len(d.slots)))
    narrow[:, :nn] = w[:, s.intercept:s.head]
    narrow[:, nn + s.slots] = w[:, s.head:]
    return Fits(d, w[:, 0].copy() if intercept else np.zeros(k), narrow, _wide_table(d, s, w, l1, l2) if d.wide else None, best, rounds, residual)


def _wide_table(d: Design, s: _Set, w: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _batches(batches, max(s.size, len(w))):
            _, _, v, _ = _wide_coefficients(_Cells(frame, s), w, l1, l2)
            yield pd.DataFrame({"value": frame["value"], "coefficients": list(v)}).loc[frame["own"].to_numpy(dtype=bool)]

    return d.groups.mapInPandas(run, "value string, coefficients array<double>")


def alpha_max(d: Design, l1_ratio: float) -> float:
    """The smallest penalty without an intercept that leaves every coefficient at zero."""
    y = F.aggregate("y", F.lit(0.0), lambda a, x: a + x)
    top = d.groups.where("own").agg(F.max(F.abs(y))).first()[0] or 0.0
    each = d.groups.select(F.explode(F.arrays_zip(F.col("y").alias("y"), F.sequence(F.lit(0), F.size("y") - 1).alias("i"))).alias("c"), "k").select(
        F.explode(F.slice("k", F.col("c.i") * max(1, len(d.others)) + 1, max(1, len(d.others)))).alias("slot"), "c.y") if d.slots else None
    sums = each.where("slot >= 0").groupBy("slot").agg(F.sum("y").alias("y")).agg(F.max(F.abs("y"))).first()[0] if d.slots else 0.0
    return max(top, sums or 0.0, float(np.abs(d.xy).max(initial=0.0))) / (d.n * l1_ratio)


def alpha_grid(d: Design, l1_ratio: float = 1.0, n_alphas: int = 30, eps: float = 1e-3) -> np.ndarray:
    """Geometric grid down from :func:`alpha_max`."""
    top = alpha_max(d, l1_ratio)
    return np.logspace(np.log10(top), np.log10(top * eps), n_alphas)
