"""Many logistic models of the same rows in one pass per step (M7, H2, H8).

A learning curve or a search fits hundreds of models that differ in the rows they
see and in their penalty, not in the data. Instead of a job per model and step, all
models advance together: one Spark job per step computes the loss and the gradient
of every model at its own trial point. A row knows from its fold and rank which models
it trains, so no subset is ever written or filtered out. The driver keeps a limited
memory of past steps per model (L-BFGS) and lets each model take its own step length;
models that have converged leave the job.

Objective of a model, as :func:`larch.operators.models.logistic_regression`:
``mean logloss + 1 / (2 C n) ||w||^2`` over its n rows, intercept without penalty.

Per step a task holds batches of about ``BATCH_ENTRIES`` numbers and one gradient of
(models x columns), which are added up in a tree. The driver holds
``2 * MEMORY + 6`` such arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from larch.operators.vectors import added

MEMORY = 6
BATCH_ENTRIES = 2_000_000
ARMIJO = 1e-4
#: A model has converged when its loss falls by a smaller share than this.
LEAST_FALL = 1e-10

#: Which models each row of a batch trains: frame -> bool (rows, models).
Members = Callable[[pd.DataFrame], np.ndarray]


@dataclass
class LogisticFits:
    weights: np.ndarray      # (models, columns)
    intercepts: np.ndarray
    n: np.ndarray            # rows of each model
    loss: np.ndarray
    rounds: int


class _Rows:
    """A batch of sparse rows as arrays."""

    def __init__(self, frame: pd.DataFrame) -> None:
        size = frame["columns"].map(len).to_numpy()
        self.row = np.repeat(np.arange(len(frame)), size)
        self.column = np.concatenate(frame["columns"].tolist()).astype(np.int64)
        self.value = np.concatenate(frame["values"].tolist()).astype(float)
        filled = np.flatnonzero(size)
        self.filled, self.first = filled, (np.cumsum(size) - size)[filled]
        self.order = np.argsort(self.column, kind="stable")
        sorted_columns = self.column[self.order]
        self.new = np.flatnonzero(np.concatenate([[True], sorted_columns[1:] != sorted_columns[:-1]])) if len(sorted_columns) else np.zeros(0, dtype=np.int64)
        self.seen = sorted_columns[self.new]

    def margins(self, w_t: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        out = np.tile(b, (n, 1))
        if len(self.column):
            out[self.filled] += np.add.reduceat(w_t[self.column] * self.value[:, None], self.first, axis=0)
        return out

    def add_gradient(self, g: np.ndarray, r: np.ndarray) -> None:
        """g (columns, models) += X' r."""
        if len(self.column):
            o = self.order
            g[self.seen] += np.add.reduceat(r[self.row[o]] * self.value[o][:, None], self.new, axis=0)


def batches_of(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    """Batches whose non-zero entries times ``width`` stay near ``BATCH_ENTRIES``."""
    for b in batches:
        size = np.maximum(b["columns"].map(len).to_numpy(), 1)
        part = np.cumsum(size) * max(width, 1) // BATCH_ENTRIES
        for _, rows in b.groupby(part, sort=True):
            yield rows


def _evaluate(rows: DataFrame, n_parts: int, w: np.ndarray, b: np.ndarray, members: Members, live: np.ndarray) -> tuple[np.ndarray, ...]:
    """(rows, loss, gradient of weights, of intercepts), all summed over rows, of the live models."""
    d, k = w.shape[1], len(live)
    w_t, b = np.ascontiguousarray(w[live].T), b[live]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        n, loss, gw, gb = np.zeros(k), np.zeros(k), np.zeros((d, k)), np.zeros(k)
        for frame in batches_of(batches, k):
            x, y, inside = _Rows(frame), frame["label"].to_numpy()[:, None], members(frame)[:, live]
            z = x.margins(w_t, b, len(frame))
            away = np.where(y > 0, -z, z)  # log(1 + exp(away)) is the loss
            loss += np.where(inside, np.logaddexp(0, away), 0).sum(axis=0)
            r = np.where(inside, 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y, 0.0)
            n += inside.sum(axis=0)
            gb += r.sum(axis=0)
            x.add_gradient(gw, r)
        yield pd.DataFrame({"at": [TaskContext.get().partitionId()], "v": [np.concatenate([n, loss, gb, gw.ravel()]).tobytes()]})

    flat = added(rows.mapInPandas(run, "at long, v binary"), n_parts)
    flat = np.zeros(3 * k + d * k) if flat is None else flat
    return flat[:k], flat[k:2 * k], flat[3 * k:].reshape(d, k).T, flat[2 * k:3 * k]


class _Memory:
    """Past steps of one model."""

    def __init__(self) -> None:
        self.s: list[np.ndarray] = []
        self.y: list[np.ndarray] = []

    def add(self, s: np.ndarray, y: np.ndarray) -> None:
        if s @ y > 1e-12 * (y @ y):
            self.s.append(s)
            self.y.append(y)
            del self.s[:-MEMORY], self.y[:-MEMORY]

    def direction(self, g: np.ndarray, start: np.ndarray) -> np.ndarray:
        """``start``: the diagonal that stands for the inverse Hessian at first."""
        q, kept = g.copy(), []
        for s, y in zip(reversed(self.s), reversed(self.y)):
            a = (s @ q) / (s @ y)
            q -= a * y
            kept.append(a)
        q *= start
        if self.s:
            s, y = self.s[-1], self.y[-1]
            q *= (s @ y) / (y @ (start * y))
        for (s, y), a in zip(zip(self.s, self.y), reversed(kept)):
            q += s * (a - (y @ q) / (s @ y))
        return -q


def _squares(rows: DataFrame, n_columns: int, n_parts: int) -> np.ndarray:
    """The mean square of every column."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        n, out = 0, np.zeros(n_columns)
        for frame in batches:
            n += len(frame)
            x = np.concatenate(frame["values"].tolist())
            out += np.bincount(np.concatenate(frame["columns"].tolist()).astype(np.int64), weights=x * x, minlength=n_columns)
        yield pd.DataFrame({"at": [TaskContext.get().partitionId()], "v": [np.append(out, float(n)).tobytes()]})

    flat = added(rows.select("columns", "values").mapInPandas(run, "at long, v binary"), n_parts)
    return np.zeros(n_columns) if flat is None else flat[:-1] / max(flat[-1], 1)


def fit_many(rows: DataFrame, n_columns: int, strengths: list[float], members: Members,
             max_iter: int = 250, tol: float = 1e-7) -> LogisticFits:
    """Fits of all models. ``rows``: label, columns, values and what ``members`` reads
    (:func:`larch.operators.vectors.sparse_rows`), persisted. ``strengths``: C of each."""
    m = len(strengths)
    c = np.array(strengths, dtype=float)
    x = np.zeros((m, n_columns + 1))  # weights, intercept
    step = np.zeros_like(x)
    length = np.ones(m)
    value, gradient, slope = np.full(m, np.inf), np.zeros_like(x), np.zeros(m)
    memory = [_Memory() for _ in range(m)]
    live, counts, taken = np.arange(m), np.zeros(m), np.zeros(m, dtype=int)
    n_parts, rounds = rows.rdd.getNumPartitions(), 0
    # curvature of the log loss is at most a quarter of the columns' mean squares
    curvature = np.append(_squares(rows, n_columns, n_parts), 1.0) / 4
    while len(live):
        rounds += 1
        trial = x + length[:, None] * step
        n, loss, gw, gb = _evaluate(rows, n_parts, trial[:, :-1], trial[:, -1], members, live)
        going = []
        for i, j in enumerate(live):
            counts[j] = n[i]
            if n[i] == 0:
                continue  # no rows: the model stays at zero
            penalty = 1 / (c[j] * n[i])
            f = loss[i] / n[i] + penalty / 2 * float(trial[j, :-1] @ trial[j, :-1])
            if not f <= value[j] + ARMIJO * length[j] * slope[j] + 1e-14 * abs(f):
                length[j] /= 4
                if length[j] > 1e-10:
                    going.append(j)
                continue
            g = np.append(gw[i] / n[i] + penalty * trial[j, :-1], gb[i] / n[i])
            if taken[j]:
                memory[j].add(trial[j] - x[j], g - gradient[j])
            fell = value[j] - f
            x[j], value[j], gradient[j], taken[j] = trial[j], f, g, taken[j] + 1
            if np.abs(g).max() <= tol or taken[j] > max_iter or fell <= LEAST_FALL * abs(f):
                continue
            start = 1 / (curvature + np.append(np.full(n_columns, penalty), 0.0))
            step[j] = memory[j].direction(g, start)
            slope[j] = float(step[j] @ g)
            if slope[j] >= 0:  # not a descent direction: start over
                memory[j] = _Memory()
                step[j] = -start * g
                slope[j] = float(step[j] @ g)
            length[j] = 1.0
            going.append(j)
        live = np.array(going, dtype=int)
    return LogisticFits(x[:, :-1].copy(), x[:, -1].copy(), counts, value, rounds)


def scored_counts(rows: DataFrame, fits: LogisticFits, train: Members, test: Members) -> DataFrame:
    """(model, is_test, _s, _pos, _neg): rows of each class per model, side and
    probability. Equal probabilities of a task are counted together."""
    w_t, b, k = np.ascontiguousarray(fits.weights.T), fits.intercepts, len(fits.intercepts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(batches, k):
            z = _Rows(frame).margins(w_t, b, len(frame))
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            positive = frame["label"].to_numpy() > 0
            for is_test, inside in ((False, train(frame)), (True, test(frame))):
                row, model = np.nonzero(inside)
                out = pd.DataFrame({"model": model, "is_test": is_test, "_s": p[row, model], "_pos": positive[row].astype("int64")})
                yield out.assign(_neg=1 - out["_pos"])

    from pyspark.sql import functions as F

    found = rows.mapInPandas(run, "model int, is_test boolean, _s double, _pos long, _neg long")
    return found.groupBy("model", "is_test", "_s").agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
