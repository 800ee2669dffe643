"""Hyperparameter search (H1-H4).

Draws are counter based: a hash of seed, candidate, name and number gives a uniform
number, which the prior turns into a value. So a candidate's values depend on nothing
else, any engine can make them, and ``candidates`` makes them as columns of a table.
Each candidate fit is a set of Spark jobs on the persisted feature frame; a small thread
pool submits several fits at once so the cluster stays busy while a fit's driver-side
steps run. The best candidate is picked by a query over the runs
(:func:`larch.sources.runs.winner`).
"""

from __future__ import annotations

import hashlib
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any, Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hex digits of a hash that make a uniform number in (0, 1).
DIGITS = 8


def _uniform(seed: int, candidate: int, name: str, k: int) -> float:
    digest = hashlib.md5(f"{seed}:{candidate}:{name}:{k}".encode()).hexdigest()
    return (int(digest[:DIGITS], 16) + 0.5) / 16 ** DIGITS


def _uniform_column(seed: int, name: str, k: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("candidate").cast("string"), F.lit(f":{name}:{k}")))
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16 ** DIGITS)


@dataclass(frozen=True)
class Prior:
    kind: str
    args: tuple

    def draw(self, seed: int, candidate: int, name: str) -> Any:
        k, a = self.kind, self.args
        u = _uniform(seed, candidate, name, 1)
        if k == "lognormal":  # a normal number from two uniform ones (Box and Muller)
            z = math.sqrt(-2 * math.log(u)) * math.cos(2 * math.pi * _uniform(seed, candidate, name, 2))
            return math.exp(a[0] + a[1] * z)
        if k == "uniform":
            return a[0] + (a[1] - a[0]) * u
        if k == "quniform":
            lo, hi, q = a
            return float(math.floor((lo + (hi - lo) * u) / q + 0.5) * q)
        if k == "choice":
            return a[int(u * len(a))]
        raise ValueError(k)

    def column(self, seed: int, name: str) -> Column:
        """The same as a column, from ``candidate``."""
        k, a = self.kind, self.args
        u = _uniform_column(seed, name, 1)
        if k == "lognormal":
            z = F.sqrt(-2 * F.log(u)) * F.cos(F.lit(2 * math.pi) * _uniform_column(seed, name, 2))
            return F.exp(F.lit(float(a[0])) + F.lit(float(a[1])) * z)
        if k == "uniform":
            return F.lit(float(a[0])) + F.lit(float(a[1] - a[0])) * u
        if k == "quniform":
            lo, hi, q = (float(x) for x in a)
            return F.floor((F.lit(lo) + F.lit(hi - lo) * u) / q + 0.5) * F.lit(q)
        if k == "choice":
            return F.element_at(F.array(*[F.lit(x) for x in a]), (F.floor(u * len(a)) + 1).cast("int"))
        raise ValueError(k)


def lognormal(mu: float, sigma: float) -> Prior:
    return Prior("lognormal", (mu, sigma))


def uniform(lo: float, hi: float) -> Prior:
    return Prior("uniform", (lo, hi))


def quniform(lo: float, hi: float, q: float) -> Prior:
    return Prior("quniform", (lo, hi, q))


def choice(*options) -> Prior:
    return Prior("choice", tuple(options))


def sample(space: dict, n: int, seed: int = 123) -> list[dict]:
    """H1: ``n`` candidates; fixed entries of the space are copied."""
    return [{k: (v.draw(seed, i, k) if isinstance(v, Prior) else v) for k, v in space.items()} for i in range(n)]


def candidate_columns(space: dict, seed: int = 123) -> list[Column]:
    """H1 as columns, one per entry of the space, of a table with ``candidate``."""
    return [(v.column(seed, k) if isinstance(v, Prior) else F.lit(v)).alias(k) for k, v in space.items()]


def candidates(spark: SparkSession, space: dict, n: int, seed: int = 123) -> DataFrame:
    """H1 as a table: candidate and a column per entry of the space."""
    return spark.range(n).select(F.col("id").alias("candidate")).select("candidate", *candidate_columns(space, seed))


def run(objective: Callable[[dict], dict], candidates: list[dict],
        parallelism: int = 4) -> list[dict]:
    """H2: evaluate every candidate; returns ``{"params", "metrics",
    "artifact"}`` rows in candidate order. An objective returns its metrics, or
    its metrics and the path of the saved model."""
    def one(c):
        out = objective(c)
        metrics, artifact = out if isinstance(out, tuple) else (out, None)
        return {"params": c, "metrics": metrics, "artifact": artifact}
    if parallelism <= 1 or len(candidates) <= 1:
        return [one(c) for c in candidates]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(candidates))) as pool:
        return list(pool.map(one, candidates))


def refit_params(space: dict, best_params: dict, tuned: list[str]) -> dict:
    """H4: the space with the tuned entries replaced by the best values."""
    out = {k: v for k, v in space.items() if not isinstance(v, Prior)}
    out.update({k: best_params[k] for k in tuned})
    return out
