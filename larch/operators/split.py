"""Sampling, train/test split, stratified folds and growing train subsets
(D1-D4).

Every assignment is a function of the row key, never of row position or
partitioning, so a recomputed partition (lost executor) and another cluster
layout give the same rows. Integer keys use a multiplicative hash that
plain SQL can reproduce; other keys use ``xxhash64``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larch.operators import ranking

# Hash constants. Every assignment has a modulus of its own, and
# the moduli share no factor, so for spread-out keys the assignments are
# independent of each other (a sample keeps the split's share, and so on).
SPLIT_MULTIPLIER, SPLIT_MODULUS = 7919, 1000
SAMPLE_MULTIPLIER, SAMPLE_MODULUS = 15485863, 1009
VALIDATION_MULTIPLIER, VALIDATION_MODULUS = 32452843, 1013
ORDER_MULTIPLIER, ORDER_MODULUS = 104729, 2147483647
SUBSET_MULTIPLIER, SUBSET_MODULUS = 1299709, 2147483629
DEFAULT_SEED = 123


def _is_integral(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType))


def unit_bucket(df: DataFrame, key: str, seed: int = DEFAULT_SEED,
                modulus: int = SPLIT_MODULUS, multiplier: int = SPLIT_MULTIPLIER) -> Column:
    """Key hash in [0, modulus): ``(key * multiplier + seed) mod modulus``.

    The key is reduced mod ``modulus`` first (same residue, no 64-bit
    overflow for large or hashed keys)."""
    k = F.col(key)
    if _is_integral(df, key):
        return F.pmod(F.pmod(k.cast("long"), F.lit(modulus)) * F.lit(multiplier) + F.lit(seed),
                      F.lit(modulus))
    return F.pmod(F.xxhash64(k, F.lit(seed)), F.lit(modulus))


def with_split(df: DataFrame, key: str = "trip_id", test_size: float = 0.3,
               seed: int = DEFAULT_SEED, out: str = "is_test") -> DataFrame:
    """``is_test`` true for about ``test_size`` of the keys."""
    cut = int(round(test_size * SPLIT_MODULUS))
    return df.withColumn(out, unit_bucket(df, key, seed) < F.lit(cut))


def hash_sample(df: DataFrame, fraction: float, key: str = "trip_id",
                seed: int = DEFAULT_SEED) -> DataFrame:
    """Keep about ``fraction`` of the keys (fraction 1 keeps all)."""
    if fraction >= 1.0:
        return df
    cut = int(round(fraction * SAMPLE_MODULUS))
    return df.filter(unit_bucket(df, key, seed + 1, SAMPLE_MODULUS, SAMPLE_MULTIPLIER) < F.lit(cut))


def with_validation(df: DataFrame, fraction: float = 0.1, key: str = "trip_id",
                    seed: int = DEFAULT_SEED, out: str = "is_valid") -> DataFrame:
    """Flag about ``fraction`` of the keys for early stopping, on either side
    of the split alike."""
    cut = int(round(fraction * VALIDATION_MODULUS))
    return df.withColumn(out, unit_bucket(df, key, seed + 2, VALIDATION_MODULUS, VALIDATION_MULTIPLIER) < F.lit(cut))


def order_hash(df: DataFrame, key: str, seed: int = DEFAULT_SEED) -> Column:
    """A key hash used as a shuffled order (ties broken by the key)."""
    return unit_bucket(df, key, seed, ORDER_MODULUS, ORDER_MULTIPLIER)


def subset_hash(df: DataFrame, key: str, seed: int = DEFAULT_SEED) -> Column:
    """A second shuffled order, unrelated to :func:`order_hash`."""
    return unit_bucket(df, key, seed, SUBSET_MODULUS, SUBSET_MULTIPLIER)


def with_stratified_folds(df: DataFrame, label: str, k: int = 10, key: str = "trip_id",
                          seed: int = DEFAULT_SEED, out: str = "fold",
                          n_rows: int | None = None) -> DataFrame:
    """D3: fold = (rank of the row inside its class, by key hash) mod k.

    Every class is dealt round-robin over the folds, so fold class shares
    differ by at most one row. The rank is computed with bucketed running
    totals, not a window over the whole class.
    """
    d = df.withColumn("_h", order_hash(df, key, seed))
    n = n_rows if n_rows is not None else d.count()
    b = ranking.uniform_bucket(F.col("_h"), 0, ORDER_MODULUS, ranking.bucket_count(n))
    d = ranking.running_totals(d, ["_h", key], {"_rank": F.lit(1)}, b, [label])
    return d.withColumn(out, F.pmod(F.col("_rank_before"), F.lit(k)).cast("int")).drop(
        "_h", "_rank_before")


def train_sizes(n_max: int, fractions: list[float]) -> list[int]:
    """Absolute sizes for train fractions (floor, at least 1)."""
    return [max(1, int(f * n_max)) for f in fractions]


def with_fold_train_ranks(df: DataFrame, k: int = 10, fold: str = "fold",
                          key: str = "trip_id", seed: int = DEFAULT_SEED + 7,
                          n_rows: int | None = None) -> DataFrame:
    """D4 support: for every fold f, ``train_rank`` array element f is the
    row's rank among the rows outside fold f, in a second hash order.

    A subset of ``s`` rows of fold f's train part is then
    ``fold != f AND train_rank[f] < s``; subsets are nested by size.
    """
    d = df.withColumn("_u", subset_hash(df, key, seed))
    n = n_rows if n_rows is not None else d.count()
    b = ranking.uniform_bucket(F.col("_u"), 0, SUBSET_MODULUS, ranking.bucket_count(n))
    vals = {"_all": F.lit(1)}
    vals.update({f"_f{i}": (F.col(fold) == i).cast("long") for i in range(k)})
    d = ranking.running_totals(d, ["_u", key], vals, b)
    ranks = [F.col("_all_before") - F.col(f"_f{i}_before") for i in range(k)]
    return d.withColumn("train_rank", F.array(*ranks)).drop(
        "_u", *[f"{n}_before" for n in vals])


def fold_subset(df: DataFrame, f: int, size: int, fold: str = "fold") -> DataFrame:
    """Rows of the first ``size`` rows of fold ``f``'s train part."""
    return df.filter((F.col(fold) != f) & (F.element_at("train_rank", f + 1) < size))
