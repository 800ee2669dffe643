"""Pair-frequency reduction of raw trips.

Per month: count trips per PU_DO pair, keep pairs seen more than
``min_count`` times, keep only trips of kept pairs. All months go through
one plan: the month is part of the grouping key.

Scale notes: the count is a partial (map-side) aggregation, so a pair
holding a third of all trips costs one counter per task, not a hot
partition. The kept-pair table is bounded by the number of distinct pairs,
not by trips; how the semi-join moves it is left to Spark's size estimates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larch.functions.scalar import pair_key
from larch.operators import split

# Fixed values of the reduction: frequency threshold (strict >) and sample share.
MIN_PAIR_COUNT = 10
SAMPLE_FRACTION = 1.0

#: Rows of a file of the reduced trips, at most.
ROWS_PER_FILE = 2_000_000

MONTH = "year_month"
PAIR = "PU_DO"


def with_pair(df: DataFrame) -> DataFrame:
    """P1/P2 on raw trips: location ids as text, ``PU_DO`` key."""
    return df.withColumn(PAIR, pair_key(F.col("PULocationID").cast("string"),
                                        F.col("DOLocationID").cast("string")))


def pair_counts(df: DataFrame, keys: tuple[str, ...] = (MONTH, PAIR)) -> DataFrame:
    """A1: trips per (month, pair); NULL pairs are not counted."""
    return (df.filter(F.col(PAIR).isNotNull()).groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("count")))


def frequent_pairs(counts: DataFrame, min_count: int = MIN_PAIR_COUNT) -> DataFrame:
    """A2: pairs seen strictly more than ``min_count`` times."""
    return counts.filter(F.col("count") > min_count)


def reduce_trips(df: DataFrame, min_count: int = MIN_PAIR_COUNT,
                 fraction: float = SAMPLE_FRACTION, key: str = "trip_id",
                 counts: DataFrame | None = None) -> DataFrame:
    """A3: the whole reduction. Returns trips of frequent pairs, with the
    pair key dropped as in the original files, sampled by key hash (D1).

    J1 is a plain left semi join: Spark broadcasts the kept pairs or shuffles
    both sides by their real size, and splits skewed partitions."""
    d = with_pair(df)
    kept = frequent_pairs(pair_counts(d) if counts is None else counts, min_count)
    out = d.join(kept.select(MONTH, PAIR), [MONTH, PAIR], "left_semi").drop(PAIR)
    return split.hash_sample(out, fraction, key)


def reduction_report(counts: DataFrame, min_count: int = MIN_PAIR_COUNT) -> DataFrame:
    """A4: per month, distinct pairs and rows before and after the cut."""
    kept = F.col("count") > min_count
    return counts.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("distinct_pairs"),
        F.sum("count").cast("long").alias("total_rows"),
        F.sum(kept.cast("long")).cast("long").alias("kept_pairs"),
        F.coalesce(F.sum(F.when(kept, F.col("count"))), F.lit(0)).cast("long").alias("kept_rows"),
    )


def top_pairs(counts: DataFrame, n: int = 5) -> DataFrame:
    """A10: per month the ``n`` most frequent pairs (ties by pair key).

    The window runs over the counts table (one row per pair), not trips."""
    w = Window.partitionBy(MONTH).orderBy(F.desc("count"), F.asc(PAIR))
    return (counts.withColumn("rank", F.row_number().over(w))
                  .filter(F.col("rank") <= n))


def write_reduced(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, key: str = "trip_id") -> None:
    """S3: one directory per month, with as many files as its rows ask for: the rows
    of each month are counted (A1's partial aggregate), and a salt of the key deals them
    out over that many tasks. A small month is one file; no file has more than
    ``rows_per_file`` rows, though two salts may meet in one task."""
    files = df.groupBy(MONTH).agg(F.ceil(F.count("*") / F.lit(rows_per_file)).alias("_files"))
    salted = df.join(files, MONTH).withColumn("_salt", F.pmod(F.xxhash64(key), F.col("_files"))).drop("_files")
    salted.repartition(MONTH, "_salt").drop("_salt").write.mode("overwrite").option(
        "maxRecordsPerFile", rows_per_file).partitionBy(MONTH).parquet(path)


def read_reduced(spark, path: str, months: list[str] | None = None) -> DataFrame:
    """Read reduced trips back; a month filter prunes directories."""
    df = spark.read.parquet(path)
    if months:
        df = df.filter(F.col(MONTH).isin(months))
    return df
