"""Running totals over a global order without a single-partition window.

A window with an ORDER BY and no PARTITION BY (or a partition key with two
values, like a label) sends every row to one task. Instead rows are first
put into ordered buckets (a bucket id that never decreases along the
order), then

* per bucket totals are aggregated (groups x buckets rows, small),
* an offset per bucket is a running total over that small table,
* inside a bucket an ordinary window adds the local running total.

Each window partition holds about ``ROWS_PER_BUCKET`` rows, whatever the
data size, so the work spreads over all executors. The result is exact and
does not depend on the number of buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 1_000_000
MIN_BUCKETS = 8


def bucket_count(n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(MIN_BUCKETS, math.ceil(n_rows / rows_per_bucket))


def uniform_bucket(c: Column, lo: float, hi: float, n_buckets: int) -> Column:
    """Bucket id for a column spread evenly over [lo, hi) (a hash)."""
    width = (hi - lo) / n_buckets
    return F.least(F.floor((c - F.lit(lo)) / F.lit(width)), F.lit(n_buckets - 1)).cast("int")


def with_range_bucket(df: DataFrame, col: str, n_buckets: int, out: str = "_bkt") -> DataFrame:
    """Deal rows out by ranges of ``col`` and call the partition the bucket.
    The caller persists the result: the ranges come from a sample, and rows and
    totals must see the same ones."""
    return df.repartitionByRange(n_buckets, col).withColumn(out, F.spark_partition_id())


def running_totals(df: DataFrame, order_cols: list[str], values: dict[str, Column],
                   bucket: Column, partition_cols: list[str] | None = None,
                   inclusive: bool = False) -> DataFrame:
    """Add ``{name}_before`` for each value: the sum over rows of the same
    partition group that come strictly before the row in ``order_cols``
    order (or up to and including it when ``inclusive``).

    ``bucket`` must never decrease along ``order_cols`` within a group."""
    part = list(partition_cols or [])
    hi = 0 if inclusive else -1
    d = df.withColumn("_bkt", bucket)
    for n, v in values.items():
        d = d.withColumn(f"_v_{n}", v)
    per_bucket = d.groupBy(*part, "_bkt").agg(
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    wb = Window.partitionBy(*part).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *part, "_bkt",
        *[F.coalesce(F.sum(f"_t_{n}").over(wb), F.lit(0)).alias(f"_o_{n}") for n in values])
    d = d.join(offsets, [*part, "_bkt"])
    w = (Window.partitionBy(*part, "_bkt").orderBy(*order_cols)
         .rowsBetween(Window.unboundedPreceding, hi))
    for n in values:
        d = d.withColumn(f"{n}_before",
                         F.col(f"_o_{n}") + F.coalesce(F.sum(f"_v_{n}").over(w), F.lit(0)))
    return d.drop("_bkt", *[f"_v_{n}" for n in values], *[f"_o_{n}" for n in values])
