"""Trip scans.

Two ways in:

* :func:`read_trips` reads real monthly trip parquet files with a declared
  schema (no inference), turns NaN into NULL once at the scan and adds a
  ``year_month`` column. Several months are one scan, not a loop.
* :func:`trips_from_events` projects the driver's ``events`` table onto the
  trip schema (the test fixture). It is a pure projection, so Catalyst prunes
  the ``events`` scan to the four columns it uses.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns the trip code touches, with the type their use implies.
TRIP_SCHEMA = T.StructType([
    T.StructField("lpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("lpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("PULocationID", T.LongType()),
    T.StructField("DOLocationID", T.LongType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("RatecodeID", T.DoubleType()),
    T.StructField("trip_type", T.DoubleType()),
    T.StructField("payment_type", T.DoubleType()),
    T.StructField("passenger_count", T.DoubleType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
])

TRIP_COLUMNS = ["trip_id"] + [f.name for f in TRIP_SCHEMA.fields]


def _nan_to_null(c: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(c), F.lit(None).cast(dtype)).alias(c)
    return F.col(c)


def year_month_col(ts: str = "lpep_pickup_datetime") -> Column:
    """``yyyy-MM`` of a local timestamp (independent of the session zone)."""
    return F.format_string("%04d-%02d", F.year(F.col(ts)), F.month(F.col(ts)))


#: In a file's name, or in that of the folder that holds its parts.
MONTH_IN_NAME = r"(\d{4}-\d{2})[^/]*(?:/part-[^/]*)?$"


def file_month(ts: str = "lpep_pickup_datetime") -> Column:
    """``yyyy-MM`` of the monthly file a row comes from (a file holds a few
    stray pickups of other months, and counts go by file); the pickup's month
    where the file name has none."""
    found = F.regexp_extract(F.col("_metadata.file_path"), MONTH_IN_NAME, 1)
    return F.coalesce(F.nullif(found, F.lit("")), year_month_col(ts))


def check_columns(spark: SparkSession, paths: list[str], needed: list[str]) -> None:
    """A column that a file lacks would silently read as NULL: fail early."""
    for path in paths:
        missing = sorted(set(needed) - set(spark.read.parquet(path).columns))
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}")


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a local timestamp (zone free)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND",
                            F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def read_trips(spark: SparkSession, paths: str | Iterable[str],
               key: str | None = None, optional: Iterable[str] = ()) -> DataFrame:
    """Read one or many monthly trip files in one scan.

    Every column of the schema must be in every file, but for ``optional``
    ones, which are left out of the frame if the first file lacks them (a
    month to score has no dropoff or tip). ``year_month`` is the file's.

    Location ids become strings (P1). ``trip_id`` is taken from ``key`` when
    the files carry one; otherwise it is a hash of pickup, dropoff, both
    locations and the fare, so it does not depend on file layout.
    """
    if isinstance(paths, str):
        paths = [paths]
    paths = list(paths)
    there = set(spark.read.parquet(paths[0]).columns)
    fields = [f for f in TRIP_SCHEMA.fields if f.name in there or f.name not in set(optional)]
    if key:
        fields.append(T.StructField(key, T.LongType()))
    check_columns(spark, paths, [f.name for f in fields])
    df = spark.read.schema(T.StructType(fields)).parquet(*paths)
    identity = [c for c in ("lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID", "fare_amount")
                if c in df.columns]
    df = df.select((F.col(key) if key else F.xxhash64(*identity)).alias("trip_id"), file_month().alias("year_month"),
                   *[_nan_to_null(f.name, f.dataType) for f in fields if f.name != key])
    return (df.withColumn("PULocationID", F.col("PULocationID").cast("string"))
              .withColumn("DOLocationID", F.col("DOLocationID").cast("string")))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture trips view over the driver's ``events`` table."""
    return project_events(read_table(spark, sf_dir, "events"))


def project_events(ev: DataFrame) -> DataFrame:
    """Project ``events`` rows onto the trip schema (batch or streaming).

    Nulls are injected by rule so that imputation, the payment filter and
    the tip label all see missing values; see FIXTURES.md B.
    """
    eid, uid, val, ts = F.col("event_id"), F.col("user_id"), F.col("value"), F.col("ts")
    null_d = F.lit(None).cast("double")
    hour = F.hour(ts)
    return ev.select(
        eid.alias("trip_id"),
        ts.alias("lpep_pickup_datetime"),
        F.timestamp_add("MICROSECOND", F.round(val * 60000000).cast("bigint"), ts)
        .alias("lpep_dropoff_datetime"),
        uid.cast("string").alias("PULocationID"),
        (eid % 7).cast("string").alias("DOLocationID"),
        F.when(eid % 13 == 0, F.lit(None).cast("string"))
        .when(eid % 4 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("store_and_fwd_flag"),
        F.when(eid % 17 == 0, null_d).otherwise((1 + uid % 3).cast("double")).alias("RatecodeID"),
        F.when(eid % 19 == 0, null_d).otherwise((1 + eid % 2).cast("double")).alias("trip_type"),
        F.when(F.col("event_type").isin("view", "click", "purchase"), F.lit(1.0))
        .when(F.col("event_type") == "error", F.lit(2.0)).otherwise(null_d).alias("payment_type"),
        F.when(eid % 11 == 0, null_d).otherwise((1 + eid % 5).cast("double")).alias("passenger_count"),
        (val * F.lit(0.2)).alias("trip_distance"),
        (F.lit(2.5) + val * F.lit(0.5)).alias("fare_amount"),
        F.when((hour >= 16) & (hour < 20), F.lit(1.0)).otherwise(F.lit(0.0)).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.lit(0.3).alias("improvement_surcharge"),
        F.when(eid % 9 == 0, F.lit(6.55)).otherwise(F.lit(0.0)).alias("tolls_amount"),
        F.when(eid % 23 == 0, null_d)
        .when((val > 30) & (eid % 5 != 0), val * F.lit(0.15)).otherwise(F.lit(0.0)).alias("tip_amount"),
    ).withColumn("year_month", year_month_col())


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip table used by every registered query."""
    return trips_from_events(spark, sf_dir)
