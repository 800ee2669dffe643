"""Derived targets, row filters and feature lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larch.functions import scalar as S

# Target names and feature lists of the two tasks.
TARGET_REGRESSION = "duration"
TARGET_CLASSIFICATION = "tipped"

CALENDAR_COLUMNS = [
    "lpep_pickup_datetime_week",
    "lpep_pickup_datetime_day",
    "lpep_pickup_datetime_hour",
    "lpep_pickup_datetime_minute",
    "lpep_pickup_datetime_dayofweek",
]

REGRESSION_NUMERIC = ["passenger_count"] + CALENDAR_COLUMNS
REGRESSION_CATEGORICAL = ["PU_DO", "store_and_fwd_flag"]

CLASSIFICATION_NUMERIC = [
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "improvement_surcharge",
    "tolls_amount",
] + CALENDAR_COLUMNS
CLASSIFICATION_CATEGORICAL = ["PU_DO", "store_and_fwd_flag", "RatecodeID", "trip_type"]


def target_for(task_type: str) -> str:
    """Task dispatch."""
    if task_type == "regression":
        return TARGET_REGRESSION
    if task_type == "classification":
        return TARGET_CLASSIFICATION
    raise TypeError("Target not available for the requested task")


def feature_lists(task_type: str) -> tuple[list[str], list[str]]:
    target_for(task_type)
    if task_type == "regression":
        return list(REGRESSION_NUMERIC), list(REGRESSION_CATEGORICAL)
    return list(CLASSIFICATION_NUMERIC), list(CLASSIFICATION_CATEGORICAL)


def with_duration(df: DataFrame) -> DataFrame:
    """Trip duration in fractional minutes."""
    return df.withColumn(TARGET_REGRESSION,
                         S.minutes_between("lpep_pickup_datetime", "lpep_dropoff_datetime"))


def duration_in_range(df: DataFrame, lo: float = 1.0, hi: float = 60.0) -> DataFrame:
    """Keep lo <= duration <= hi (both inclusive, NULL dropped)."""
    return df.filter(F.col(TARGET_REGRESSION).between(lo, hi))


def card_trips_with_tip_label(df: DataFrame) -> DataFrame:
    """Card trips only (cash trips leak the label), ``tipped`` =
    tip > 0 with a missing tip counted as 0, then the tip column dropped."""
    return (df.filter(F.col("payment_type") == 1)
              .withColumn(TARGET_CLASSIFICATION,
                          F.coalesce(F.col("tip_amount") > 0, F.lit(False)).cast("int"))
              .drop("tip_amount"))


def task_frame(df: DataFrame, task_type: str, request_target: bool = True) -> DataFrame:
    """Rows and label for a task. The label stays in the frame.

    When the input cannot produce the label (a month to score, without the
    columns the target needs) the frame is returned without it, unless the
    caller requested the target.
    """
    target = target_for(task_type)
    if task_type == "regression":
        if "lpep_dropoff_datetime" in df.columns:
            return duration_in_range(with_duration(df))
    elif "tip_amount" in df.columns and "payment_type" in df.columns:
        return card_trips_with_tip_label(df)
    elif "payment_type" in df.columns:
        df = df.filter(F.col("payment_type") == 1)
    if request_target and target not in df.columns:
        raise TypeError("Target variable not found")
    return df


def with_calendar_and_pair(df: DataFrame) -> DataFrame:
    """Pickup calendar parts and the PU_DO pair key."""
    ts = "lpep_pickup_datetime"
    return df.select(
        "*",
        S.iso_week(ts).alias("lpep_pickup_datetime_week"),
        S.day_of_month(ts).alias("lpep_pickup_datetime_day"),
        S.hour_of_day(ts).alias("lpep_pickup_datetime_hour"),
        S.minute_of_hour(ts).alias("lpep_pickup_datetime_minute"),
        S.weekday_monday0(ts).alias("lpep_pickup_datetime_dayofweek"),
        S.pair_key("PULocationID", "DOLocationID").alias("PU_DO"),
    )


def feature_columns(df: DataFrame, task_type: str, keep: list[str] | None = None) -> DataFrame:
    """Key, split/label columns and the task's raw features.

    Numeric features are doubles from here on (they are mean-imputed)."""
    num, cat = feature_lists(task_type)
    target = target_for(task_type)
    keep = list(keep or [])
    base = [c for c in ["trip_id", *keep] if c in df.columns]
    label = [target] if target in df.columns else []
    return with_calendar_and_pair(df).select(
        *base, *[F.col(c).cast("double").alias(c) for c in num], *cat, *label)
