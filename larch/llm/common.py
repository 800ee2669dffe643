"""Helpers shared by the llm operators: table access and lineage cuts."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.session import unique_path

#: The ASCII white space of the contracts, as a Java / RE2 character class.
ASCII_SPACE = r"[\x20\x09-\x0D]"


def show_package(spark: SparkSession) -> None:
    """Lets Python workers of this machine import the package where the driver
    found it; on a cluster it comes with the job (``--py-files``)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    show_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of whole texts that go to a Python worker at a time.
TEXT_ROWS = 2000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Rows reach Python workers in batches of at most ``TEXT_ROWS``. Ten thousand texts, the
    default, are held by the JVM and by the worker several times over, in every task."""
    rows = int(spark.conf.get(_BATCH_ROWS))
    if not 0 < rows <= TEXT_ROWS:
        spark.conf.set(_BATCH_ROWS, str(TEXT_ROWS))


_HELD: dict[str, Callable[[], None]] = {}


def claim_memory(name: str, clear: Callable[[], None] | None = None) -> None:
    """Python workers live through many tasks: before an operator fills its
    dictionary, or does its work without one, those that other operators have left in
    this worker go, and the freed pages go back to the system."""
    others = [k for k in _HELD if k != name]
    for other in others:
        _HELD.pop(other)()
    if others:
        gc.collect()
        _trim()
    if clear:
        _HELD[name] = clear


def _trim() -> None:
    """Where the C library can (glibc), hands freed memory back."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage so that an executor loss costs one re-read, and keeps a
    frame that is used several times from being computed several times
    (``checkpoint()`` would compute it twice)."""
    spark = df.sparkSession
    path = unique_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, out of the way of names added by an operator."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


#: A bitmap of keys has 2 ** BITMAP_BITS bits (512 KiB) whatever the input.
BITMAP_BITS = 22


def _slot(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def key_bitmap(keys: DataFrame, key: str, bits: int = BITMAP_BITS) -> DataFrame:
    """The slots of the keys, 64 to a row: a table of bounded size to broadcast."""
    return (
        keys.select(_slot(key, bits).alias("slot")).select(
            F.floor(F.col("slot") / 64).alias("word"), F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("mask")))


def flag_keys(df: DataFrame, key: str, bitmap: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """Adds ``maybe``: false where the key is surely none of the bitmap's. A
    slot shared by chance makes it true, so true needs a second look."""
    bit = F.getbit("mask", (_slot(key, bits) % 64).cast("int")) == 1
    return (
        df.withColumn("word", F.floor(_slot(key, bits) / 64)).join(F.broadcast(bitmap), "word", "left")
        .withColumn("maybe", F.coalesce(bit, F.lit(False))).drop("word", "mask"))
