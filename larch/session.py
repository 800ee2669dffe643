"""Session helpers: building a local session for tests and bench, and
locating the shared folder (``spark.checkpoint.dir``) for checkpoints,
run tables and saved pipelines."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "larch") -> SparkSession:
    """Local session for tests/bench. On a cluster the session comes from
    the launcher and only :func:`shared_dir` is used."""
    return (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def show_package(spark: SparkSession) -> None:
    """Lets Python workers of this machine import the package where the driver
    found it; on a cluster it comes with the job (``--py-files``)."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a local session (tests) gets a
    scratch folder; on a cluster that would be a disk of one machine, so it is
    an error."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="larch-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def workspace_path(spark: SparkSession, *parts: str) -> str:
    """Path under the shared folder for larch tables and artifacts."""
    base = spark.conf.get("larch.workspace.dir", None) or (shared_dir(spark) + "/larch")
    return "/".join([base.rstrip("/"), *parts])


def unique_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the workspace (one per run, never reused)."""
    return workspace_path(spark, *parts, uuid.uuid4().hex[:12])


ROWS_PER_PARTITION = 25_000


def target_partitions(n_rows: int) -> int:
    """Partitions of a persisted frame of ``n_rows`` rows that many fits read:
    a function of the rows alone, so the same data give the same fits on any
    number of cores."""
    return max(1, -(-n_rows // ROWS_PER_PARTITION))


def leaf(df: DataFrame) -> DataFrame:
    """The same rows and partitions, seen as one scan by later plans. The driver keeps a
    text of each plan that it runs, with those of all cached frames below; lost parts are
    still made anew."""
    return df.sparkSession.createDataFrame(df.rdd, df.schema, verifySchema=False)
