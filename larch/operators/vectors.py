"""Sums of one vector per task, and rows of sparse features as plain arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larch.session import show_package

#: Vectors that one task or the driver adds up at a time.
FAN_IN = 64


def added(parts: DataFrame, n: int) -> np.ndarray | None:
    """The sum of vectors of doubles (at long, v binary), ``FAN_IN`` or so at a time;
    n: how many there may be."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        v = sum(np.frombuffer(x) for x in frame.sort_values("at")["v"])
        return pd.DataFrame({"at": [int(frame["at"].min())], "v": [v.tobytes()]})

    while n > FAN_IN:
        n = -(-n // FAN_IN)
        parts = parts.groupBy(F.pmod("at", F.lit(n))).applyInPandas(merge, "at long, v binary")
    rows = sorted(parts.collect())
    return sum(np.frombuffer(r["v"]) for r in rows) if rows else None


def sparse_rows(df: DataFrame, features: str, label: str, *keep: str) -> DataFrame:
    """label, columns and values of the non-zero features, and the ``keep`` columns."""
    show_package(df.sparkSession)
    kept = df.select(*keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            columns, values = [], []
            for v in b["_features"]:
                if v["type"] == 0:  # a vector comes as its struct; 0 is sparse
                    columns.append(v["indices"])
                    values.append(v["values"])
                else:
                    x = np.asarray(v["values"])
                    columns.append(np.flatnonzero(x))
                    values.append(x[columns[-1]])
            yield b.drop(columns="_features").assign(columns=columns, values=values)

    schema = "label double, " + "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields) + "columns array<int>, values array<double>"
    return df.select(F.col(label).cast("double").alias("label"), *keep, F.col(features).alias("_features")).mapInPandas(run, schema)
