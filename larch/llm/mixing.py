"""Mixing sources to target weights by iterative proportional fitting (operator 5).

Tokens are summed per cell (source, language, topic). Raking multiplies, in
turn, the cells of each source, language and topic by the factor that brings
their kept tokens to that category's target, with no cell kept more than once or trimmed below
``MIN_PROBABILITY``;
categories whose cells are all kept whole stay below an unreachable target. A
cell's factor is the probability with which each of its documents is sampled,
by a hash of id and text, so a rerun takes the same documents.

Targets: a source's (language's, topic's) share is its share of tokens to the
power ``temperature``, normalised, of ``budget`` times all tokens. Shares may
also be given.

Topic: the one of ``TOPICS`` vocabularies that the document uses most above its
language's rate. Vocabularies split all words by a hash, so no list is needed; a
document without words has topic 0. Tokens are words between ASCII white space.

Sizes: every source and language is raked by itself. Up to ``DRIVER_CELLS`` cells
are raked on the driver and joined back as a broadcast; with more, cells and
factors stay tables and each step of a round is one aggregate over the cells, with
the same targets, bounds and end, so that the probabilities are the same.

Defined cases: null source or language is a category of its own; null or empty
text has no tokens, does not count towards a target and is sampled with its
cell's probability; repeated rows share their draw; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.llm.common import claim_memory, materialize, read_table, whole_row

TOPICS = 8
#: Cells that the driver rakes; more are raked as tables.
DRIVER_CELLS = 200_000
BUDGET = 0.6
TEMPERATURE = 0.7
#: Weights are trimmed here, so that no cell dies out.
MIN_PROBABILITY = 0.05
#: Factors of targets that can't be reached stop here, so that their products are finite.
MAX_FACTOR = 1e100
ROUNDS = 500
TOLERANCE = 1e-9
SEED = 17
DIMENSIONS = ("source", "lang", "topic")
NULL = "\x00null"


def topic_counts(text: str | None) -> list[int]:
    """Words of each topic's vocabulary in a text."""
    out = [0] * TOPICS
    for w, n in Counter((text or "").lower().encode("utf-8", "surrogatepass").split()).items():
        out[zlib.crc32(w) % TOPICS] += n
    return out


def _counts_column(text: Column) -> Column:
    @F.pandas_udf("array<long>")
    def run(texts: pd.Series) -> pd.Series:
        claim_memory("mixing")
        return pd.Series([topic_counts(t) for t in texts], dtype=object)

    return run(text)


def _category(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(NULL))


def document_counts(docs: DataFrame, *keep: Column, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """doc_id, source, lang, word counts per topic and the sampling draw in [0, 1)."""
    text = F.col(f"`{text_col}`").cast("string")
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col(f"`{id_col}`"), text), F.lit(1 << 52)) / float(1 << 52)
    return docs.select(
        *keep, F.col(f"`{id_col}`").alias("doc_id"), _category(source_col).alias("source"), _category(lang_col).alias("lang"),
        draw.alias("draw"), _counts_column(text).alias("by_topic"))


def _with_tokens(counted: DataFrame) -> DataFrame:
    return counted.withColumn("tokens", F.aggregate("by_topic", F.lit(0).cast("long"), lambda a, x: a + x))


def topic_rates(rows: DataFrame) -> DataFrame:
    """(lang, rates): each topic's share of a language's words."""
    sums = F.array(*(F.sum(F.col("by_topic")[k]) for k in range(TOPICS)))
    table = rows.groupBy("lang").agg(sums.alias("sums"), F.sum("tokens").alias("of"))
    return table.select("lang", F.transform("sums", lambda n: n / F.greatest(F.col("of"), F.lit(1))).alias("rates"))


def _with_topic(rows: DataFrame, rates: DataFrame) -> DataFrame:
    above = F.zip_with("by_topic", "rates", lambda n, r: n / F.greatest(F.col("tokens"), F.lit(1)) - r)
    return rows.join(rates, "lang").withColumn("above", above).withColumn(
        "topic", (F.array_position("above", F.array_max("above")) - 1).cast("int").cast("string"))


def rake(cells: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """Probabilities in [MIN_PROBABILITY, 1] with sum(cells * p) per category as
    near to its target as that allows. codes[d][i]: the category of cell i in
    dimension d."""
    factors = [np.ones(len(t)) for t in targets]

    def p() -> np.ndarray:
        out = np.ones(len(cells))
        for f, c in zip(factors, codes, strict=True):
            out = out * f[c]
        return np.clip(out, MIN_PROBABILITY, 1.0)

    for _ in range(rounds):
        worst = 0.0
        for f, c, t in zip(factors, codes, targets, strict=True):
            have = np.bincount(c, cells * p(), len(t))
            step = np.where(have > 0, t / np.maximum(have, 1e-300), 1.0)
            now = p()
            up, down = (np.bincount(c, cells * x, len(t)) > 0 for x in (now < 1, now > MIN_PROBABILITY))
            step = np.where((step > 1) & ~up | (step < 1) & ~down, 1.0, step)  # at its bounds: no more to gain
            np.minimum(f * step, MAX_FACTOR, out=f)
            worst = max(worst, np.abs(step - 1).max(initial=0.0))
        if worst < TOLERANCE:
            break
    return p()


def target_tokens(totals: np.ndarray, budget: float, temperature: float) -> np.ndarray:
    weight = np.where(totals > 0, np.maximum(totals, 1e-300) ** temperature, 0.0)
    return budget * totals.sum() * weight / max(weight.sum(), 1e-300)


def cell_probabilities(cells: pd.DataFrame, budget: float = BUDGET, temperature: float = TEMPERATURE,
                       shares: dict[str, dict[str, float]] | None = None) -> pd.DataFrame:
    """source, lang, topic, p of every cell; ``shares`` replaces a dimension's targets."""
    tokens, codes, targets = cells["tokens"].to_numpy(dtype=float), [], []
    for d in DIMENSIONS:
        code, names = pd.factorize(cells[d], sort=True)
        totals = np.bincount(code, tokens, len(names))
        given = (shares or {}).get(d)
        targets.append(np.array([given.get(x, 0.0) for x in names]) * budget * tokens.sum() if given
                       else target_tokens(totals, budget, temperature))
        codes.append(code)
    return cells[list(DIMENSIONS)].assign(p=rake(tokens, codes, targets) if len(cells) else np.zeros(0))


def table_probabilities(cells: DataFrame, budget: float = BUDGET, temperature: float = TEMPERATURE,
                        shares: dict[str, dict[str, float]] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """cell_probabilities for a table of any number of cells and categories."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    factors: dict[str, DataFrame] = {}
    for d in DIMENSIONS:
        totals = cells.groupBy(d).agg(F.sum("tokens").alias("n"))
        if given := (shares or {}).get(d):
            table = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in given.items()], f"{d} string, share double")
            aimed = totals.join(table, d, "left").withColumn("target", F.coalesce("share", F.lit(0.0)) * (budget * total))
        else:
            totals = totals.withColumn("weight", F.when(F.col("n") > 0, F.pow("n", F.lit(temperature))).otherwise(0.0))
            of = max(totals.agg(F.sum("weight")).first()[0] or 0.0, 1e-300)
            aimed = totals.withColumn("target", F.col("weight") * (budget * total / of))
        factors[d] = materialize(aimed.select(d, "target", F.lit(1.0).alias("factor"), F.lit(1.0).alias("step")), f"{d}_factors")

    def weighted() -> DataFrame:
        rows, p = cells, F.lit(1.0)
        for d in DIMENSIONS:
            rows = rows.join(factors[d].select(d, F.col("factor").alias(f"{d}_factor")), d)
            p = p * F.col(f"{d}_factor")
        return rows.withColumn("p", F.least(F.greatest(p, F.lit(MIN_PROBABILITY)), F.lit(1.0)))

    for _ in range(rounds):
        for d in DIMENSIONS:
            have = weighted().groupBy(d).agg(
                F.sum(F.col("tokens") * F.col("p")).alias("have"),
                F.sum(F.when(F.col("p") < 1, F.col("tokens")).otherwise(0)).alias("up"),
                F.sum(F.when(F.col("p") > MIN_PROBABILITY, F.col("tokens")).otherwise(0)).alias("down"))
            step = F.when(F.col("have") > 0, F.col("target") / F.greatest("have", F.lit(1e-300))).otherwise(1.0)
            stuck = (step > 1) & (F.col("up") <= 0) | (step < 1) & (F.col("down") <= 0)
            moved = factors[d].drop("step").join(have, d).withColumn("step", F.when(stuck, 1.0).otherwise(step))
            factors[d] = materialize(moved.select(
                d, "target", F.least(F.col("factor") * F.col("step"), F.lit(MAX_FACTOR)).alias("factor"), "step"), f"{d}_factors")
        if max(t.agg(F.max(F.abs(F.col("step") - 1))).first()[0] or 0.0 for t in factors.values()) < TOLERANCE:
            break
    return materialize(weighted().select(*DIMENSIONS, "p"), "cell_probabilities")


class Mix:
    """What raking has found: topic rates and cell probabilities."""

    def __init__(self, docs: DataFrame, budget: float, temperature: float, shares: dict[str, dict[str, float]] | None) -> None:
        counted = materialize(document_counts(docs), "topic_counts")
        rows = _with_tokens(counted)
        # written, so that it is computed once
        self.rates = materialize(topic_rates(rows), "topic_rates")
        self.rows = _with_topic(rows, self.rates)
        cells = materialize(self.rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
        if cells.count() > DRIVER_CELLS:
            self.cells = table_probabilities(cells, budget, temperature, shares)
        else:
            p = cell_probabilities(cells.toPandas(), budget, temperature, shares)
            self.cells = F.broadcast(docs.sparkSession.createDataFrame(
                list(p.itertuples(index=False, name=None)), "source string, lang string, topic string, p double"))

    def topics_of(self, counted: DataFrame) -> DataFrame:
        return _with_topic(_with_tokens(counted), self.rates)

    def decide(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.cells, list(DIMENSIONS)).withColumn("sampled", F.col("draw") < F.col("p"))


def _shown(name: str) -> Column:
    return F.when(F.col(name) != NULL, F.col(name)).alias(name)


def mix_documents(docs: DataFrame, budget: float = BUDGET, temperature: float = TEMPERATURE,
                  shares: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability, sampled of every document."""
    mix = Mix(docs, budget, temperature, shares)
    return mix.decide(mix.rows).select(
        "doc_id", _shown("source"), _shown("lang"), F.col("topic").cast("int").alias("topic"), "tokens",
        F.col("p").alias("probability"), "sampled")


def sample_documents(docs: DataFrame, budget: float = BUDGET, temperature: float = TEMPERATURE,
                     shares: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """The sampled documents with all their columns. Topics are found anew on
    the way instead of moving every text to a join."""
    mix = Mix(docs, budget, temperature, shares)
    rows = mix.topics_of(document_counts(docs, whole_row(docs)))
    return mix.decide(rows).where("sampled").select("row.*")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(read_table(spark, sf_dir, "documents"))
