"""The corpus pipeline: documents to packed token sequences, in five stages.

Each stage applies one operator of ``larch.llm`` to everything that the stage
before has kept. All but the last return the columns of documents:

1. language_id: documents without a recognised language go;
2. exact_dedup: one of each group of equal texts stays;
3. near_dedup: one of each class of near duplicates stays;
4. source_mixing: documents are sampled to the target mix of sources,
   languages and topics;
5. pattern_packing: what is left, cut and packed into token sequences (a row per
   piece with its sequence and offset).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larch.llm import exact_dedup, language_id, mixing, near_dedup, packing
from larch.llm.common import materialize, read_table, small_batches
from larch.llm.tokens import tokenizer_path


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return language_id.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return exact_dedup.keep_one_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_dedup.keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mixing.sample_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(materialize(packing.pieces_of(docs, tokenizer_path(), lean=True), "pieces"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("source_mixing", mix),
    ("pattern_packing", pack),
]

#: Language models, signatures and fitted patterns have no SQL form; tests/llm
#: holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
