"""Exact dedup by skew-safe combining (operator 9).

Texts are equal when identical after deleting ASCII white space. Of equal
texts the row with the most code points in its original text stays, then the
smallest id (null ids last).

Combining runs in three steps, each of which groups by the digest AND the
normalised text itself, so that full content is compared every time:

1. map-side partial aggregation merges the copies within a task;
2. groups are keyed by (digest, salt, text), so a group that holds a third of
   all rows is spread over ``salts`` reducers, each of which gets at most one
   row per task;
3. the salt winners (at most ``salts`` rows per group) meet by (digest, text).

Texts whose digest occurs once can have no equal and need not travel. They are
left out by a bitmap of the repeated digests: 512 KiB whatever the input. A bit shared by chance lets a few unique
texts through, which changes nothing but the bytes moved; a corpus with many
more repeated digests than bits moves every text once per step.

Defined cases: null text counts as empty (all empty texts form one group);
a null id loses ties and is returned as null; fully repeated rows each return a
row, one of which is kept; an empty table gives an empty result; columns other
than the id and the text are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.llm.common import ASCII_SPACE, flag_keys, key_bitmap, materialize, read_table, text_or_empty, whole_row

SALTS = 16


def _normalised(text: Column) -> Column:
    return F.regexp_replace(text, ASCII_SPACE + "+", "")


def _repeated_bitmap(rows: DataFrame) -> DataFrame:
    repeated = rows.groupBy("digest").agg(F.sum("copies").alias("n")).where("n > 1")
    return materialize(key_bitmap(repeated, "digest"), "repeated_bitmap")


def _keyed(docs: DataFrame, id_col: str, text_col: str, *keep: Column) -> DataFrame:
    return docs.select(
        *keep, F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"),
    ).withColumns(
        {"n_chars": F.length("text").cast("long"), "norm": _normalised(F.col("text"))},
    ).withColumn("digest", F.sha2("norm", 256)).withColumn("check", F.xxhash64("norm"))


def _best() -> Column:
    """Orders rows best first: most code points, then smallest id, null ids last."""
    return F.struct((-F.col("n_chars")).alias("neg_chars"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return materialize(
        _keyed(docs, id_col, text_col).groupBy("doc_id", "n_chars", "digest", "check")
        .agg(F.count("*").alias("copies")), "exact_rows")


def _salt(salts: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "n_chars"), F.lit(salts)).alias("salt")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = _rows(docs, id_col, text_col)
    maybe_repeated = flag_keys(_keyed(docs, id_col, text_col), "digest", _repeated_bitmap(rows)).where("maybe")
    salted = (
        maybe_repeated.groupBy("digest", "check", _salt(salts), "norm").agg(F.min(_best()).alias("best"), F.count("*").alias("n"))
    )
    winners = (
        salted.groupBy("digest", "check", "norm").agg(F.min("best").alias("best"), F.sum("n").alias("n"))
        .select("digest", "check", "best", "n")
    )
    out = rows.join(winners, ["digest", "check"], "left").select(
        "doc_id", "copies", "digest",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("n", "copies").alias("group_size"),
        (F.col("n").isNull() | _best().eqNullSafe(F.col("best"))).alias("is_best"),
    )
    # one output row per input row; of fully repeated best rows the first is kept
    return out.select(
        "doc_id", "keep_id", "group_size", "is_best", "digest", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("k"),
    ).select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        (F.col("is_best") & (F.col("k") == 1)).alias("kept"), F.col("digest").alias("text_sha256"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The documents that stay, with all their columns. Texts that occur once
    pass without a shuffle; the others carry their row through the combining."""
    flagged = flag_keys(_keyed(docs, id_col, text_col, whole_row(docs)), "digest", _repeated_bitmap(_rows(docs, id_col, text_col)))
    order = F.struct(_best().alias("best"), F.col("text"))
    salted = (
        flagged.where("maybe").groupBy("digest", "check", _salt(salts), "norm")
        .agg(F.min_by("row", order).alias("row"), F.min(order).alias("order")))
    winners = salted.groupBy("digest", "check", "norm").agg(F.min_by("row", "order").alias("row"))
    return flagged.where("NOT maybe").select("row.*").unionByName(winners.select("row.*"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


SQL = """
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents
), r AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER w AS keep_id,
         row_number() OVER w AS k,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM n
  WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id ASC NULLS LAST)
)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""
