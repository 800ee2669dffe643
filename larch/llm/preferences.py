"""Preference formatting of chosen and rejected conversations (operator 7).

DataFrame functions only. Of each pair the longest common prefix of turns is
rendered once as the prompt; the remaining turns of either side become its
completion, with a mask of character spans [start, end) that are trained on:
what the assistant says and the mark that ends its turn.

Turns render as ``<|im_start|>role\\ntext<|im_end|>\\n``.

The table of conversations holds no judgements, so the query makes its pairs:
chosen is a whole conversation; it forks at one of its replies, the one numbered
conv_id modulo their count, and rejected ends there, with that reply replaced by the
one at which the next conversation forks, in blocks of ``BLOCK`` consecutive ids
(the last takes the first's). A block has at most ``BLOCK`` distinct ids, so no
window grows with the input. Prompt and chosen completion hold every turn.

Defined cases: a null role reads as "unknown", a null text as empty; turns sort
by turn, role, text, repeated rows stay as turns; rows with a null conv_id form
one conversation; equal sides have everything as prompt and empty completions
with empty masks; a missing rejected side is null, with the chosen side's last
turn as its completion; a conversation without an assistant turn is prompt
only; an empty table gives an empty result. A conversation is one value of a
row and bounds the memory of a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larch.llm.common import read_table

# Fixed values of the chat mark-up.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
BLOCK = 64


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order: array<struct<role, text>>."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit("\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(END + "\n"))), "")


def trained_spans(turns: Column) -> Column:
    """Spans of the rendered turns that the loss covers."""
    span = "struct<start:int,end:int>"

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(_head(t))
        end = start + F.length(t["text"]) + F.lit(len(END))
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(t["role"] == TRAINED_ROLE, F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans"))
    return F.aggregate(turns, none, step, lambda acc: acc["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    shorter = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, shorter), F.slice(b, 1, shorter), lambda x, y: x.eqNullSafe(y))
    first_other = F.array_position(same, False)
    return F.when(first_other == 0, shorter).otherwise(first_other - 1).cast("int")


def format_preferences(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected", keep: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """prompt, completions and masks of every pair."""
    c, r = F.col(chosen), F.col(rejected)
    last_is_reply = F.size(c) - F.when(F.element_at(c, -1)["role"] == TRAINED_ROLE, 1).otherwise(0)
    n = F.when(F.size(c) <= 0, F.lit(0)).when(r.isNull(), last_is_reply).otherwise(common_turns(c, r))
    split = pairs.select(*keep, c.alias("c"), r.alias("r"), n.cast("int").alias("n_prompt_turns"))

    def rest(name: str) -> Column:
        return F.slice(name, F.col("n_prompt_turns") + 1, F.greatest(F.size(name) - F.col("n_prompt_turns"), F.lit(0)))

    parts = split.select(
        *keep, "n_prompt_turns", F.slice("c", 1, F.col("n_prompt_turns")).alias("p"),
        rest("c").alias("c"), F.when(F.col("r").isNotNull(), rest("r")).alias("r"))
    return parts.select(
        *keep, "n_prompt_turns", render(F.col("p")).alias("prompt"),
        render(F.col("c")).alias("chosen_completion"), trained_spans(F.col("c")).alias("chosen_mask"),
        F.when(F.col("r").isNotNull(), render(F.col("r"))).alias("rejected_completion"),
        F.when(F.col("r").isNotNull(), trained_spans(F.col("r"))).alias("rejected_mask"))


def replaced_reply_pairs(convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id (a number), chosen, rejected (null without a partner or a reply)."""
    replies = F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED_ROLE, i + 1)), lambda i: i.isNotNull())
    at = convs.withColumn("replies", replies).withColumn(
        "k", F.when(F.size("replies") > 0, F.element_at("replies", (F.pmod(F.coalesce("conv_id", F.lit(0)), F.greatest(F.size("replies"), F.lit(1))) + 1).cast("int"))))
    reply = F.when(F.col("k").isNotNull(), F.element_at("turns", F.col("k"))["text"])
    w = Window.partitionBy(F.floor(F.col("conv_id") / block), F.col("k").isNull()).orderBy("conv_id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    partner = F.when(F.count("*").over(whole) > 1, F.coalesce(F.lead("reply").over(w), F.first("reply").over(whole)))
    other = F.struct(F.lit(TRAINED_ROLE).alias("role"), F.col("partner").alias("text"))
    return at.withColumn("reply", reply).withColumn("partner", F.when(F.col("k").isNotNull(), partner)).select(
        "conv_id", F.col("turns").alias("chosen"),
        F.when(F.col("partner").isNotNull(), F.concat(F.slice("turns", 1, F.col("k") - 1), F.array(other))).alias("rejected"))


def _written(mask: str) -> Column:
    return F.array_join(F.transform(mask, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation; masks are written as "start-end,..."."""
    return format_preferences(replaced_reply_pairs(conversations(read_table(spark, sf_dir, "conversations")))).select(
        "conv_id", "n_prompt_turns", "prompt", "chosen_completion", "rejected_completion",
        _written("chosen_mask").alias("chosen_mask"), _written("rejected_mask").alias("rejected_mask"))


SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS i
  FROM conversations
), a AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i) - 1 AS nth, count(*) OVER (PARTITION BY conv_id) AS replies FROM t WHERE role = 'assistant'
), f AS (
  SELECT conv_id, i AS k, text AS reply FROM a WHERE nth = coalesce(conv_id, 0) % replies
), r AS (
  SELECT conv_id, k, reply, coalesce(lead(reply) OVER w, first_value(reply) OVER w) AS partner,
         count(*) OVER (PARTITION BY floor(conv_id / 64.0)) AS peers
  FROM f WINDOW w AS (PARTITION BY floor(conv_id / 64.0) ORDER BY conv_id)
), n AS (
  SELECT conv_id, count(*) AS n, arg_max(role, i) AS last_role FROM t GROUP BY conv_id
), p AS (
  SELECT n.conv_id, CASE WHEN peers > 1 THEN partner END AS partner, peers > 1 AND partner <> reply AS split,
         CASE WHEN k IS NULL OR peers <= 1 THEN n.n - CASE WHEN last_role = 'assistant' THEN 1 ELSE 0 END
              WHEN partner = reply THEN k ELSE k - 1 END AS np
  FROM n LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM n.conv_id
), x AS (
  SELECT t.conv_id, t.i, t.role, length(t.role) AS role_chars, length(t.text) AS chars, t.i <= p.np AS in_prompt,
         '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10) AS rendered
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), y AS (
  SELECT *, coalesce(sum(length(rendered)) OVER (PARTITION BY conv_id, in_prompt ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 13 + role_chars AS start
  FROM x
), z AS (
  SELECT conv_id, coalesce(string_agg(CASE WHEN in_prompt THEN rendered END, '' ORDER BY i), '') AS prompt,
         coalesce(string_agg(CASE WHEN NOT in_prompt THEN rendered END, '' ORDER BY i), '') AS chosen_completion,
         coalesce(string_agg(CASE WHEN NOT in_prompt AND role = 'assistant' THEN CAST(start AS BIGINT) || '-' || CAST(start + chars + 10 AS BIGINT) END, ',' ORDER BY i), '') AS chosen_mask
  FROM y GROUP BY conv_id
)
SELECT p.conv_id, CAST(np AS INTEGER) AS n_prompt_turns, prompt, chosen_completion, chosen_mask,
       CASE WHEN partner IS NULL THEN NULL
            WHEN split THEN '<|im_start|>assistant' || chr(10) || partner || '<|im_end|>' || chr(10) ELSE '' END AS rejected_completion,
       CASE WHEN partner IS NULL THEN NULL WHEN split THEN '22-' || (32 + length(partner)) ELSE '' END AS rejected_mask
FROM p JOIN z ON z.conv_id IS NOT DISTINCT FROM p.conv_id
"""
