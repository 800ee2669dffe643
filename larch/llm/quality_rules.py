"""Quality rules combined by weak supervision (operator 3).

Every rule votes good (1), bad (-1) or abstains (0) on a document. Votes are a
pattern, and the corpus is summed up as one count per pattern. Expectation
maximisation over these counts estimates the share of good documents and, for
each rule, how often it votes good, bad or not at all on either kind of
document; from that follow the rules' accuracies and the posterior probability
that a document with a given pattern is good. A document is kept when that is
at least ``threshold`` and it passes the base rules, instead of having to pass
every rule.

The counts cover all documents. What reaches the driver is one row per vote
pattern, at most 3 ** len(RULES) = 59,049 whatever the input.

Words are runs of characters other than ASCII white space; a text is read whole.

Defined cases: null text has no words (base_failed); a null id is returned as
null; repeated rows give repeated rows; an empty table gives an empty result;
only the id and the text are read. A text is one value of a row, so memory is
bounded by the longest text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.llm.common import materialize, read_table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_PROBABILITY = 0.5
EM_ROUNDS = 200
EM_TOLERANCE = 1e-9
#: Votes that each rule is taken to have cast beforehand on either kind of document.
PRIOR_VOTES = 5.0
SYMBOLS = "#*$%&|<>"

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
         "n_top_word", "n_letter_words", "n_plain_words", "n_upper_words", "n_short_words", "n_marks", "n_full_lines"]


def text_stats(text: str | None) -> tuple[int, ...]:
    """The counts in STATS of one text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space only
    n = len(words)
    if not n:
        return (0,) * len(STATS)
    counts = Counter(words)
    repeated, seen = 0, set()
    if n > 2 and len(seen := set(zip(words, words[1:], words[2:], strict=False))) < n - 2:
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        covered_to = 0
        for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)):
            if windows[w] > 1:
                repeated += i + 3 - max(i, covered_to)
                covered_to = i + 3
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    letters = plain = upper = short = 0
    for s, k in zip(b"\n".join(counts).decode("utf-8", "surrogatepass").split("\n"), counts.values(), strict=True):
        if not s.isalpha():
            if not any(map(str.isalpha, s)):
                continue
            s = s.strip(".,;:!?\"'()")
            plain += k * (s.isalpha() or s.replace("-", "").replace("'", "").isalpha())
        else:
            plain += k
        letters += k
        if len(s) <= 3:
            short += k
        if s.isupper() and len(s) > 1:
            upper += k
    full = sum(x.rstrip().endswith((b".", b"!", b"?", b":", b"\"", b"'", b")")) for x in lines)
    spaces = sum(map(text.count, " \t\n\x0b\x0c\r"))
    return (n, len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines),
            len(counts), max(counts.values()), letters, plain, upper, short, text.count("!") + text.count("?"), full)


def _bad_above(share: str, of: str, limit: float):
    return lambda s: -1 * (s[share] > limit * s[of])


def _bad_below(share: str, of: str, limit: float):
    return lambda s: -1 * (s[share] < limit * s[of])


def _good_if(*tests):
    return lambda s: np.logical_and.reduce([t(s) for t in tests]).astype(int)


#: name -> votes of a frame of STATS. Several rules speak of one defect, since
#: EM weighs a rule by its agreement with the others.
RULES = {
    "symbols": _bad_above("n_symbols", "n_words", 0.1),
    "plain_words": _bad_below("n_plain_words", "n_words", 0.75),
    "upper_words": _bad_above("n_upper_words", "n_words", 0.3),
    "marks": _bad_above("n_marks", "n_words", 0.2),
    "repeated_words": _bad_above("n_repeat_words", "n_words", 0.3),
    "repeated_lines": _bad_above("n_dup_lines", "n_lines", 0.3),
    "vocabulary": lambda s: -1 * ((s["n_distinct"] < 0.3 * s["n_words"] ** 0.9) | (s["n_top_word"] > 0.25 * s["n_words"])),
    "prose": _good_if(lambda s: s["n_plain_words"] > 0.9 * s["n_words"], lambda s: s["n_upper_words"] < 0.1 * s["n_words"],
                      lambda s: s["word_chars"].between(3 * s["n_words"], 10 * s["n_words"])),
    "sentences": _good_if(lambda s: s["n_full_lines"] >= 0.7 * s["n_lines"], lambda s: s["n_symbols"] < 0.02 * s["n_words"],
                          lambda s: s["n_marks"] < 0.1 * s["n_words"]),
    "variety": _good_if(lambda s: s["n_repeat_words"] <= 0.1 * s["n_words"], lambda s: s["n_dup_lines"] <= 0.1 * s["n_lines"],
                        lambda s: s["n_short_words"].between(0.1 * s["n_words"], 0.7 * s["n_words"])),
}


def votes_of_pattern(pattern: int) -> list[int]:
    return [pattern // 3 ** j % 3 - 1 for j in range(len(RULES))]


def _vote_patterns(stats: pd.DataFrame) -> np.ndarray:
    return sum((np.asarray(rule(stats), dtype=np.int64) + 1) * 3 ** j for j, rule in enumerate(RULES.values()))


def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the STATS and the vote pattern of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = pd.DataFrame([text_stats(t) for t in b["text"]], columns=STATS, dtype="int64")
            yield s.assign(doc_id=b["doc_id"].values, pattern=_vote_patterns(s))[["doc_id", *STATS, "pattern"]]

    kind = dict(docs.dtypes)[id_col]
    return docs.selectExpr(f"`{id_col}` AS doc_id", f"cast(`{text_col}` AS string) AS text").mapInPandas(
        run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in STATS) + ", pattern long")


def fit_label_model(counts: dict[int, int]) -> tuple[dict[int, float], pd.DataFrame]:
    """EM over the counts of vote patterns: the posterior of each pattern and
    each rule's estimated accuracy and coverage."""
    if not counts:
        return {}, pd.DataFrame({"rule": list(RULES), "accuracy": np.nan, "coverage": 0.0})
    patterns = sorted(counts)
    votes = np.array([votes_of_pattern(p) for p in patterns])  # P x R
    n = np.array([counts[p] for p in patterns], dtype=float)
    cast = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)  # P x R x 3
    # rules are presumed better than chance: a rule's prior votes lean its way
    base = np.einsum("p,prv->rv", n, cast) / n.sum()
    lean = np.array([[1.6, 1.0, 0.4], [0.4, 1.0, 1.6]])  # kind (bad, good) x vote
    prior = np.stack([(w := (base + 0.02) * lean[k]) / w.sum(axis=1, keepdims=True) for k in (0, 1)])  # kind x R x 3
    good = np.where(votes.sum(axis=1) > 0, 0.9, np.where(votes.sum(axis=1) < 0, 0.1, 0.5))
    for _ in range(EM_ROUNDS):
        table, mass = [], []
        for k, post in enumerate((1 - good, good)):
            seen = np.einsum("p,prv->rv", n * post, cast) + PRIOR_VOTES * prior[k]
            table.append(seen / seen.sum(axis=1, keepdims=True))
            mass.append((n * post).sum() + 1.0)
        log = [np.log(m / sum(mass)) + np.einsum("prv,rv->p", cast, np.log(t)) for m, t in zip(mass, table, strict=True)]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        moved, good = np.abs(new - good).max(), new
        if moved < EM_TOLERANCE:
            break
    right = (n[:, None] * ((votes == 1) * good[:, None] + (votes == -1) * (1 - good)[:, None])).sum(axis=0)
    voted = (n[:, None] * (votes != 0)).sum(axis=0)
    report = pd.DataFrame({"rule": list(RULES), "accuracy": right / np.maximum(voted, 1e-12), "coverage": voted / n.sum()})
    return dict(zip(patterns, good.tolist(), strict=True)), report


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     threshold: float = KEEP_PROBABILITY) -> DataFrame:
    """doc_id, the base counts, base_failed, p_good and kept of every document."""
    spark = docs.sparkSession
    stats = materialize(document_stats(docs, id_col, text_col), "quality_stats")
    counts = {r["pattern"]: r["n"] for r in stats.groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    posterior, _ = fit_label_model(counts)
    table = spark.createDataFrame(list(posterior.items()), "pattern long, p_good double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return stats.join(F.broadcast(table), "pattern", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("p_good") >= threshold)).alias("kept"), "p_good",
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(read_table(spark, sf_dir, "documents"))
