"""Spelling variants by PartEnum signatures of letter multisets (operator 11).

A word is the binary vector of its letters, one place per (letter, occurrence).
A replaced letter changes two places, an inserted or deleted one changes one, so
words one edit apart have Hamming distance at most two. The places are dealt out
to parts by a hash; dropping every choice of as many parts as places may differ
leaves at least one choice that holds no difference (partition and enumerate):

* words of equal length: ``REPLACE_PARTS`` parts, every two dropped;
* words whose lengths differ by one: ``INSERT_PARTS`` parts, every one dropped.

What is left of the vector is the signature. Since many words share their
letters (anagrams, and all words of one syllable stock), a signature also holds
the shorter length m and the half of the word that the edit leaves alone: one edit
changes the first m // 2 code points or the last m // 2, never both. So every near
pair has a signature in common, and a signature's group stays small where letters
alone would gather thousands of words. Groups meet in an equi-join and each pair
is verified by its edit distance.

Words and counts. Occurrences are counted per document and batch before the
shuffle. A word's form is its near word of largest count, if that is at least
twice its own (ties: the smallest in code-point order); counts at least double
from form to form, so roots follow by doubling the steps in a few joins.

Sizes: 24 signature rows of a word each, whatever its count; nothing is
broadcast or brought to the driver. Joins are told to merge: Spark would size the
signatures by the file of words they come from, and broadcast them. A worker counts at
most ``FLUSH_WORDS`` words at a time; AQE splits the join of a large group.

Defined cases: null or empty texts have no words; a null id is hashed as "";
repeated rows count as often as they occur; an empty table gives an empty
result; other columns are not read; very long runs are words like others.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.llm.common import materialize, read_table
from larch.llm.shingles import mix, stream

MIN_CHARS = 5
MIN_COUNT = 3
#: A word's form has at least this many times its count.
FORM_RATIO = 2
#: The occurrences whose crc32 this divides lose a code point.
MISSPELLED = 97
REPLACE_PARTS, INSERT_PARTS = 4, 3
FLUSH_WORDS = 400_000
BATCH_WORDS = 20_000
#: Roles of a signature: of words of equal length, of the shorter and the longer word.
EQUAL, SHORTER, LONGER = 0, 1, 2
_RUNS = re.compile(f"[A-Za-zÀ-ÿ]{{{MIN_CHARS},}}")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(doc_id: str, text: str) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one text, the chosen runs with a code point less."""
    start = zlib.crc32(f"{doc_id}:".encode())
    runs = Counter(_RUNS.findall(text if text.islower() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % MISSPELLED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < MIN_CHARS:
                continue
        yield run, n


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words that occur often enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, int] = {}
        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                for word, n in words_of(doc_id, text):
                    counts[word] = counts.get(word, 0) + n
                if len(counts) >= FLUSH_WORDS:
                    yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
                    counts = {}
        if counts:
            yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})

    texts = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("doc_id"),
                        F.col(f"`{text_col}`").cast("string").alias("text")).where("text IS NOT NULL")
    return texts.mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _places(n: int, seed: int) -> np.ndarray:
    return stream(n, seed) | np.uint64(1)


class Words:
    """The letters of a batch of words as arrays, one entry per code point."""

    def __init__(self, words: list[str]) -> None:
        self.size = np.array([len(w) for w in words], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        owner = np.repeat(np.arange(len(words)), self.size)
        order = np.lexsort((letters, owner))
        same = np.concatenate([[False], (letters[order][1:] == letters[order][:-1]) & (owner[order][1:] == owner[order][:-1])])
        at = np.arange(len(order))
        occurrence = at - np.maximum.accumulate(np.where(same, 0, at))
        #: a hash of each place (letter, occurrence) that is set
        self.place = mix((letters[order] << np.uint64(32)) + occurrence.astype(np.uint64) + _STEP)
        place_no = at - self.start[owner]
        weight = _places(int(self.size.max(initial=1)), 21)
        value = mix(letters + _STEP)
        # sums up to each code point, weighted by the place from the front and from the back
        self.front = np.concatenate([[np.uint64(0)], np.cumsum(value * weight[place_no])])
        self.back = np.concatenate([[np.uint64(0)], np.cumsum(value * weight[(self.size[owner] - 1 - place_no)])])

    def halves(self, shorter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first and of the last shorter // 2 code points."""
        h, end = shorter // 2, self.start + self.size
        return mix(self.front[self.start + h] - self.front[self.start]), mix(self.back[end] - self.back[end - h] + np.uint64(1))

    def enumerated(self, parts: int, drop: int) -> list[np.ndarray]:
        """A hash of what is left of the vectors for every choice of dropped parts."""
        part = (self.place >> np.uint64(40)) % np.uint64(parts)
        sums = [np.add.reduceat(np.where(part == p, self.place, np.uint64(0)), self.start) for p in range(parts)]
        chosen = enumerate(combinations(range(parts), drop))
        return [mix(sum(sums[p] for p in range(parts) if p not in c) + np.uint64(parts * 100 + k)) for k, c in chosen]


def signatures(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(role, a key per word) of every signature of non-empty words."""
    w = Words(words)
    equal, one_more = w.enumerated(REPLACE_PARTS, 2), w.enumerated(INSERT_PARTS, 1)
    for role, shorter, left in ((EQUAL, w.size, equal), (SHORTER, w.size, one_more), (LONGER, w.size - 1, one_more)):
        kind = np.uint64(role != EQUAL)
        for half in w.halves(shorter):
            stem = mix(half * np.uint64(31) + shorter.astype(np.uint64) * np.uint64(2) + kind)
            for s in left:
                yield role, mix(stem + s).view(np.int64)


def _signed(words: DataFrame) -> DataFrame:
    """(key, role, word, n) of every signature."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), BATCH_WORDS):
                part = b.iloc[i:i + BATCH_WORDS]
                for role, key in signatures(part["word"].tolist()):
                    yield pd.DataFrame({"key": key, "role": np.int8(role), "word": part["word"].to_numpy(), "n": part["n"].to_numpy()})

    return words.select("word", "n").mapInPandas(run, "key long, role byte, word string, n long")


def near_words(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b), once each, of the pairs of ``words`` (word, n; distinct,
    not empty) that one inserted, deleted or replaced code point tells apart."""
    signed = _signed(words)
    left = signed.select("key", F.col("role").alias("role_a"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = signed.select("key", F.col("role").alias("role_b"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    met = ((F.col("role_a") == EQUAL) & (F.col("role_b") == EQUAL) & (F.col("a") < F.col("b"))) | (
        (F.col("role_a") == SHORTER) & (F.col("role_b") == LONGER))
    pairs = left.join(right.hint("merge"), "key").where(met & (F.levenshtein("a", "b", 1) == 1))
    return pairs.groupBy("a", "b").agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"))


def _rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of the words (word, form) that have a form, by doubling the steps."""
    steps = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        jump = steps.select(F.col("word").alias("root"), F.col("root").alias("far"))
        new = materialize(steps.join(jump.hint("merge"), "root", "left").select("word", F.coalesce("far", "root").alias("root"), "far"), "roots")
        if new.where("far IS NOT NULL").isEmpty():
            return new.select("word", "root")
        steps = new.select("word", "root")


def spelling_variants(words: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root of ``words`` (word, n; distinct)."""
    pairs = materialize(near_words(words), "near_words")
    both = pairs.select(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    is_form = -F.col("best.less") >= FORM_RATIO * F.col("n")
    formed = words.join(best.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"))
    formed = materialize(formed, "forms")
    return formed.join(_rooted(formed.where("form IS NOT NULL")).hint("merge"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = materialize(word_counts(read_table(spark, sf_dir, "documents")), "words")
    return spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")
