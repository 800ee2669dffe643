"""Best-fit packing with patterns chosen by non-negative least squares (operator 8).

Documents become pieces of at most L tokens (only longer ones are cut; the
first piece takes the remainder). Sequences are planned on the histogram of
piece lengths alone, which has at most L entries whatever the input:

1. patterns: the ways to fill L exactly with up to three piece lengths that
   occur;
2. non-negative least squares, by coordinate descent from zero, fits how often
   each pattern is repeated so that the patterns' lengths add up to the
   histogram;
3. the counts are rounded down (never beyond the pieces that are left);
4. the residual histogram is packed best fit decreasing, a whole group of equal
   pieces at a time; pieces of one document may meet in a sequence.

The plan is a list of segments: the r-th piece of length l goes to sequence
``first + r - from`` at ``offset``. Pieces are numbered within their length over
salted groups (about ``GROUP_PIECES`` each), so that a length that a third of
all pieces share is numbered by many tasks. Pieces of full length need no
number: each is a sequence of its own.

Defined cases: null text is empty and becomes a piece of the end id alone; null
ids and repeated rows keep their own pieces; an empty table gives an empty
result; other columns are not read. Memory per task: the longest text, the plan
(a few segments per length and residual group) and, on the driver, L ** 2 / 12
patterns.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larch.llm.common import materialize, read_table
from larch.llm.tokens import encode_bytes, tokenizer_path

SEQUENCE_LENGTH = 1024
END_ID = 2
GROUP_PIECES = 10_000
NNLS_SWEEPS = 8


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    if n <= length:
        return [(0, n)]
    first = n % length or length
    return [(0, first), *((s, length) for s in range(first, n, length))]


def pieces_of(docs: DataFrame, tokenizer: str, length: int = SEQUENCE_LENGTH, end_id: int = END_ID,
              id_col: str = "doc_id", text_col: str = "text", lean: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    kind = dict(docs.dtypes)[id_col]
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            row, rows = [], []
            for i, text in enumerate(b["text"]):
                ids = encode_bytes(text, tokenizer, lean) + end
                for k, (s, n) in enumerate(cut(len(ids) // 4, length)):
                    row.append(i)
                    rows.append((k, s, n, zlib.crc32(ids[4 * s:4 * (s + n)])))
            out = pd.DataFrame(rows, columns=["piece", "start", "length", "ids_crc32"], dtype="int64")
            out.insert(0, "doc_id", b["doc_id"].to_numpy()[row] if row else b["doc_id"].iloc[:0])
            yield out

    return docs.selectExpr(f"`{id_col}` AS doc_id", f"cast(`{text_col}` AS string) AS text").mapInPandas(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def fill_patterns(lengths: list[int], total: int) -> list[tuple[int, ...]]:
    """Up to three of the lengths, largest first, that add up to ``total``."""
    have, out = set(lengths), []
    for a in sorted(have, reverse=True):
        if a == total:
            out.append((a,))
        elif (rest := total - a) > 0:
            if rest in have and rest <= a:
                out.append((a, rest))
            out.extend((a, b, rest - b) for b in range(min(a, rest - 1), (rest - 1) // 2, -1) if b in have and rest - b in have)
    return out


def fit_repeats(patterns: list[tuple[int, ...]], counts: dict[int, int], sweeps: int = NNLS_SWEEPS) -> list[float]:
    """Non-negative x with least squares || sum x_p * pattern_p - counts ||,
    by coordinate descent from zero."""
    left = {n: float(c) for n, c in counts.items()}
    parts = [tuple((n, p.count(n)) for n in dict.fromkeys(p)) for p in patterns]
    norm = [sum(k * k for _, k in p) for p in parts]
    x = [0.0] * len(patterns)
    for _ in range(sweeps):
        moved = 0.0
        for j, p in enumerate(parts):
            step = sum(k * left[n] for n, k in p) / norm[j]
            if step < -x[j]:
                step = -x[j]
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for n, k in p:
                    left[n] -= k * step
        if moved < 0.25:
            break
    return x


def best_fit(counts: dict[int, int], total: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing on a histogram: (lengths of a sequence, how many)."""
    open_: dict[int, dict[tuple[int, ...], int]] = {total: {}}  # space left -> sequences
    for n in sorted((n for n, c in counts.items() if c > 0), reverse=True):
        c = counts[n]
        for space in sorted(s for s in open_ if s >= n and open_[s]):
            each = space // n
            for seq in list(open_[space]):
                if not c:
                    break
                there = open_[space][seq]
                full = min(there, c // each)
                some = c - full * each if full < there else 0
                some = min(some, each - 1)
                if full:
                    open_.setdefault(space - each * n, {}).setdefault(seq + (n,) * each, 0)
                    open_[space - each * n][seq + (n,) * each] += full
                if some:
                    open_.setdefault(space - some * n, {}).setdefault(seq + (n,) * some, 0)
                    open_[space - some * n][seq + (n,) * some] += 1
                c -= full * each + some
                open_[space][seq] = there - full - bool(some)
                if not open_[space][seq]:
                    del open_[space][seq]
            if not c:
                break
        each = total // n
        for size, many in ((each, c // each), (c % each, 1)):
            if size and many:
                group = open_.setdefault(total - size * n, {})
                group[(n,) * size] = group.get((n,) * size, 0) + many
    return [(seq, many) for group in open_.values() for seq, many in group.items() if many]


def plan_sequences(counts: dict[int, int], total: int = SEQUENCE_LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many of them) that hold exactly ``counts``."""
    left, out = dict(counts), []
    patterns = fill_patterns([n for n, c in counts.items() if c > 0], total)
    for p, x in sorted(zip(patterns, fit_repeats(patterns, counts), strict=True), key=lambda t: -t[1]):
        many = min(int(x + 1e-6), *(left[n] // p.count(n) for n in p))
        if many > 0:
            out.append((p, many))
            for n in p:
                left[n] -= many
    return out + best_fit(left, total)


def segments(plan: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """length, from_rank, many, first_sequence, offset: where pieces go."""
    rows, rank, sequence = [], {}, 0
    for seq, many in plan:
        offset = 0
        for n in seq:
            rows.append((n, rank.get(n, 0), many, sequence, offset))
            rank[n] = rank.get(n, 0) + many
            offset += n
        sequence += many
    return pd.DataFrame(rows, columns=["length", "from_rank", "many", "first_sequence", "offset"], dtype="int64").sort_values(
        ["length", "from_rank"], ignore_index=True)


def _ranked(pieces: DataFrame, counts: dict[int, int], group: int) -> DataFrame:
    """rank: 0, 1, 2, ... within each length, over salted groups."""
    spark = pieces.sparkSession
    salts = F.broadcast(spark.createDataFrame([(n, -(-c // group)) for n, c in counts.items()], "length long, salts long"))
    salted = pieces.join(salts, "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.col("salts")))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = sizes.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    return salted.withColumn("own", own).join(before, ["length", "salt"]).withColumn("rank", F.col("own") + F.col("before"))


def pack(pieces: DataFrame, length: int = SEQUENCE_LENGTH, group: int = GROUP_PIECES) -> DataFrame:
    """sequence_id and offset for every piece (a materialised frame)."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    counts.pop(length, 0)
    where = segments(plan_sequences(counts, length))
    used = int((where["first_sequence"] + where["many"]).max()) if len(where) else 0
    key = where["length"].to_numpy() << 40 | where["from_rank"].to_numpy() if len(where) else np.zeros(0, dtype="int64")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = pieces.select(*names).schema.simpleString()[7:-1].replace(":", " ")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, rank = b["length"].to_numpy(), b["rank"].to_numpy()
            at = np.searchsorted(key, n << 40 | rank, side="right") - 1
            s = where.iloc[at]
            yield b[names].assign(sequence_id=s["first_sequence"].to_numpy() + rank - s["from_rank"].to_numpy(),
                                  offset=s["offset"].to_numpy())

    short = _ranked(pieces.where(F.col("length") < length), counts, group).select(*names, "rank").mapInPandas(
        place, schema.replace(",", ", ") + ", sequence_id long, offset long")
    full = pieces.where(F.col("length") == length).select(
        *names, (F.monotonically_increasing_id() + used).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(short)


def op8_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(materialize(pieces_of(read_table(spark, sf_dir, "documents"), tokenizer_path()), "pieces"))
