"""Language-model scores of whole documents (operator 13).

Tokens are words between ASCII white space, in lower case where they are ASCII, and
an end per document. The model is a gated recurrent unit with a class-factored
output softmax in numpy (``recurrent``), trained by truncated backpropagation on the
documents whose crc32 of the id is not 2 modulo 7. A document's score is the sum of
the log10 probabilities of its tokens, each given all tokens before it: the state
is carried over the windows of the text.

Vocabulary. Every token of the training documents is counted, in one table. The
``SHORTLIST`` commonest words are outputs of their own. A rarer word belongs to the
bin of its last byte and the power of two below its count; the model gives the bin's
probability and the word has its share of the bin's tokens. In the bins of words
seen once, a share that follows the number of words seen once and twice
(Good-Turing) belongs to words never seen, which are one outcome per bin. So the
probabilities of all words sum to one after any past.

Training. The tokens of each block of documents (about ``BLOCK_TOKENS`` of one task's
input) are numbered inside the block; counts meet the blocks' words in joins, so no
vocabulary is broadcast. All training documents are used, in ``ROUNDS`` rounds:
each round, every block runs its documents of that round through the current
model in its own task, and the blocks' parameters are averaged, weighted by tokens, in
a tree of at most ``FAN_IN`` vectors a task. What travels is bounded by the shortlist
and the bins, not by the vocabulary.

Sizes: two or three bytes a token are written and two shuffled in the rounds; one row per
distinct word and block meets the counts. The driver gets the shortlist, the bins and
one averaged parameter vector a round.

Defined cases: null text counts as empty: its only token is the end; a null id hashes
as ""; repeated rows are learned from and scored as often as they occur; without
training documents every token has the untrained model's probability, and the base
is that of N = V = 0; an empty table gives an empty result; other columns are not
read; no text is cut.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.llm import recurrent
from larch.llm.common import materialize, read_table
from larch.session import unique_path

SHORTLIST = 1024
#: Longer words are never outputs of their own, so the shortlist has a bounded size.
SHORTLIST_BYTES = 64
HIDDEN, CLASSES = 16, 32
STREAMS, STEPS = 256, 32
#: Documents that are scored side by side.
SCORE_STREAMS = 640
#: Symbols of a training document that are run in one piece.
STRETCH = 512
ROUNDS = 4
RATE = 0.015
FAN_IN = 32
SEED = 13
HELD_OUT = 2
#: A block ends with the document that brings it to so many tokens.
BLOCK_TOKENS = 5_000_000
FRAME_ROWS = 50_000
#: Symbols that are scored at a time.
SCORE_TOKENS = 3_000_000
#: No word contains white space, so this token is none.
END = b" "
ENDINGS = 128


def tokens_of(text: bytes | None) -> list[bytes]:
    words = (text or b"").lower().split()  # of bytes: ASCII only
    words.append(END)
    return words


# ---- blocks --------------------------------------------------------------------

_BLOCKS = "kind string, block long, doc_id string, held_out boolean, ids binary, n_tokens long, word binary, at long, n long"
_BLOCK_ROWS = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("doc_id", pa.string()), ("held_out", pa.bool_()), ("ids", pa.binary()),
                         ("n_tokens", pa.int64()), ("word", pa.binary()), ("at", pa.int64()), ("n", pa.int64())])


class _Block:
    """Documents as numbers of the block's words; the texts are not held."""

    def __init__(self, block: int) -> None:
        self.block, self.n_tokens = block, 0
        self.number: dict[bytes, int] = defaultdict(count().__next__)  # in order of appearance
        self.rows: list[tuple] = []

    def add(self, doc_id: str | None, held_out: bool, text: bytes | None) -> None:
        ids = np.array(list(map(self.number.__getitem__, tokens_of(text))), dtype="<i4")
        self.rows.append((doc_id, held_out, ids))
        self.n_tokens += len(ids)

    def frames(self) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(self.number), dtype=np.int64)
        for _, held_out, x in self.rows:
            if not held_out:
                np.add.at(n, x, 1) if len(x) < 1000 else np.add(n, np.bincount(x, minlength=len(n)), out=n)
        for i in range(0, len(self.rows), FRAME_ROWS):
            part = self.rows[i:i + FRAME_ROWS]
            yield self._batch("doc", len(part), doc_id=[r[0] for r in part], held_out=[r[1] for r in part],
                              ids=[r[2].tobytes() for r in part], n_tokens=[len(r[2]) for r in part])
        words = list(self.number)
        for i in range(0, len(words), FRAME_ROWS):
            part = words[i:i + FRAME_ROWS]
            yield self._batch("word", len(part), word=part, at=np.arange(i, i + len(part)), n=n[i:i + len(part)])

    def _batch(self, kind: str, size: int, **values) -> pa.RecordBatch:
        """Rows of ``_BLOCKS``; columns that are not given are null."""
        same = {"kind": pa.scalar(kind, pa.string()), "block": pa.scalar(self.block, pa.int64())}
        return pa.RecordBatch.from_arrays([
            pa.repeat(same[f.name], size) if f.name in same else pa.array(values[f.name], f.type) if f.name in values else pa.nulls(size, f.type)
            for f in _BLOCK_ROWS], schema=_BLOCK_ROWS)


def _blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of kind doc (numbers of its tokens) and word (counts of training tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        block = _Block(task << 32)
        for b in batches:
            for doc_id, held_out, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                block.add(doc_id, held_out, text)
                if block.n_tokens >= BLOCK_TOKENS:
                    yield from block.frames()
                    done += 1
                    block = _Block((task << 32) + done)
        if block.rows:
            yield from block.frames()

    doc_id = F.col(f"`{id_col}`").cast("string")
    held_out = F.crc32(F.coalesce(doc_id, F.lit("")).cast("binary")) % 7 == HELD_OUT
    return docs.select(doc_id.alias("doc_id"), held_out.alias("held_out"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")).mapInArrow(run, _BLOCKS)


# ---- vocabulary ------------------------------------------------------------------

def _bin(c: str, word: str) -> list:
    """(power of two below the count, last byte) of a word that is not shortlisted."""
    power = F.when(F.col(c) <= 1, 0).otherwise(F.floor(F.log2(F.col(c).cast("double")) + 1e-12)).cast("int")
    last = F.conv(F.hex(F.expr(f"substring({word}, length({word}), 1)")), 16, 10).cast("int") % ENDINGS
    return [power.alias("power"), F.coalesce(last, F.lit(0)).alias("ending")]


@dataclass
class Vocabulary:
    """Outputs of the model, by descending count, and the total counts."""

    n: int                  # N: training tokens
    distinct: int           # V
    counts: np.ndarray      # training tokens of each symbol
    words: list             # (symbol, word, count) of the shortlist
    bins: list              # (symbol, power, ending, training tokens, share of unseen words, words seen once)


def _vocabulary(counts: DataFrame, shortlist: int) -> Vocabulary:
    """From (word, c). What reaches the driver is bounded by the shortlist and the bins."""
    seen = counts.where("c > 0")
    top = seen.where((F.col("c") > 1) & (F.length("word") <= SHORTLIST_BYTES)).orderBy(F.desc("c"), "word").limit(shortlist).collect()
    last = (top[-1]["c"], bytes(top[-1]["word"])) if top else None
    rare = seen
    if last:
        own = (F.col("c") > last[0]) | ((F.col("c") == last[0]) & (F.col("word") <= F.lit(last[1])))
        rare = seen.where(~own | (F.length("word") > SHORTLIST_BYTES))
    binned = rare.select("c", *_bin("c", "word")).groupBy("power", "ending").agg(
        F.sum("c").alias("n"), F.sum((F.col("c") == 1).cast("long")).alias("once"), F.sum((F.col("c") == 2).cast("long")).alias("twice")).collect()
    total = seen.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    bins = {(r["power"], r["ending"]): [r["n"], r["once"]] for r in binned}
    twice = {r["ending"]: r["twice"] for r in binned if r["power"] == 1}
    for e in range(ENDINGS):  # a word never seen may end in any byte
        bins.setdefault((0, e), [0, 0])
    entries = [(r["c"], 0, bytes(r["word"])) for r in top] + [(n, 1, key, once) for key, (n, once) in bins.items()]
    entries.sort(key=lambda x: (-x[0], *x[1:3]))
    words, parts = [], []
    for symbol, x in enumerate(entries):
        if x[1] == 0:
            words.append((symbol, x[2], x[0]))
        else:
            (power, ending), once = x[2], x[3]
            unseen = (once + 1) / (once + 2 * twice.get(ending, 0) + 2) if once else 1.0
            parts.append((symbol, power, ending, x[0], unseen if power == 0 else 0.0, once))
    return Vocabulary(total["n"], total["v"], np.array([x[0] for x in entries], dtype=float), words, parts)


def _symbols(spark: SparkSession, counts: DataFrame, v: Vocabulary) -> DataFrame:
    """(word, c, symbol, share): share is the log10 of a word's part of its symbol."""
    words = spark.createDataFrame([(s, bytearray(w)) for s, w, _ in v.words], "own int, word binary")
    bins = spark.createDataFrame([(s, p, e, float(n), u, float(once)) for s, p, e, n, u, once in v.bins],
                                 "bin int, power int, ending int, total double, unseen double, once double")
    rare = F.when(F.col("c") == 0, F.log10("unseen")).when(F.col("c") == 1, F.log10((1 - F.col("unseen")) / F.col("once"))).otherwise(
        F.log10(F.col("c") / F.col("total")))
    return counts.join(words, "word", "left").select("*", *_bin("c", "word")).join(bins, ["power", "ending"], "left").select(
        "word", "c", F.coalesce("own", "bin").alias("symbol"), F.when(F.col("own").isNotNull(), 0.0).otherwise(rare).alias("share"))


_CODED = "block long, doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, shared double, symbols binary, turn int"


def _coded(left: pd.DataFrame, right: pd.DataFrame, n: int, distinct: int) -> pd.DataFrame:
    """Documents of a block as symbols, with what does not depend on the model."""
    right = right.sort_values("at")
    c, symbol, share = right["c"].to_numpy(), right["symbol"].to_numpy().astype("<u2"), right["share"].to_numpy()
    base = np.log10((c + 1) / (n + distinct + 1))
    left = left.sort_values(["doc_id", "n_tokens"], kind="stable", na_position="first")
    ids = [np.frombuffer(x, dtype="<i4") for x in left["ids"]]
    turn = np.full(len(left), -1)
    learn = np.flatnonzero(~left["held_out"].to_numpy(dtype=bool))
    turn[learn] = np.arange(len(learn)) % ROUNDS
    return pd.DataFrame({
        "block": left["block"], "doc_id": left["doc_id"], "held_out": left["held_out"], "n_tokens": left["n_tokens"],
        "n_known": [int((c[x] > 0).sum()) for x in ids], "base_score": [float(base[x].sum()) for x in ids],
        "shared": [float(share[x].sum()) for x in ids], "symbols": [symbol[x].tobytes() for x in ids], "turn": turn})


# ---- training --------------------------------------------------------------------

def _averaged(vectors: DataFrame, n: int) -> np.ndarray | None:
    """The weighted mean of vectors (block, n, flat), ``FAN_IN`` or so at a time."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        total = int(frame["n"].sum())
        flat = sum(np.frombuffer(x, dtype="<f4").astype(np.float64) * w for x, w in zip(frame["flat"], frame["n"], strict=True))
        return pd.DataFrame({"block": [int(frame["block"].iloc[0])], "n": [total], "flat": [(flat / max(total, 1)).astype("<f4").tobytes()]})

    while n > 1:
        n = math.ceil(n / FAN_IN)
        vectors = vectors.groupBy(F.pmod(F.xxhash64("block"), F.lit(n))).applyInPandas(merge, "block long, n long, flat binary")
    row = vectors.where("n > 0").first()
    return None if row is None else np.frombuffer(row["flat"], dtype="<f4").copy()


def _trained(coded: DataFrame, shape: recurrent.Shape, flat: np.ndarray, n_blocks: int) -> np.ndarray:
    def from_here(flat: np.ndarray, rate: float):
        def run(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values(["doc_id", "symbols"], na_position="first")
            model = recurrent.Recurrent(shape, flat.copy())
            docs = [np.frombuffer(x, dtype="<u2") for x in frame["symbols"]]
            _, n = recurrent.train(model, docs, STREAMS, STEPS, rate, STRETCH)
            return pd.DataFrame({"block": [int(frame["block"].iloc[0])], "n": [n], "flat": [model.flat.astype("<f4").tobytes()]})

        return run

    for turn in range(ROUNDS):
        part = coded.where(F.col("turn") == turn).select("block", "doc_id", "symbols")
        vectors = part.groupBy("block").applyInPandas(from_here(flat, RATE * (1 - turn / ROUNDS)), "block long, n long, flat binary")
        new = _averaged(vectors, n_blocks)
        flat = flat if new is None else new
    return flat


def language_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortlist: int = SHORTLIST) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = docs.sparkSession
    blocks = materialize(_blocks(docs, id_col, text_col), "token_blocks")
    words = blocks.where("kind = 'word'").select("block", "word", "at", "n")
    counts = materialize(words.groupBy("word").agg(F.sum("n").alias("c")), "token_counts")
    v = _vocabulary(counts, shortlist)
    shape = recurrent.Shape(HIDDEN, recurrent.class_bounds(v.counts, CLASSES))
    found = words.select("block", "word", "at").join(_symbols(spark, counts, v), "word").select(
        F.col("block").alias("of"), "at", "c", "symbol", "share")
    n, distinct = v.n, v.distinct
    path = unique_path(spark, "llm", "symbols")
    blocks.where("kind = 'doc'").select("block", "doc_id", "held_out", "n_tokens", "ids").groupBy("block").cogroup(
        found.groupBy("of")).applyInPandas(lambda a, b: _coded(a, b, n, distinct), _CODED).write.partitionBy("turn").parquet(path)
    coded = spark.read.schema(_CODED).parquet(path)
    flat = recurrent.initial(shape, v.counts, SEED)
    if v.n:
        flat = _trained(coded, shape, flat, coded.select("block").distinct().count())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = recurrent.Recurrent(shape, flat)

        def close(rows: list[tuple]) -> pd.DataFrame:
            found = recurrent.score(model, [np.frombuffer(r[4], dtype="<u2") for r in rows], SCORE_STREAMS, STEPS) / math.log(10)
            out = pd.DataFrame([r[:4] for r in rows], columns=["doc_id", "held_out", "n_tokens", "n_known"])
            return out.assign(train_tokens=n, base_score=[r[5] for r in rows], score=found + np.array([r[6] for r in rows]))

        rows, size = [], 0
        columns = ["doc_id", "held_out", "n_tokens", "n_known", "symbols", "base_score", "shared"]
        for b in batches:
            for row in b[columns].itertuples(index=False, name=None):
                if rows and size + row[2] > SCORE_TOKENS:
                    yield close(rows)
                    rows, size = [], 0
                rows.append(row)
                size += row[2]
        if rows:
            yield close(rows)

    schema = "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return coded.drop("turn", "block").mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(read_table(spark, sf_dir, "documents"))
