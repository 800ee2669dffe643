"""Alignment of two tokenizers by token-byte incidence matrices (operator 12).

A text is encoded by a byte-level BPE (A) and by a piece BPE with byte fallback
(B). Each side is an incidence matrix in compressed sparse rows, a row per token
and a column per byte of the text. The row product A . B^T (Gustavson: the rows of
B^T that a row of A points to are added up) has an entry per pair of tokens that
overlap, whose value is the number of bytes they share. Offsets where tokens of both
sides end cut the text into groups; the product of the two token-group incidence
matrices links all tokens of a group.

Both tokenizers never join a space to what is not white space before it, so a text
is cut there into pieces which are encoded and multiplied by themselves, all
distinct pieces of a block of documents as one block-diagonal product. A block holds
the documents of about ``BLOCK_CHARS`` characters of one task's input. It keeps its
documents as numbers of pieces, the pieces' links as numbers of id pairs, and how
often each id pair is linked; only the id pairs of blocks are shuffled, summed over the
corpus, and come back to their blocks, where each document adds up its pieces.

Sizes: a task holds one block at a time (a longer document is a block of its own);
one row per distinct id pair and block is shuffled, so a pair that every document
has is one row a block. Nothing is broadcast or brought to the driver.

Defined cases: texts that are null, empty, or that one of the tokenizers does not give
back byte for byte (as U+2581, which B takes for a space) have no tokens: zeros and
'' and they don't count; repeated rows count and return a row each; an empty table
gives an empty result; other columns are not read; whole texts are encoded.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.llm.common import claim_memory, materialize, read_table
from larch.llm.tokens import _byte_letters, tokenizer_path

BLOCK_CHARS = 12_000_000
#: Pieces that are encoded and multiplied at a time.
BATCH_PIECES = 20_000
BATCH_CHARS = 2_000_000
TOKENS_A, TOKENS_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
MARK = "▁"
_CUT = re.compile(r"(?<=\S) ")
_SPACED = re.compile(r"\s ")


# ---- sparse matrices -------------------------------------------------------

@dataclass
class Rows:
    """A matrix in compressed sparse rows."""

    start: np.ndarray  # row i has the entries start[i]:start[i + 1]
    column: np.ndarray
    value: np.ndarray
    n_columns: int

    def transposed(self) -> Rows:
        n = len(self.start) - 1
        order = np.argsort(self.column, kind="stable")
        start = np.concatenate([[0], np.cumsum(np.bincount(self.column, minlength=self.n_columns))])
        return Rows(start, np.repeat(np.arange(n), np.diff(self.start))[order], self.value[order], n)


def incidence(first: np.ndarray, last: np.ndarray, n_columns: int) -> Rows:
    """A row per token over the columns first..last - 1."""
    width = last - first
    start = np.concatenate([[0], np.cumsum(width)])
    column = np.arange(start[-1]) + np.repeat(first - start[:-1], width)
    return Rows(start, column, np.ones(len(column), dtype=np.int64), n_columns)


def product(a: Rows, b: Rows) -> Rows:
    """a . b by Gustavson's rows: row i adds up the rows k of b that it points to."""
    n = len(a.start) - 1
    width = (b.start[1:] - b.start[:-1])[a.column]
    before = np.cumsum(width) - width
    at = np.arange(int(width.sum())) + np.repeat(b.start[a.column] - before, width)
    row = np.repeat(np.repeat(np.arange(n), np.diff(a.start)), width)
    key = row * b.n_columns + b.column[at]
    value = np.repeat(a.value, width) * b.value[at]
    if len(key) and (np.diff(key) < 0).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    sums = np.add.reduceat(value, new) if len(new) else value
    key = key[new]
    start = np.searchsorted(key, np.arange(n + 1) * b.n_columns)
    return Rows(start, key % b.n_columns if b.n_columns else key, sums, b.n_columns)


# ---- tokens ------------------------------------------------------------------

class Tokenizers:
    """Ids and byte lengths of pieces by both vocabularies."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: b for b, c in _byte_letters().items()}
        names = (self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size()))
        self.bytes_a = [bytes(byte_of[c] for c in x) if all(c in byte_of for c in x) else x.encode() for x in names]
        self.bytes_b = [self._bytes_b(i) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        self.mark = self.b.piece_to_id(MARK)

    def _bytes_b(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode()

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of " " + piece by A, and of piece by B, which adds the space itself."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)]
        b = self.b.encode(pieces, num_threads=1)
        return a, [ids if p else [self.mark] for p, ids in zip(pieces, b, strict=True)]


_TOKENIZERS: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    if (path_a, path_b) not in _TOKENIZERS:
        claim_memory("alignment", _TOKENIZERS.clear)
        _TOKENIZERS[path_a, path_b] = Tokenizers(path_a, path_b)
    return _TOKENIZERS[path_a, path_b]


def pieces_of(text: str) -> list[str]:
    """A non-empty text cut before each space that follows no white space. The
    leading spaces of the pieces (of the first one, the added space) are left out."""
    if text[0] != " " and "  " not in text and not _SPACED.search(text):
        return text.split(" ")
    first, *rest = _CUT.split(" " + text)
    return [first[1:], *rest]


# ---- pieces ------------------------------------------------------------------

@dataclass
class Aligned:
    """Tokens, groups and links of pieces; entries of piece i are start[i]:start[i + 1]."""

    exact: np.ndarray     # whether both sides give back the bytes
    start_a: np.ndarray
    ids_a: np.ndarray
    start_b: np.ndarray
    ids_b: np.ndarray
    n_groups: np.ndarray
    groups: list[str]
    start_links: np.ndarray
    link_a: np.ndarray    # ids of linked tokens
    link_b: np.ndarray
    shared_bytes: np.ndarray
    n_group_links: np.ndarray
    row_a: np.ndarray     # numbers of the linked tokens among all of the batch
    row_b: np.ndarray


def _ends(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    end = np.cumsum(sizes)
    return end - sizes, end


def align(pieces: list[str], t: Tokenizers) -> Aligned:
    """All pieces as one block-diagonal pair of incidence matrices. Pieces that
    aren't given back byte for byte have no tokens."""
    lists = [[], []]
    exact = np.ones(len(pieces), dtype=bool)
    for i, (piece, a, b) in enumerate(zip(pieces, *t.encode(pieces), strict=True)):
        raw = b" " + piece.encode("utf-8", "surrogatepass")
        exact[i] = b"".join([t.bytes_a[x] for x in a]) == raw and b"".join([t.bytes_b[x] for x in b]) == raw
        lists[0].append(a if exact[i] else [])
        lists[1].append(b if exact[i] else [])
    n = len(pieces)
    counts = [np.array([len(x) for x in side], dtype=np.int64) for side in lists]
    ids = [np.array([x for ids in side for x in ids], dtype=np.int64) for side in lists]
    owner = [np.repeat(np.arange(n), c) for c in counts]
    spans = [_ends(size[x]) for size, x in zip((t.size_a, t.size_b), ids, strict=True)]
    n_bytes = int(spans[0][1][-1]) if len(ids[0]) else 0
    a, b = (incidence(*s, n_bytes) for s in spans)
    links = product(a, b.transposed())
    # offsets at which both sides end close a group; the end of each piece is one
    cuts = np.intersect1d(spans[0][1], spans[1][1], assume_unique=True)
    of = [np.searchsorted(cuts, s[1], side="left") for s in spans]
    member = [incidence(g, g + 1, len(cuts)) for g in of]
    shared = product(member[0], member[1].transposed())
    row = np.repeat(np.arange(len(ids[0])), np.diff(links.start))
    starts = [np.concatenate([[0], np.cumsum(c)]) for c in counts]
    texts = []
    joined = []
    for x, g in zip(ids, of, strict=True):
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, dtype=np.int64)
        names = list(map(str, x.tolist()))
        joined.append([",".join(names[i:j]) for i, j in zip(first.tolist(), [*first[1:].tolist(), len(names)], strict=True)])
    pairs = [f"{x}|{y}" for x, y in zip(*joined, strict=True)]
    cut_owner = owner[0][np.searchsorted(spans[0][1], cuts)] if len(cuts) else np.zeros(0, dtype=np.int64)
    n_groups = np.bincount(cut_owner, minlength=n)
    at = 0
    for k in n_groups.tolist():
        texts.append(";".join(pairs[at:at + k]))
        at += k
    per_link = np.bincount(owner[0][row], minlength=n) if len(row) else np.zeros(n, dtype=np.int64)
    group_row = np.repeat(np.arange(len(ids[0])), np.diff(shared.start))
    return Aligned(
        exact, starts[0], ids[0], starts[1], ids[1], n_groups, texts, np.concatenate([[0], np.cumsum(per_link)]),
        ids[0][row], ids[1][links.column], links.value,
        np.bincount(owner[0][group_row], minlength=n) if len(group_row) else np.zeros(n, dtype=np.int64), row, links.column)


def _batches(pieces: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for p in pieces:
        part.append(p)
        size += len(p)
        if len(part) >= BATCH_PIECES or size >= BATCH_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


# ---- blocks of documents ------------------------------------------------------

#: Ids travel as text, whatever their type.
_SCHEMA = ("kind string, block long, doc_id string, a int, b int, n long, at long, pieces binary, first binary, "
           "n_a long, n_b long, n_groups long, n_links long, n_group_links long, groups_sha256 string")
_TOTALS = ["n_a", "n_b", "n_groups", "n_links", "n_group_links"]


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(values, return_inverse=True)


def _block_rows(ids: list, texts: list[str | None], block: int, t: Tokenizers) -> Iterator[pd.DataFrame]:
    number: dict[str, int] = {}
    docs = [np.array([number.setdefault(p, len(number)) for p in pieces_of(x)], dtype="<i4") if x else None for x in texts]
    pieces = list(number)
    parts = [align(part, t) for part in _batches(pieces)]
    exact = np.concatenate([p.exact for p in parts]) if parts else np.zeros(0, dtype=bool)
    totals = np.concatenate([np.stack([np.diff(p.start_a), np.diff(p.start_b), p.n_groups, np.diff(p.start_links), p.n_group_links], axis=1)
                             for p in parts]) if parts else np.zeros((0, 5), dtype=np.int64)
    groups = [g for p in parts for g in p.groups]
    used = np.zeros(len(pieces), dtype=np.int64)
    rows = {"n": [], "sha": [], "pieces": []}
    for d in docs:
        if d is None or not exact[d].all():
            rows["n"].append(np.zeros(5, dtype=np.int64))
            rows["sha"].append("")
            rows["pieces"].append(b"")
            continue
        used += np.bincount(d, minlength=len(pieces))
        rows["n"].append(totals[d].sum(axis=0))
        rows["sha"].append(hashlib.sha256(";".join(map(groups.__getitem__, d.tolist())).encode()).hexdigest())
        rows["pieces"].append(d.tobytes())
    yield pd.DataFrame({"kind": "doc", "block": block, "doc_id": ids, "pieces": rows["pieces"], "groups_sha256": rows["sha"],
                        **{c: x for c, x in zip(_TOTALS, np.array(rows["n"]).reshape(-1, 5).T, strict=True)}})
    if not parts:
        return
    link = np.concatenate([(p.link_a << 32) | p.link_b for p in parts])
    n_links = totals[:, 3]
    keys, at = _numbered(link)
    times = np.bincount(at, weights=np.repeat(used, n_links), minlength=len(keys)).astype(np.int64)
    # the links of the pieces, as numbers of id pairs, and how many each piece has
    yield pd.DataFrame({"kind": ["links"], "block": [block], "pieces": [at.astype("<i4").tobytes()], "first": [n_links.astype("<i4").tobytes()]})
    some = times > 0
    yield pd.DataFrame({"kind": "pair", "block": block, "a": (keys >> 32)[some], "b": (keys & 0xFFFFFFFF)[some],
                        "n": times[some], "at": np.flatnonzero(some)})


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("string").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def _blocks(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str) -> DataFrame:
    """Rows of kind doc, links and pair of every block."""
    names = [x.split()[0] for x in _SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t, task, done = tokenizers(path_a, path_b), TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def close() -> Iterator[pd.DataFrame]:
            for frame in _block_rows(ids, texts, (task << 32) + done, t):
                yield _typed(frame, names)

        for b in batches:
            for doc_id, text in zip(b["doc_id"].tolist(), b["text"], strict=True):
                if texts and size + len(text or "") > BLOCK_CHARS:
                    yield from close()
                    ids, texts, size, done = [], [], 0, done + 1
                ids.append(doc_id)
                texts.append(text)
                size += len(text or "")
        if ids:
            yield from close()

    return _read(docs, id_col, text_col).mapInPandas(run, _SCHEMA)


def _typed(frame: pd.DataFrame, names: list[str]) -> pd.DataFrame:
    """All columns, null where a kind of row has none."""
    return frame.assign(**{c: None for c in names if c not in frame})[names]


def _summed(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Documents of a block with the sums over their links."""
    if not len(left):
        return pd.DataFrame({"doc_id": left["doc_id"], "n_best": [], "count_sum": [], **{c: [] for c in (*_TOTALS, "groups_sha256")}})
    links = right.loc[right["at"].isna()]
    pairs = right.loc[right["at"].notna()]
    out = left[["doc_id", *_TOTALS, "groups_sha256"]].copy()
    sums = np.zeros((len(left), 2), dtype=np.int64)
    if len(links):
        of_link = np.frombuffer(links["pieces"].iloc[0], dtype="<i4")
        n_links = np.frombuffer(links["first"].iloc[0], dtype="<i4")
        count, best = np.zeros((2, int(of_link.max(initial=-1)) + 1), dtype=np.int64)
        at = pairs["at"].to_numpy(dtype=np.int64)
        count[at] = pairs["count"].to_numpy(dtype=np.int64)
        best[at] = pairs["is_best"].to_numpy(dtype=bool)
        ends = np.concatenate([[0], np.cumsum(n_links)])
        both = [np.concatenate([[0], np.cumsum(x[of_link])]) for x in (best, count)]
        piece = np.stack([x[ends[1:]] - x[ends[:-1]] for x in both], axis=1)
        for i, raw in enumerate(left["pieces"]):
            if raw:
                sums[i] = piece[np.frombuffer(raw, dtype="<i4")].sum(axis=0)
    return out.assign(n_best=sums[:, 0], count_sum=sums[:, 1])


def link_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, count, is_best) of rows (a, b, n): how many links hold the ids, and
    whether no other a is linked more often with b."""
    counts = materialize(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "link_counts")
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    return counts.join(top, "b").select("a", "b", "count", (F.col("count") == F.col("top")).alias("is_best"))


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and
    n_group_links (pairs of tokens in one group) of every document."""
    blocks = materialize(_blocks(docs, id_col, text_col, path_a or tokenizer_path(TOKENS_A), path_b or tokenizer_path(TOKENS_B)), "alignment")
    pairs = blocks.where("kind = 'pair'").select("block", "a", "b", "n", "at")
    found = pairs.join(link_counts(pairs), ["a", "b"]).select(
        F.col("block").alias("of"), "at", "count", "is_best", F.lit(None).cast("binary").alias("pieces"), F.lit(None).cast("binary").alias("first"))
    links = blocks.where("kind = 'links'").select(
        F.col("block").alias("of"), F.lit(None).cast("long").alias("at"), F.lit(None).cast("long").alias("count"),
        F.lit(None).cast("boolean").alias("is_best"), "pieces", "first")
    documents = blocks.where("kind = 'doc'").select("block", "doc_id", "pieces", *_TOTALS, "groups_sha256")
    schema = "doc_id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, n_group_links long"
    order = [x.split()[0] for x in schema.split(", ")]
    out = documents.groupBy("block").cogroup(found.unionByName(links).groupBy("of")).applyInPandas(
        lambda left, right: _summed(left, right)[order], schema)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def overlap_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """A row per link: doc_id, row_a, row_b (numbers of the tokens in the document),
    a, b (their ids), n_bytes (shared)."""
    path_a, path_b = path_a or tokenizer_path(TOKENS_A), path_b or tokenizer_path(TOKENS_B)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizers(path_a, path_b)
        for b in batches:
            for doc_id, text in zip(b["doc_id"].tolist(), b["text"], strict=True):
                if not text:
                    continue
                x = align(pieces_of(text), t)
                if x.exact.all():
                    yield pd.DataFrame({"doc_id": [doc_id] * len(x.row_a), "row_a": x.row_a, "row_b": x.row_b,
                                        "a": x.link_a, "b": x.link_b, "n_bytes": x.shared_bytes})

    out = _read(docs, id_col, text_col).mapInPandas(run, "doc_id string, row_a long, row_b long, a int, b int, n_bytes long")
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(read_table(spark, sf_dir, "documents"))
