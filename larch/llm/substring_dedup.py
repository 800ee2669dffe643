"""Removal of repeated byte strings by threshold-bounded interval expansion (operator 2).

A byte goes when it is covered by a string of L bytes that also starts anywhere
else in the corpus, the same document included. Matches never cross documents
and are judged on the input.

1. Cells. The L-byte windows of each document are cut into runs with the same
   anchor (``larch.llm.anchors``): equal windows have equal anchors, so they meet
   by the anchor's hash. A cell is a run's bytes, about 1.2 L of them.
2. A hash that occurs once has no partner. A bitmap of bounded size leaves most
   such cells at home; what remains is counted by (hash, digest of the cell).
   Copies of a cell are merged map-side and repeat as a whole.
3. Cells that share a hash but not their bytes are cut out of their texts, one
   per digest, and dealt into buckets of about ``BUCKET_BYTES`` by the hash. In a
   bucket ``larch.llm.bwt`` builds a Burrows-Wheeler transform and expands its
   intervals backwards, breadth first, up to L: neighbours whose common prefix
   is not known by then are windows that repeat.
4. A hash with more than ``HOT_CELLS`` different cells would not fit a bucket.
   Its windows are counted one by one by a 128-bit digest instead, which no hash
   can gather in one task; this is exact as well.
5. The covered ranges come back to their documents, are merged and cut out.
   Documents without one don't move.

Defined cases: null text is empty; a text shorter than L bytes stays; fully
repeated rows are repeats of each other; a null id is returned as null; an
empty table gives an empty result; other columns are not read. Memory per task:
8 MiB of text at a time, a bucket, or the ranges of one document; digests have
128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.llm.anchors import cells
from larch.llm.bwt import repeated_windows
from larch.llm.common import flag_keys, key_bitmap, materialize, read_table, text_or_empty

LENGTH = 400
#: An anchor hashes half a window; fewer would repeat by chance, more would cut smaller cells.
GRAM = 200
BUCKET_BYTES = 2_500_000
#: Cells of one anchor that a bucket takes: about 1.5 MB.
HOT_CELLS = 2500
GROUP_BYTES = 2_000_000
SEGMENT_BYTES = 8_000_000
CELL_BITS = 24


def _row_key(id_col: str, text: Column) -> Column:
    """Stands for (id, text); fully repeated rows share it and their results."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("~")), F.lit(":"), text)))


def _segments(raw: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) that share no window and miss none."""
    for at in range(0, max(len(raw) - length + 1, 0), SEGMENT_BYTES):
        yield at, raw[at:at + SEGMENT_BYTES + length - 1]


def cells_of(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """row_key, anchor, digest, first, last: the cells of (row_key, text)."""

    def cut(held: list[tuple[bytes, int, bytes]]) -> pd.DataFrame:
        raw = b"".join(t for _, _, t in held)
        sizes = np.array([len(t) for _, _, t in held])
        starts = np.cumsum(sizes) - sizes
        first, last, anchor = cells(np.frombuffer(raw, dtype=np.uint8), np.repeat(np.arange(len(held)), sizes), length, gram)
        of = np.searchsorted(starts, first, side="right") - 1
        shift = np.array([at for _, at, _ in held]) - starts
        return pd.DataFrame({
            "row_key": [held[i][0] for i in of], "anchor": anchor.view(np.int64),
            "digest": [xxhash.xxh3_128_digest(raw[a:b + length]) for a, b in zip(first.tolist(), last.tolist(), strict=True)],
            "first": first + shift[of], "last": last + shift[of]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in batches:
            for key, text in zip(b["row_key"], b["text"], strict=True):
                for at, raw in _segments(text.encode("utf-8"), length):
                    if held and size + len(raw) > GROUP_BYTES:
                        yield cut(held)
                        held, size = [], 0
                    held.append((key, at, raw))
                    size += len(raw)
        if held:
            yield cut(held)

    return docs.select("row_key", "text").mapInPandas(run, "row_key binary, anchor long, digest binary, first long, last long")


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(start, stop) of the true runs."""
    edge = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


def _cut_out(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """anchor, copies, hot, row_key, first, content of the wanted cells."""
    per_doc = wanted.groupBy("row_key").agg(F.collect_list(F.struct("anchor", "copies", "hot", "first", "last")).alias("cells"))
    flagged = flag_keys(docs.select("row_key", "text"), "row_key", key_bitmap(wanted, "row_key")).where("maybe")
    joined = flagged.groupBy("row_key").agg(F.first("text").alias("text")).join(per_doc, "row_key")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["anchor", "copies", "hot", "row_key", "first", "content"]
        for b in batches:
            for key, text, found in zip(b["row_key"], b["text"], b["cells"], strict=True):
                raw = text.encode("utf-8")
                yield pd.DataFrame([(c["anchor"], c["copies"], c["hot"], key, c["first"], raw[c["first"]:c["last"] + length])
                                    for c in found], columns=names)

    return joined.mapInPandas(run, "anchor long, copies long, hot boolean, row_key binary, first long, content binary")


RANGES = "row_key binary, start long, stop long"


def _ranges_by_bwt(cut: DataFrame, buckets: int, length: int) -> DataFrame:
    """Ranges covered by repeated windows of the cells that occur once."""

    def run(b: pd.DataFrame) -> pd.DataFrame:
        again = repeated_windows(b["content"].tolist(), length)
        rows = [(key, first + s, first + e - 1 + length)
                for key, first, copies, flags in zip(b["row_key"], b["first"], b["copies"], again, strict=True) if copies == 1
                for s, e in _runs(flags)]
        return pd.DataFrame(rows, columns=["row_key", "start", "stop"])

    bucket = F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket")
    return cut.groupBy(bucket).applyInPandas(run, RANGES)


def _ranges_by_window(cut: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many cells, window by window."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for key, first, content in zip(b["row_key"], b["first"], b["content"], strict=True):
                n = len(content) - length + 1
                yield pd.DataFrame({"row_key": [key] * n, "start": range(first, first + n),
                                    "window": [xxhash.xxh3_128_digest(content[i:i + length]) for i in range(n)]})

    windows = cut.select("row_key", "first", "content").mapInPandas(run, "row_key binary, start long, window binary")
    again = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    return windows.join(again, "window").select("row_key", "start", (F.col("start") + length).alias("stop"))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES,
                    hot_cells: int = HOT_CELLS) -> DataFrame:
    """row_key, start, stop of covered bytes (ranges may overlap) of (row_key, text)."""
    found = materialize(cells_of(docs, length, gram), "cells")
    shared = found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    bitmap = materialize(key_bitmap(shared, "anchor", CELL_BITS), "anchor_bitmap")
    meeting = flag_keys(found, "anchor", bitmap, CELL_BITS).where("maybe")
    kinds = materialize(
        meeting.groupBy("anchor", "digest").agg(F.count("*").alias("copies"), F.min(F.struct("row_key", "first", "last")).alias("one")), "cell_kinds")
    copied = meeting.join(kinds.where("copies > 1").select("anchor", "digest"), ["anchor", "digest"]).select(
        "row_key", F.col("first").alias("start"), (F.col("last") + length).alias("stop"))
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = materialize(
        kinds.join(several, "anchor").select("anchor", "copies", (F.col("kinds") > hot_cells).alias("hot"), "one.row_key", "one.first", "one.last"),
        "cells_to_compare")
    size = wanted.where("NOT hot").agg(F.sum(F.col("last") - F.col("first") + length)).first()[0] or 0
    cut = materialize(_cut_out(docs, wanted, length), "cell_contents")
    by_bwt = _ranges_by_bwt(cut.where("NOT hot"), -(-size // bucket_bytes) or 1, length)
    by_window = _ranges_by_window(cut.where("hot"), length)
    return materialize(copied.unionByName(by_bwt).unionByName(by_window), "covered_ranges")


def cut_ranges(raw: bytes, ranges: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left."""
    kept, removed, spans, at, end = [], 0, 0, 0, -1
    for start, stop in sorted(ranges):
        if start > end:  # ranges that touch are one run
            kept.append(raw[at:start])
            spans += 1
            end = start
        if stop > end:
            removed += stop - end
            end = at = stop
    kept.append(raw[at:])
    return removed, spans, b"".join(kept)


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text of every document.
    kept_text is what remains; a character of which bytes were removed is left out."""
    kind = dict(docs.dtypes)[id_col]
    keyed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), _row_key(id_col, text_or_empty(text_col)).alias("row_key"), text_or_empty(text_col).alias("text"))
    ranges = repeated_ranges(keyed, **how)
    flagged = flag_keys(keyed, "row_key", materialize(key_bitmap(ranges, "row_key"), "range_bitmap"))
    whole = flagged.where("NOT maybe").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), F.col("text").alias("kept_text"))
    per_doc = ranges.groupBy("row_key").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text, found in zip(b["text"], b["ranges"], strict=True):
                raw = text.encode("utf-8")
                removed, spans, left = cut_ranges(raw, [(r["start"], r["stop"]) for r in found] if found is not None else [])
                rows.append((len(raw), removed, spans, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore")))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out

    parted = flagged.where("maybe").join(per_doc, "row_key", "left").select("doc_id", "text", "ranges").mapInPandas(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
    return whole.unionByName(parted)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(read_table(spark, sf_dir, "documents"))
