"""Near-duplicate classes by BagMinHash, banding and exact overlap (operator 4).

A document is the multiset of its five-word shingles; two are near duplicates
when the sum of the smaller counts is at least 0.8 of the sum of the larger.

Signature. The weight axis of a shingle is cut into [0, 1), [1, 2), [2, 4), ...
and each stretch has a Poisson process in time whose rate is its width; a point
falls on a place of the stretch and on one of M components, all drawn from a
hash of shingle, stretch and number. Points on places beyond the shingle's
count don't count for the document. Each component keeps its earliest point;
two documents agree in a component with their weighted Jaccard similarity as
the probability. A process stops as soon as its time passes the document's
latest component, and a count of n needs log2(n) + 1 processes, not n.

Classes. Documents with equal multisets are one node. Nodes that agree in all
components of a band share a bucket, whose center is the node that meets most
others in its buckets. Pairs are compared by their whole texts, exactly, and those
that hold make classes (connected components). Each node is compared first with
the first of its centers and then with each center of another class. In buckets
that still hold several classes, every pair of different classes is compared in
the end: the nodes outside the bucket's largest class with each other and with
that class, in blocks of bounded size that are dealt out, each block pair as a
product of 0/1 matrices. So every pair that shares a bucket is in one class or has
been compared. Rows grow with the nodes of buckets; where a bucket keeps many
classes, with its nodes times its blocks.

A pair of similarity 0.8 shares a bucket with probability 1 - (1 - 0.8^6)^32 =
0.99994; only this can miss a link.

Sizes: only hashes travel for all documents. Texts travel for nodes of linked
pairs alone, picked out by a 512 KiB bitmap of their digests (a bit shared by
chance moves a text for nothing). Hot buckets and copies are
aggregated map-side; joins are left to AQE, which splits skewed partitions.

Defined cases: null text counts as empty; texts without words are equal to each
other; one to four words are one shingle; null ids lose ties; repeated rows
return a row each, one of which may be kept; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.llm.common import claim_memory, flag_keys, key_bitmap, materialize, read_table, text_or_empty, whole_row
from larch.llm.shingles import mix, multiset_overlap, shingles

BANDS, BAND_ROWS = 32, 6
COMPONENTS = BANDS * BAND_ROWS
#: Similarity at least NUMERATOR / DENOMINATOR.
NUMERATOR, DENOMINATOR = 4, 5
BATCH_SHINGLES = 400_000
#: A block of nodes that are compared each with each of another block.
BLOCK_NODES, BLOCK_SHINGLES = 512, 1_000_000
#: Shingles of a block pair that are multiplied at a time.
BLOCK_COLUMNS = 2048
_GOLDEN = 0x9E3779B97F4A7C15  # the SplitMix64 increment
_STEP = np.uint64(_GOLDEN)
_UNIT = 2.0 ** -53
#: This operator keeps nothing in a worker between tasks.
OWNER = "near_dedup"


def _steps(n: int) -> np.uint64:
    return np.uint64(n * _GOLDEN % 2 ** 64)


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1] from 64-bit hashes."""
    return ((x >> np.uint64(11)) + np.uint64(1)) * _UNIT


def bag_min_hash(docs: list[tuple[np.ndarray, np.ndarray]], components: int = COMPONENTS) -> np.ndarray:
    """Earliest times (documents, components) of multisets of (hashes, counts).
    Equal times are the same point; a document without shingles has inf."""
    sizes = [len(h) for h, _ in docs]
    owner = np.repeat(np.arange(len(docs)), sizes)
    key = np.concatenate([h for h, _ in docs]) if docs else np.zeros(0, dtype=np.uint64)
    weight = np.concatenate([c for _, c in docs]).astype(np.float64) if docs else np.zeros(0)
    # one process per stretch of the weight axis that the weight reaches into
    parts, low, level = [(key, owner, weight, 0.0, 1.0)], 1.0, 1
    while (more := weight > low).any():
        parts.append((mix(key[more] + _steps(level)), owner[more], weight[more], low, low))
        low, level = 2 * low, level + 1
    seed, own, top = (np.concatenate([p[i] for p in parts]) for i in range(3))
    start, width = (np.repeat([p[i] for p in parts], [len(p[0]) for p in parts]) for i in (3, 4))
    out = np.full(len(docs) * components, np.inf)
    time, step = np.zeros(len(seed)), 0
    while len(seed):
        step += 1
        x = mix(seed + _steps(step))
        time = time - np.log(_uniform(x)) / width
        y = mix(x ^ _STEP)
        counts = start + width * _uniform(mix(y + _STEP)) <= top
        where = own * components + (y % np.uint64(components)).astype(np.int64)
        np.minimum.at(out, where[counts], time[counts])
        latest = out.reshape(-1, components).max(axis=1)
        go = time < latest[own]
        seed, own, top, start, width, time = (a[go] for a in (seed, own, top, start, width, time))
    return out.reshape(len(docs), components)


def band_hashes(times: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit hash per band, which differs between bands."""
    bits = np.ascontiguousarray(times).view(np.uint64).reshape(len(times), bands, -1)
    out = mix(np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, bits.shape[:2]))
    for k in range(bits.shape[2]):
        out = mix(out * np.uint64(31) + bits[:, :, k])
    return out.view(np.int64)


def node_of(bag: tuple[np.ndarray, np.ndarray]) -> bytes:
    return hashlib.md5(bag[0].tobytes() + bag[1].astype("<i8").tobytes()).digest()


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key, node, shingles and the bands of every document."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim_memory(OWNER)
        for b in batches:
            at = 0
            while at < len(b):
                bags, size, first = [], 0, at
                while at < len(b) and size < BATCH_SHINGLES:
                    bags.append(shingles(b["text"].iat[at]))
                    size += len(bags[-1][0])
                    at += 1
                hashes = band_hashes(bag_min_hash(bags))
                part = b.iloc[first:at][["doc_id", "text_key"]].reset_index(drop=True)
                yield part.assign(node=[node_of(x) for x in bags], size=[int(x[1].sum()) for x in bags],
                                  bands=[list(h) if len(x[0]) else [] for h, x in zip(hashes, bags, strict=True)])

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn(
        "text_key", F.md5("text")).mapInPandas(run, f"doc_id {kind}, text_key string, node binary, size long, bands array<long>")


def _texts_of(docs: DataFrame, keys: DataFrame, text_col: str) -> DataFrame:
    """(node, text) for (node, text_key); a bitmap of bounded size keeps other texts at home."""
    keyed = docs.select(text_or_empty(text_col).alias("text")).withColumn("text_key", F.md5("text"))
    texts = flag_keys(keyed, "text_key", key_bitmap(keys, "text_key")).where("maybe").groupBy("text_key").agg(F.first("text").alias("text"))
    return texts.join(keys, "text_key").select("node", "text")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim_memory(OWNER)
        last: tuple[str, tuple] | None = None
        for p in batches:
            keep = []
            for ta, tb in zip(p["text_a"], p["text_b"], strict=True):
                if last is None or last[0] != tb:
                    last = tb, shingles(tb)
                both, either = multiset_overlap(shingles(ta), last[1])
                keep.append(DENOMINATOR * both >= NUMERATOR * either)
            yield p.loc[keep, ["a", "b"]]

    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInPandas(run, "a binary, b binary")


def connected(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each component, by passing on the
    smallest label and halving the paths, until nothing moves."""
    both = materialize(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        passed = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = materialize(passed.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "labels")
        if new.where("old != label").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _roots(parents: DataFrame) -> DataFrame:
    """(node, label) from links (a, b) with one b per a, before it in some order:
    the end of each node's chain, by doubling the steps."""
    labels = materialize(parents.select(F.col("a").alias("node"), F.col("b").alias("label")), "labels")
    while True:
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = materialize(labels.join(jump, "label", "left").select("node", F.coalesce("far", "label").alias("label"), "far"), "labels")
        if new.where("far IS NOT NULL").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links: only the classes that they join are labelled anew."""
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    known = materialize(labels.join(ends, "node", "full").select("node", F.coalesce("label", "node").alias("label")), "labels")
    of = known.select(F.col("node").alias("a"), F.col("label").alias("la")), known.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    between = links.join(of[0], "a").join(of[1], "b").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    joined = connected(between).select(F.col("node").alias("label"), F.col("label").alias("now"))
    return materialize(known.join(joined, "label", "left").select("node", F.coalesce("now", "label").alias("label")), "labels")


def elements(bag: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A multiset as a set: a hash per shingle and repeat."""
    h, c = bag
    if not len(c) or c.max() == 1:
        return h
    turn = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
    out = np.repeat(h, c)
    again = turn > 0
    out[again] = mix(out[again] + turn[again].astype(np.uint64) * _STEP)
    return out


def similar(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Which sets of ``left`` are near duplicates of which of ``right``."""
    sets, n = [*left, *right], len(left)
    size = np.array([len(x) for x in sets])
    _, column, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, shared = np.repeat(np.arange(len(sets)), size), holders > 1
    keep = shared[column]
    owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((n, len(right)))
    for first in range(0, int(shared.sum()), BLOCK_COLUMNS):
        i, j = np.searchsorted(column, [first, first + BLOCK_COLUMNS])
        x = np.zeros((len(sets), BLOCK_COLUMNS), dtype=np.float32)
        x[owner[i:j], column[i:j] - first] = 1
        both += x[:n] @ x[n:].T
    return DENOMINATOR * both >= NUMERATOR * (size[:n, None] + size[None, n:] - both)


def block_links(rows: list[tuple], i: int, j: int) -> list[tuple[bytes, bytes]]:
    """Links that join the classes of similar pairs of block i and block j.
    rows: (block, node, label, elements)."""
    left, right = [r for r in rows if r[0] == i], [r for r in rows if r[0] == j]
    if not left or not right:
        return []
    root = {label: label for _, _, label, _ in rows}

    def find(x: bytes) -> bytes:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    code = {label: k for k, label in enumerate(root)}
    of = [np.array([code[r[2]] for r in side]) for side in (left, right)]
    held = similar([r[3] for r in left], [r[3] for r in right]) & (of[0][:, None] != of[1][None, :])
    out = []
    for k, m in zip(*np.nonzero(held), strict=True):
        (_, a, la, _), (_, b, lb, _) = left[k], right[m]
        if (ra := find(la)) != (rb := find(lb)):
            root[ra] = rb
            out.append((max(a, b), min(a, b)))
    return out


def _compared(members: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that join all classes with a similar pair in some bucket.
    Buckets of two have been compared by their center."""
    labelled = members.where("n > 2").select("bucket", "node", "size").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    labelled = materialize(labelled, "labelled")
    per = labelled.groupBy("bucket", "label").agg(
        F.count("*").alias("n"), F.sum("size").alias("size"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"))
    several = per.groupBy("bucket").agg(
        F.count("*").alias("classes"), F.sum("n").alias("n"), F.sum("size").alias("size"),
        F.max(F.struct("n", "label", "size")).alias("main"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"),
    ).where("classes > 1").dropDuplicates(["n", "x", "y"])  # buckets of the same nodes once

    def blocks(n: Column, size: Column) -> Column:
        return F.ceil(F.greatest(n / BLOCK_NODES, size / BLOCK_SHINGLES)).cast("int")

    whole = blocks(F.col("n"), F.col("size")) <= 1
    rest = blocks(F.col("n") - F.col("main.n"), F.col("size") - F.col("main.size"))
    several = several.select(
        "bucket", F.when(~whole, F.col("main.label")).alias("main"), F.when(whole, 1).otherwise(rest).alias("rest_blocks"),
        F.when(whole, 0).otherwise(blocks(F.col("main.n"), F.col("main.size"))).alias("main_blocks"))
    # blocks of the largest class come behind the others and aren't compared with one another
    in_main = F.coalesce(F.col("label") == F.col("main"), F.lit(False))
    at = F.when(in_main, F.col("rest_blocks") + F.pmod(F.xxhash64("node"), "main_blocks")).otherwise(
        F.pmod(F.xxhash64("node"), "rest_blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("rest_blocks") - 1 + F.when(in_main, 0).otherwise(F.col("main_blocks")))
    dealt = labelled.join(several, "bucket").select("bucket", "node", "label", at.alias("at"), F.explode(others).alias("with"))
    dealt = dealt.select("bucket", F.least("at", "with").alias("i"), F.greatest("at", "with").alias("j"), "at", "node", "label")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim_memory(OWNER)
        key, rows, found = None, [], []
        for p in batches:
            for bucket, i, j, at, node, label, text in p.itertuples(index=False, name=None):
                if (bucket, i, j) != key:
                    if rows:
                        found += block_links(rows, *key[1:])
                    key, rows = (bucket, i, j), []
                rows.append((at, bytes(node), bytes(label), elements(shingles(text))))
            yield pd.DataFrame(found, columns=["a", "b"])
            found = []
        if rows:
            yield pd.DataFrame(block_links(rows, *key[1:]), columns=["a", "b"])

    group = ["bucket", "i", "j"]
    return dealt.join(texts, "node").select(*group, "at", "node", "label", "text").repartition(*group).sortWithinPartitions(
        *group).mapInPandas(run, "a binary, b binary").distinct()


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key, node, copies) of the documents and (node, label) of
    the nodes that have a near duplicate of another node."""
    signed = materialize(_signed(docs, id_col, text_col), "signatures")
    nodes = signed.groupBy("node").agg(F.min(F.struct("text_key", "size", "bands")).alias("x")).select(
        "node", "x.text_key", "x.size", "x.bands")
    buckets = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(buckets.join(shared, "bucket"), "members")
    meets = members.groupBy("node").agg(F.sum("n").alias("meets"))
    members = members.join(meets, "node")
    centers = members.groupBy("bucket").agg(F.max(F.struct("meets", "node")).alias("center"))
    members = materialize(members.drop("meets").join(centers, "bucket"), "buckets")

    # first every node meets the first of its centers only: one pair per node
    tried = materialize(members.groupBy("node").agg(F.max("center").alias("center")).where("node != center.node").select(
        F.col("node").alias("a"), F.col("center.node").alias("b")), "pairs")
    keys = nodes.select("node", "text_key").join(members.select("node").distinct(), "node")
    texts = materialize(_texts_of(docs, keys, text_col), "bucket_texts")
    labels = _roots(materialize(_verified(tried, texts), "near_links"))
    # then each center of another class
    pairs = members.select(F.col("node").alias("a"), F.col("center.node").alias("b")).where("a != b").distinct()
    of = (labels.select(F.col("node").alias(x), F.col("label").alias(f"l{x}")) for x in "ab")
    for table, x in zip(of, "ab", strict=True):
        pairs = pairs.join(table, x, "left").withColumn(f"l{x}", F.coalesce(f"l{x}", x))
    new = materialize(pairs.where("la != lb").select("a", "b").join(tried, ["a", "b"], "left_anti"), "pairs")
    labels = _joined(labels, materialize(_verified(new, texts), "near_links"))
    # and all that is left in buckets of several classes
    labels = _joined(labels, materialize(_compared(members, labels, texts), "near_links"))
    rows = signed.groupBy("doc_id", "text_key", "node").agg(F.count("*").alias("copies"))
    return rows, labels


def _decided(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key, copies, class id and size, and whether the row is its class's best."""
    rows, labels = near_classes(docs, id_col, text_col)
    labelled = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    best = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("text_key"))
    classes = labelled.groupBy("label").agg(F.min(best).alias("best"), F.sum("copies").alias("class_size"))
    return labelled.join(classes, "label").select(
        "doc_id", "text_key", "copies", F.col("best.doc_id").alias("class_id"), "class_size", best.eqNullSafe(F.col("best")).alias("is_best"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (smallest id of the class), class_size, kept of every document."""
    return _decided(docs, id_col, text_col).select(
        "doc_id", "class_id", F.col("class_size").cast("long").alias("class_size"), "is_best",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("k"),
    ).select("doc_id", "class_id", "class_size", (F.col("is_best") & (F.col("k") == 1)).alias("kept"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, with all its columns. Documents that are
    alone in their class pass without a shuffle."""
    decided = materialize(_decided(docs, id_col, text_col).where("class_size > 1"), "near_classes")
    keyed = docs.select(
        whole_row(docs), F.col(f"`{id_col}`").alias("doc_id"), F.md5(text_or_empty(text_col)).alias("text_key"))
    flagged = flag_keys(keyed, "text_key", materialize(key_bitmap(decided, "text_key"), "class_bitmap"))
    d = decided.select(F.col("doc_id").alias("d_id"), F.col("text_key").alias("d_key"), "is_best")
    looked_up = flagged.where("maybe").join(d, F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("text_key") == F.col("d_key")), "left")
    alone = looked_up.where("is_best IS NULL").select("row.*")
    best = looked_up.where("is_best").groupBy("doc_id", "text_key").agg(F.first("row").alias("row")).select("row.*")
    return flagged.where("NOT maybe").select("row.*").unionByName(alone).unionByName(best)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
