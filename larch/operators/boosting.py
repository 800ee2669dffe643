"""Second-order boosted trees by histograms.

Each tree is grown level by level. A level is one Spark job: rows walk the tree so far,
and a task sums gradients and hessians by (model, node, bin); ``groupBy`` (model, node)
adds them up and finds the node's best split. The driver sees one row per node. All
candidates of a search grow side by side, so a level is one job whatever their number.

The categorical column with the most codes is the *wide* one. Rows of a code lie in one
partition (those of codes with more than ``HEAVY_ROWS`` are dealt out), so a task has whole
sums of its codes. With one-hot splits it tells the best of them only; at the root, and
with ``"partition"``, all: 24 bytes for each that occurs in the node.

A leaf is ``-G / (H + l2)`` times eta, a split's gain
``1/2 (GL^2/(HL + l2) + GR^2/(HR + l2) - G^2/(H + l2))``; both children need a hessian of
``min_child`` at least. Numeric columns are cut at up to ``MAX_BINS`` quantiles.
Categories need no bins: with ``"partition"`` they are ordered by G/(H + l2) and cut
there, which is the best partition in two; with ``"onehot"`` one category goes right, as
if each had a 0/1 column.

Early stopping: the loss of the validation rows is summed in the same job, after each
tree. A model whose loss hasn't fallen for ``patience`` trees ends, and is cut at its
best tree.

Margins are kept with the rows and brought up to date every ``KEEP`` trees; the trees
since then are walked on the way. Each time they are made anew from the rows as first
binned, whose plan is one scan: the driver keeps a text of every plan, which would double
with each cached frame that another one reads.
"""

from __future__ import annotations

import base64
import json
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from larch.session import ROWS_PER_PARTITION, leaf, show_package, target_partitions

MAX_BINS = 256
QUANTILE_ERROR = 0.001
KEEP = 10
LEAST_GAIN = 1e-6
#: Rows of a value of the wide column above which they are dealt out over tasks.
HEAVY_ROWS = 4 * ROWS_PER_PARTITION

#: How often each model learns from each row of a batch: frame -> (rows, models).
Members = Callable[[pd.DataFrame], np.ndarray]


@dataclass(frozen=True)
class Booster:
    """What one candidate is."""

    n_trees: int
    max_depth: int
    eta: float
    l2: float = 1.0
    min_child: float = 1.0
    patience: int = 0     # trees without a lower validation loss; 0: none
    share: float = 1.0    # columns, one-hot ones too, that a node may split on
    seed: tuple[int, ...] = ()


@dataclass
class Columns:
    """How a row's numbers become bins: quantile edges of numeric columns, sizes of categorical ones."""

    edges: list[np.ndarray]
    sizes: list[int]

    @property
    def widths(self) -> np.ndarray:
        return np.array([len(e) + 1 for e in self.edges] + list(self.sizes), dtype=np.int64)

    @property
    def first(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.widths)])

    @property
    def wide(self) -> int | None:
        """The categorical column with the most codes, if that is more than ``MAX_BINS``."""
        if not self.sizes or max(self.sizes) <= MAX_BINS:
            return None
        return len(self.edges) + int(np.argmax(self.sizes))

    @property
    def narrow_first(self) -> np.ndarray:
        """As ``first``, without the wide column."""
        w = self.widths.copy()
        if self.wide is not None:
            w[self.wide] = 0
        return np.concatenate([[0], np.cumsum(w)])

    def bins(self, x: np.ndarray) -> np.ndarray:
        """(rows, columns) bins, counted through all columns. Unknown categories take the last code."""
        out = np.empty(x.shape, dtype=np.int64)
        for j, e in enumerate(self.edges):
            out[:, j] = np.searchsorted(e, x[:, j], side="left")
        for j, size in enumerate(self.sizes, len(self.edges)):
            out[:, j] = np.clip(x[:, j], 0, size - 1)
        return out + self.first[:-1]


#: How a split tells bins that go left: up to a bin, all but a bin, or a packed set of bins.
UP_TO, ALL_BUT, IN_SET = 0, 1, 2


@dataclass
class Tree:
    """Node i splits on column[i] (-1: leaf): bins that left[i] = (kind, bin or packed set)
    takes go to node kids[i], others to kids[i] + 1. value[i] is a leaf's margin."""

    column: list[int] = field(default_factory=lambda: [-1])
    left: list[tuple | None] = field(default_factory=lambda: [None])
    kids: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def leaf_of(self, bins: np.ndarray, first: np.ndarray) -> np.ndarray:
        at = np.zeros(len(bins), dtype=np.int32)
        rows: dict[int, np.ndarray] = {0: np.arange(len(bins))}
        for i, c in enumerate(self.column):  # a node's children come behind it
            if c >= 0:
                here = rows.pop(i)
                goes = _goes_left(self.left[i], bins[here, c] - first[c])
                rows[self.kids[i]], rows[self.kids[i] + 1] = here[goes], here[~goes]
        for i, here in rows.items():
            at[here] = i
        return at

    def margin(self, bins: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaf_of(bins, first)]

    def split(self, i: int, column: int, left: tuple) -> None:
        self.column[i], self.left[i], self.kids[i] = column, left, len(self.column)
        for _ in range(2):
            self.column.append(-1)
            self.left.append(None)
            self.kids.append(0)
            self.value.append(0.0)


def _goes_left(rule: tuple, bins: np.ndarray) -> np.ndarray:
    kind, what = rule
    if kind == UP_TO:
        return bins <= what
    if kind == ALL_BUT:
        return bins != what
    packed = np.frombuffer(what, dtype=np.uint8)
    byte = bins >> 3
    inside = byte < len(packed)
    return inside & ((packed[np.where(inside, byte, 0)] >> (7 - (bins & 7))) & 1).astype(bool)


def _packed(bins: np.ndarray) -> bytes:
    """A set of bins as bits; those behind the last byte are not in it."""
    mask = np.zeros(int(bins.max()) + 1, dtype=bool)
    mask[bins] = True
    return np.packbits(mask).tobytes()


def numeric_edges(df: DataFrame, columns: list[str]) -> list[np.ndarray]:
    """Distinct quantiles of each column; a value up to an edge lies below it."""
    if not columns:
        return []
    at = list(np.arange(1, MAX_BINS) / MAX_BINS)
    return [np.unique(q) for q in df.approxQuantile(columns, at, QUANTILE_ERROR)]


def stride_edges(df: DataFrame, x: str, n_numeric: int, n_bins: int) -> list[np.ndarray]:
    """Cut points of numeric columns for classification trees, as MLlib's: midpoints of
    distinct values, or of those next to equal strides; from ``max(n_bins ** 2, 10,000)``
    rows or so, by a hash of the row. Rows are never left out of the trees."""
    n, need = df.count(), max(n_bins * n_bins, 10_000)
    some = df if n <= need else df.where(F.pmod(F.xxhash64(x), F.lit(1_000_000)) < int(1_000_000 * need / n))
    seen = some.select(*[F.col(x)[i].alias(f"x{i}") for i in range(n_numeric)]).toArrow().to_pandas().to_numpy(dtype=float)
    out = []
    for column in seen.T:
        values, counts = np.unique(column, return_counts=True)
        middle = (values[1:] + values[:-1]) / 2
        if len(middle) > n_bins - 1:
            stride = len(column) / n_bins
            target, kept, total = stride, [], np.cumsum(counts)
            for i in range(1, len(values)):
                if abs(total[i - 1] - target) < abs(total[i] - target):
                    kept.append(i - 1)
                    target += stride
            middle = middle[kept]
        out.append(middle)
    return out


def binned_rows(df: DataFrame, numeric: list[str], categorical: list[str], sizes: list[int], label: str, valid: str | None = None) -> tuple[DataFrame, Columns]:
    """(label, valid, x) of the rows and their bins. Categorical columns are codes."""
    show_package(df.sparkSession)
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in [*numeric, *categorical]])
    rows = df.select(F.col(label).cast("double").alias("label"), (F.col(valid) if valid else F.lit(False)).alias("valid"), x.alias("x"))
    return rows, Columns(numeric_edges(df, numeric), sizes)


def vector_rows(df: DataFrame, features: str, n_numeric: int, sizes: list[int], label: str, *keep: str, valid: str | None = None,
                n_bins: int | None = None) -> tuple[DataFrame, Columns]:
    """The same of a vector of numeric columns and codes, with the ``keep`` columns.
    ``n_bins``: cut numeric columns by :func:`stride_edges`."""
    show_package(df.sparkSession)
    flat = df.select(F.col(label).cast("double").alias("label"), (F.col(valid) if valid else F.lit(False)).alias("valid"),
                     vector_to_array(F.col(features)).alias("x"), *keep).persist(StorageLevel.MEMORY_AND_DISK)
    if n_bins:
        return flat, Columns(stride_edges(flat, "x", n_numeric, n_bins), sizes)
    edges = numeric_edges(flat.select(*[F.col("x")[i].alias(f"x{i}") for i in range(n_numeric)]), [f"x{i}" for i in range(n_numeric)])
    return flat, Columns(edges, sizes)


def _best_cut(cats: np.ndarray, g: np.ndarray, h: np.ndarray, total_g: float, total_h: float, b: Booster, way: str,
              allowed: np.ndarray | None = None) -> tuple[float, tuple, float, float] | None:
    """(gain, rule, g and h of the left side) of one column: its bins in order and their sums.
    ``allowed``: bins that the node may split on."""
    if not len(cats):
        return None
    if way == "onehot":  # one category against the others
        gl, hl, can = total_g - g, total_h - h, h > 0
        if allowed is not None:
            can &= allowed[cats]
    else:
        if way == "partition":
            present = np.flatnonzero(h > 0)
            cats, g, h = cats[present], g[present], h[present]
            order = np.argsort(g / (h + b.l2), kind="stable")
            cats, g, h = cats[order], g[order], h[order]
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        can = np.ones(len(gl), dtype=bool)
    gr, hr = total_g - gl, total_h - hl
    ok = can & (hl >= b.min_child) & (hr >= b.min_child)
    if not ok.any():
        return None
    at = np.flatnonzero(ok)
    gl, hl, gr, hr = gl[at], hl[at], gr[at], hr[at]
    gain = gl * gl / (hl + b.l2) + gr * gr / (hr + b.l2) - total_g * total_g / (total_h + b.l2)
    i = int(gain.argmax())
    if not gain[i] / 2 > LEAST_GAIN:
        return None
    k = int(at[i])
    rule = {"onehot": lambda: (ALL_BUT, int(cats[k])), "numeric": lambda: (UP_TO, int(cats[k])),
            "partition": lambda: (IN_SET, _packed(cats[:k + 1]))}[way]()
    return float(gain[i] / 2), rule, float(gl[i]), float(hl[i])


def _chosen(columns: Columns, b: Booster, node: int) -> list[np.ndarray] | None:
    """The bins of every column on which a node may split, drawn anew for every node: a
    share of numeric columns and categories, as if each category were a column."""
    if b.share >= 1:
        return None
    nn = len(columns.edges)
    slots = [1] * nn + [max(s - 1, 0) for s in columns.sizes]  # the last code stands for unknown ones
    n = sum(slots)
    kept = np.zeros(n, dtype=bool)
    kept[np.random.default_rng([*b.seed, node]).choice(n, max(1, int(np.ceil(b.share * n))), replace=False, shuffle=False)] = True
    ends = np.cumsum(slots)
    return [np.append(kept[e - s:e], False) for s, e in zip(slots, ends)]


def best_split(narrow: tuple[np.ndarray, np.ndarray], wide: tuple[np.ndarray, np.ndarray, np.ndarray], total: tuple[float, float],
               columns: Columns, b: Booster, splits: str, node: int) -> tuple[float, int, tuple, float, float] | None:
    """(gain, column, rule, g and h of the left side) of a node: sums of the narrow columns by
    bin, and of the wide one's bins that may count."""
    first, best, chosen = columns.narrow_first, None, _chosen(columns, b, node)
    for c in range(len(columns.widths)):
        way = "numeric" if c < len(columns.edges) else splits
        if chosen is not None and way == "numeric" and not chosen[c][0]:
            continue
        if c == columns.wide:
            cats, g, h = wide
        else:
            cats, g, h = np.arange(columns.widths[c]), narrow[0][first[c]:first[c + 1]], narrow[1][first[c]:first[c + 1]]
        found = _best_cut(cats, g, h, *total, b, way, None if chosen is None else chosen[c])
        if found and (best is None or found[0] > best[0]):
            best = found[0], c, *found[1:]
    return best


def _gradients(objective: str, margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradient, hessian and loss of every row and model."""
    if objective == "logistic":
        p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
        return p - y[:, None], np.maximum(p * (1 - p), 1e-16), np.logaddexp(0, np.where(y[:, None] > 0, -margin, margin))
    return margin - y[:, None], np.ones_like(margin), 0.5 * (margin - y[:, None]) ** 2


@dataclass
class Boosted:
    """The trees of every candidate, cut at their best, and validation losses by tree."""

    trees: list[list[Tree]]
    base: float
    losses: list[list[float]]
    columns: Columns
    objective: str
    rows: DataFrame | None = None  # with ``margin``, one per candidate, if asked for


def patience_end(losses: list[float], patience: int) -> tuple[int, bool]:
    """(trees to keep, whether to stop) after losses of 1, 2, ... trees."""
    best = int(np.argmin(losses)) + 1
    return best, patience > 0 and len(losses) - best >= patience


MODEL_ROWS = "label binary, valid binary, bins binary, inside binary, own binary"
KEPT_ROWS = "label binary, valid binary, bins binary, inside binary, margin binary"
NODE_SUMS = "model int, node int, tg double, th double, narrow binary, cats binary, cg binary, ch binary"
NODE_SPLITS = "model int, node int, g double, h double, gain double, column int, kind int, k int, bits binary, gl double, hl double"


def _blocks(rows: DataFrame, columns: Columns, m: int, members: Members | None, keep_rows: bool) -> tuple[DataFrame, np.ndarray]:
    """Rows as blocks of binned arrays, those of a value of the wide column in one partition,
    and the values too frequent for that, whose rows are dealt out."""
    heavy = np.zeros(0, dtype=np.int64)
    if columns.wide is not None:
        code = F.least(F.greatest(F.col("x")[columns.wide], F.lit(0.0)), F.lit(float(columns.widths[columns.wide] - 1))).cast("int")
        keyed = rows.withColumn("_code", code)
        n = rows.count()
        most = [r[0] for r in keyed.groupBy("_code").count().where(F.col("count") > HEAVY_ROWS).select("_code").collect()]  # n / HEAVY_ROWS at most
        heavy = np.array(sorted(most), dtype=np.int64)
        key = F.when(F.col("_code").isin(*most), F.xxhash64("x", "label")).otherwise(F.col("_code")) if most else F.col("_code")
        rows = keyed.withColumn("_code", key).repartition(target_partitions(n), "_code").drop("_code")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def block(frame: pd.DataFrame) -> pd.DataFrame:
            inside = members(frame) if members is not None else np.tile(~frame["valid"].to_numpy(dtype=bool)[:, None], (1, m))
            out = {"label": frame["label"].to_numpy(dtype=float), "valid": frame["valid"].to_numpy(dtype=np.uint8),
                   "bins": columns.bins(np.stack(frame["x"].tolist())).astype(np.int32), "inside": inside.astype(np.uint8)}
            own = pickle.dumps(frame) if keep_rows else b""
            return pd.DataFrame({k: [v.tobytes()] for k, v in out.items()} | {"own": [own]})

        held: list[pd.DataFrame] = []
        for frame in batches:
            held.append(frame)
            if sum(map(len, held)) >= ROWS_PER_PARTITION:
                yield block(pd.concat(held, ignore_index=True))
                held = []
        if sum(map(len, held)):
            yield block(pd.concat(held, ignore_index=True))

    return leaf(rows.mapInPandas(run, MODEL_ROWS)).persist(StorageLevel.MEMORY_AND_DISK), heavy


@dataclass
class _Block:
    y: np.ndarray
    held: np.ndarray
    bins: np.ndarray
    inside: np.ndarray
    margin: np.ndarray

    @staticmethod
    def each(frame: pd.DataFrame, columns: Columns, m: int, fresh: list[list[Tree]], base: float = 0.0) -> Iterator[_Block]:
        """The blocks of a batch, their margins brought up to date; from ``base`` if they have none."""
        for r in frame.itertuples(index=False):
            y = np.frombuffer(r.label)
            n = len(y)
            bins = np.frombuffer(r.bins, dtype=np.int32).reshape(n, -1)
            margin = np.frombuffer(r.margin).reshape(n, m).copy() if "margin" in frame else np.full((n, m), float(base))
            for j, own in enumerate(fresh):
                for t in own:
                    margin[:, j] += t.margin(bins, columns.first)
            yield _Block(y, np.frombuffer(r.valid, dtype=np.uint8).astype(bool), bins, np.frombuffer(r.inside, dtype=np.uint8).reshape(n, m), margin)


def fit(rows: DataFrame, columns: Columns, boosters: list[Booster], objective: str = "logistic", splits: str = "partition",
        members: Members | None = None, keep_rows: bool = False) -> Boosted:
    """All candidates together. ``rows``: label, valid, x (:func:`binned_rows`) and what
    ``members`` reads, which tells how often (0, 1, ...) each candidate learns from each row
    (rows, candidates); by default once from all that are not held for validation."""
    m = len(boosters)
    deepest = max(b.max_depth for b in boosters)
    base = 0.0
    if objective == "squared":
        base = rows.where("NOT valid").agg(F.avg("label")).first()[0] or 0.0
    schema = rows.schema
    blocks, heavy = _blocks(rows, columns, m, members, keep_rows)
    trees: list[list[Tree]] = [[] for _ in range(m)]
    kept = _kept(blocks, trees, columns, m, base).persist(StorageLevel.MEMORY_AND_DISK)
    fresh: list[list[Tree]] = [[] for _ in range(m)]  # grown since the margins were kept
    losses: list[list[float]] = [[] for _ in range(m)]
    ended = [b.n_trees == 0 for b in boosters]
    has_valid = any(b.patience for b in boosters)

    def level(kept: DataFrame, fresh: list[list[Tree]], grown: dict[int, Tree], wanted: dict[int, list[int]],
              totals: dict[tuple[int, int], tuple[float, float]], with_loss: bool) -> pd.DataFrame:
        """A row per wanted node: sums and best split; node -1: validation loss and rows."""
        parts = kept.mapInPandas(_node_sums(columns, boosters, objective, splits, heavy, fresh, grown, wanted, totals, with_loss), NODE_SUMS)
        found = parts.groupBy("model", "node").applyInPandas(_node_split(columns, boosters, splits), NODE_SPLITS)
        return found.toArrow().to_pandas()

    def take_losses(table: pd.DataFrame) -> None:
        for _, r in table[(table["node"] == -1) & (table["h"] > 0)].iterrows():
            j = int(r["model"])
            if trees[j] and not ended[j] and len(losses[j]) < len(trees[j]):
                losses[j].append(r["g"] / r["h"])
                keep, stop = patience_end(losses[j], boosters[j].patience)
                ended[j] = ended[j] or stop

    while not all(ended):
        grown: dict[int, Tree] = {}
        totals: dict[tuple[int, int], tuple[float, float]] = {}
        wanted: dict[int, list[int]] = {}
        for depth in range(max(deepest, 1)):
            if depth == 0:
                grown = {j: Tree() for j in range(m) if not ended[j]}
                wanted = {j: [0] for j in grown}
            if not wanted:
                break
            table = level(kept, fresh, {j: grown[j] for j in wanted}, wanted, totals, depth == 0 and has_valid)
            if depth == 0 and has_valid:
                take_losses(table)
                grown = {j: t for j, t in grown.items() if not ended[j]}
            wanted = {}
            for r in table[table["node"] >= 0].sort_values(["model", "node"]).itertuples(index=False):
                j, node = int(r.model), int(r.node)
                if j not in grown:
                    continue
                b, t = boosters[j], grown[j]
                t.value[node] = _leaf(r.g, r.h, b)
                if depth < b.max_depth and r.column >= 0:
                    t.split(node, int(r.column), (int(r.kind), bytes(r.bits) if r.kind == IN_SET else int(r.k)))
                    for k, own in enumerate(((r.gl, r.hl), (r.g - r.gl, max(r.h - r.hl, 0.0)))):
                        kid = t.kids[node] + k
                        t.value[kid] = _leaf(*own, b)  # the lowest leaves need no sums of their own
                        if depth + 1 < b.max_depth:
                            totals[j, kid] = own
                            wanted.setdefault(j, []).append(kid)
        for j, t in grown.items():
            trees[j].append(t)
            fresh[j].append(t)
            if len(trees[j]) >= boosters[j].n_trees and not boosters[j].patience:
                ended[j] = True
        if has_valid:  # a full model still needs the loss of its last tree
            last = [j for j in range(m) if not ended[j] and len(trees[j]) >= boosters[j].n_trees]
            if last:
                take_losses(level(kept, fresh, {}, {}, {}, True))
                for j in last:
                    ended[j] = True
        if max((len(x) for x in fresh), default=0) >= KEEP and not all(ended):
            kept.unpersist()
            kept, fresh = _kept(blocks, trees, columns, m, base).persist(StorageLevel.MEMORY_AND_DISK), [[] for _ in range(m)]
    scored = None
    kept.unpersist()
    if keep_rows:
        scored = _scored(blocks, trees, columns, m, base, schema).persist(StorageLevel.MEMORY_AND_DISK)
        scored.count()
    blocks.unpersist()
    for j, b in enumerate(boosters):
        if b.patience and losses[j]:
            trees[j] = trees[j][:patience_end(losses[j], b.patience)[0]]
    return Boosted(trees, float(base), losses, columns, objective, scored)


def _leaf(g: float, h: float, b: Booster) -> float:
    return float(-g / (h + b.l2) * b.eta) if h + b.l2 > 0 else 0.0


def _node_sums(columns: Columns, boosters: list[Booster], objective: str, splits: str, heavy: np.ndarray, fresh: list[list[Tree]],
               grown: dict[int, Tree], wanted: dict[int, list[int]], totals: dict[tuple[int, int], tuple[float, float]], with_loss: bool):
    """What a task tells of each wanted node: sums of the narrow columns by bin, and bins of
    the wide one. A bin that is in no other task need only be told if it may be the node's
    split: with one-hot splits, below the root (whose sums aren't known yet), that is one."""
    m, first, n_narrow, wide = len(boosters), columns.first, int(columns.narrow_first[-1]), columns.wide
    narrow_at = [c for c in range(len(columns.widths)) if c != wide]
    shift = (columns.narrow_first[:-1] - first[:-1])[narrow_at]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lost = np.zeros((m, 2))
        sums = {j: np.zeros((2, len(nodes), n_narrow)) for j, nodes in wanted.items()}
        whole = {j: np.zeros((2, len(nodes))) for j, nodes in wanted.items()}
        cats: list[np.ndarray] = []
        told: dict[int, list[np.ndarray]] = {j: [] for j in wanted}
        for frame in batches:
            for x in _Block.each(frame, columns, m, fresh):
                g, h, loss = _gradients(objective, x.margin, x.y)
                if with_loss and x.held.any():
                    lost[:, 0] += loss[x.held].sum(axis=0)
                    lost[:, 1] += x.held.sum()
                near = x.bins[:, narrow_at] + shift
                if wide is not None:
                    seen, at_seen = np.unique(x.bins[:, wide] - first[wide], return_inverse=True)
                    cats.append(seen)
                for j, nodes in wanted.items():
                    place = np.full(len(grown[j].column), -1)
                    place[nodes] = np.arange(len(nodes))
                    slot = np.where(x.inside[:, j] > 0, place[grown[j].leaf_of(x.bins, first)], -1)
                    at = np.flatnonzero(slot >= 0)
                    key = (near[at] + (slot[at] * n_narrow)[:, None]).ravel()
                    own = np.zeros((2, len(nodes), len(cats[-1]))) if wide is not None else None
                    for i, v in enumerate((g, h)):
                        w = v[at, j] * x.inside[at, j]
                        whole[j][i] += np.bincount(slot[at], weights=w, minlength=len(nodes))
                        if n_narrow:
                            sums[j][i] += np.bincount(key, weights=np.repeat(w, near.shape[1]), minlength=len(nodes) * n_narrow).reshape(len(nodes), -1)
                        if own is not None:
                            own[i] = np.bincount(slot[at] * len(cats[-1]) + at_seen[at], weights=w, minlength=own[i].size).reshape(len(nodes), -1)
                    if own is not None:
                        told[j].append(own)
        every = np.unique(np.concatenate(cats)) if cats else np.zeros(0, dtype=np.int64)
        is_heavy = np.isin(every, heavy)
        for j, nodes in wanted.items():
            own = np.zeros((2, len(nodes), len(every)))
            for seen, part in zip(cats, told[j]):
                own[:, :, np.searchsorted(every, seen)] += part
            for k, node in enumerate(nodes):
                if not whole[j][1, k]:
                    continue
                g, h = own[0, k], own[1, k]
                tell = np.flatnonzero(h)
                if splits == "onehot" and (j, node) in totals:
                    alone = tell[~is_heavy[tell]]
                    chosen = _chosen(columns, boosters[j], node)
                    best = _best_cut(every[alone], g[alone], h[alone], *totals[j, node], boosters[j], "onehot", None if chosen is None else chosen[wide]) \
                        if len(alone) else None
                    tell = tell[is_heavy[tell] | (every[tell] == best[1][1])] if best else tell[is_heavy[tell]]
                yield pd.DataFrame({"model": [j], "node": [node], "tg": [whole[j][0, k]], "th": [whole[j][1, k]], "narrow": [sums[j][:, k].tobytes()],
                                    "cats": [every[tell].astype(np.int64).tobytes()], "cg": [g[tell].tobytes()], "ch": [h[tell].tobytes()]})
        if with_loss:
            for j in range(m):
                yield pd.DataFrame({"model": [j], "node": [-1], "tg": [lost[j, 0]], "th": [lost[j, 1]], "narrow": [b""], "cats": [b""], "cg": [b""], "ch": [b""]})

    return run


def _node_split(columns: Columns, boosters: list[Booster], splits: str):
    """The sums of a node from all tasks, and its best split."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        j, node = int(frame["model"].iloc[0]), int(frame["node"].iloc[0])
        g, h, best = frame["tg"].sum(), frame["th"].sum(), None
        if node >= 0:
            narrow = sum(np.frombuffer(v) for v in frame["narrow"]).reshape(2, -1)
            cats, cg, ch = (np.concatenate([np.frombuffer(v, dtype=t) for v in frame[c]]) for c, t in (("cats", np.int64), ("cg", float), ("ch", float)))
            every, at = np.unique(cats, return_inverse=True)
            wide = every, np.bincount(at, weights=cg, minlength=len(every)), np.bincount(at, weights=ch, minlength=len(every))
            best = best_split((narrow[0], narrow[1]), wide, (g, h), columns, boosters[j], splits, node)
        gain, column, (kind, what), gl, hl = best or (0.0, -1, (-1, 0), 0.0, 0.0)
        return pd.DataFrame({"model": [j], "node": [node], "g": [g], "h": [h], "gain": [gain], "column": [column], "kind": [kind],
                             "k": [what if kind in (UP_TO, ALL_BUT) else 0], "bits": [what if kind == IN_SET else b""], "gl": [gl], "hl": [hl]})

    return run


def _kept(blocks: DataFrame, trees: list[list[Tree]], columns: Columns, m: int, base: float) -> DataFrame:
    """The blocks with their margins."""
    trees = [list(own) for own in trees]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield frame.assign(margin=[x.margin.tobytes() for x in _Block.each(frame, columns, m, trees, base)])

    return blocks.drop("own").mapInPandas(run, KEPT_ROWS)


def _scored(blocks: DataFrame, trees: list[list[Tree]], columns: Columns, m: int, base: float, schema: StructType) -> DataFrame:
    """The rows that were given, with ``margin``."""
    trees = [list(own) for own in trees]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for own, x in zip(frame["own"], _Block.each(frame, columns, m, trees, base)):
                yield pickle.loads(own).assign(margin=list(x.margin))

    return blocks.mapInPandas(run, StructType([*schema.fields, StructField("margin", ArrayType(DoubleType()))]))


# ---- scoring -------------------------------------------------------------------

def _written(t: Tree) -> list:
    return [t.column, [None if x is None else [x[0], base64.b64encode(x[1]).decode() if x[0] == IN_SET else x[1]] for x in t.left], t.kids, t.value]


def _read(w: list) -> Tree:
    left = [None if x is None else (x[0], base64.b64decode(x[1]) if x[0] == IN_SET else x[1]) for x in w[1]]
    return Tree(w[0], left, w[2], w[3])


class BoostedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Scores ``featuresCol`` (a vector of numeric columns and category codes): ``p1`` and
    ``prediction`` of a logistic model, ``prediction`` of a regression."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector of numeric columns and codes", typeConverter=TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "json: edges, sizes, base, objective, trees", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", trees="{}"):
        super().__init__()
        self._setDefault(featuresCol="features")
        self._set(**self._input_kwargs)

    @staticmethod
    def of(b: Boosted, index: int, features: str = "features") -> BoostedTreesModel:
        return BoostedTreesModel(featuresCol=features, trees=json.dumps({
            "edges": [e.tolist() for e in b.columns.edges], "sizes": list(b.columns.sizes), "base": b.base, "objective": b.objective,
            "trees": [_written(t) for t in b.trees[index]]}))

    def _transform(self, df: DataFrame) -> DataFrame:
        show_package(df.sparkSession)
        p = json.loads(self.getOrDefault("trees"))
        columns = Columns([np.array(e) for e in p["edges"]], p["sizes"])
        trees, base, logistic = [_read(w) for w in p["trees"]], p["base"], p["objective"] == "logistic"
        classes = p["objective"] != "squared"

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            bins, out = columns.bins(np.stack(x.tolist())), np.full(len(x), base)
            for t in trees:
                out += t.margin(bins, columns.first)
            return pd.Series(1 / (1 + np.exp(-np.clip(out, -500, 500))) if logistic else out)

        scored = df.withColumn("p1" if classes else "prediction", score(vector_to_array(F.col(self.getOrDefault("featuresCol")))))
        return scored.withColumn("prediction", (F.col("p1") > 0.5).cast("double")) if classes else scored
