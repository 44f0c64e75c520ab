"""Leaf-wise boosted trees over gradient histograms (L1), their gains (L4), category splits
(P13) and many fits in one scan (L8).

Rows are binned once and kept as checkpointed blocks (columns of bins, labels, folds,
margins of every model). One pass over the blocks serves all models of a fit - folds of
one trial, or all trials and folds of a search: each task adds up gradient histograms
keyed by (model, leaf, feature, bin) for all its blocks, one shuffle sums them, and the
driver, which holds histograms of leaves x features x bins numbers a model whatever the
table's size, picks the splits. Of two new leaves only the one with fewer rows is
counted; its sibling is the parent less that.

Features of few bins share a code (``Groups``): a pass looks up and counts a few codes a row
instead of every feature, and each task parts its sums by code into those of the features'
bins at its end. A block's rows find their leaves in up to eight trees at once (``Walk``):
every code gives a word of leaves that it leaves open, and the words are anded. Where no model
samples rows, rows of equal bins, label and fold take part alike in everything, so they
are summed up by key into one row with their number (``to_cells``): there are never more than
rows, and never more than the bins allow.

Trees grow best leaf first. A pass counts the children of every split that the
queue has chosen so far, and the queue is then played again with what became known,
until no chosen split but the last lacks children: the same tree as one split at a time, in
at most as many passes as it has levels. Categories are sorted by their gradient ratio, so that a
split sends any set of them to the left. Nulls have a bin of their own and go to the
better side.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventcraft.session import ensure_checkpoint_dir

#: rows of a block; bins of the validation scores that its AUC is read from
BLOCK_ROWS, SCORE_BINS = 1 << 14, 1 << 12
#: codes of a group of features; bytes of a task's sums by code (features of their own where more)
GROUP_CODES, GROUP_BYTES = 1 << 10, 64 << 20
#: rounds after which trees are added to the stored margins
FOLD_EVERY = 10


@dataclass(frozen=True)
class Params:
    """One fit's settings; ``patience`` counts rounds without a better validation AUC."""

    rounds: int = 3000
    patience: int = 200
    learning_rate: float = 0.05
    leaves: int = 31
    min_rows: int = 20
    l2: float = 1.0
    min_gain: float = 1e-6
    row_share: float = 1.0
    feature_share: float = 1.0
    seed: int = 42


@dataclass
class Bins:
    """How each feature's values become bins: 0 is null, category bin -1 (the last) all the others."""

    numbers: list[str]
    categories: list[str]
    cuts: list[list[float]]
    values: list[list[str]]
    size: int

    @property
    def names(self) -> list[str]:
        return [*self.numbers, *self.categories]

    def encode(self, columns: list[pa.Array]) -> np.ndarray:
        """(features, rows) of bins from Arrow columns in the order of ``names``."""
        out = np.zeros((len(columns), len(columns[0])), dtype=np.uint8)
        for k, col in enumerate(columns):
            if k < len(self.numbers):
                v = col.cast(pa.float64()).to_numpy(zero_copy_only=False)
                bins = np.searchsorted(self.cuts[k], v, side="left") + 1
                out[k] = np.where(np.isnan(v), 0, bins)
            else:
                known = pa.array(self.values[k - len(self.numbers)], pa.string())
                at = pc.fill_null(pc.index_in(col, value_set=known), self.size - 2).to_numpy()
                out[k] = np.where(col.is_null().to_numpy(zero_copy_only=False), 0, at + 1)
        return out


def fit_bins(df: DataFrame, numbers: list[str], categories: list[str] = (), size: int = 64) -> Bins:
    """Quantile cuts of numbers (one sketch over all) and the commonest values of categories.

    At most ``size`` bins a feature come to the driver; categories beyond them share one.
    """
    if not 4 <= size <= 256:
        raise ValueError("bins must be between 4 and 256")
    probs = [(k + 1) / (size - 1) for k in range(size - 2)]
    own = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in numbers])
    cuts = own.approxQuantile(list(numbers), probs, 0.25 / size) if numbers else []
    values: list[list[str]] = [[] for _ in categories]
    if categories:
        pairs = df.select(F.explode(F.array(*[
            F.struct(F.lit(k).alias("k"), F.col(c).cast("string").alias("v"))
            for k, c in enumerate(categories)])).alias("e")).select("e.*").where("v is not null")
        first = Window.partitionBy("k").orderBy(F.col("n").desc(), "v")
        top = pairs.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).withColumn(
            "r", F.row_number().over(first)).where(F.col("r") <= size - 2)
        for r in sorted(top.collect()):
            values[r["k"]].append(r["v"])
    return Bins(list(numbers), list(categories), [sorted(set(c)) for c in cuts], values, size)


@dataclass
class Tree:
    """Nodes as columns: a split's feature (-1: leaf), which bins go left, children, value, gain, rows."""

    feature: list[int] = field(default_factory=list)
    left_bins: list[list[int]] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    cover: list[int] = field(default_factory=list)

    def add(self, value: float = 0.0, cover: int = 0) -> int:
        for column, v in zip((self.feature, self.left_bins, self.left, self.right, self.value,
                              self.gain, self.cover), (-1, [], -1, -1, value, 0.0, cover), strict=True):
            column.append(v)
        return len(self.feature) - 1

    def leaf_of(self, x: np.ndarray, bins: int) -> np.ndarray:
        """The leaf of each row of binned features (features, rows)."""
        feature, left, right = (np.array(v) for v in (self.feature, self.left, self.right))
        goes = np.zeros((len(feature), bins), dtype=bool)
        for k, v in enumerate(self.left_bins):
            goes[k, v] = True
        at, rows = np.zeros(x.shape[1], dtype=np.int64), np.arange(x.shape[1])
        while len(rows := rows[feature[at[rows]] >= 0]):
            node = at[rows]
            at[rows] = np.where(goes[node, x[feature[node], rows]], left[node], right[node])
        return at

    def leaves(self) -> tuple[list[int], dict[int, int]]:
        """The leaves from left to right, and for each node its leaves as bits in that order."""
        order, bits = [], {}
        todo = [(0, False)]
        while todo:
            node, done = todo.pop()
            if self.feature[node] < 0:
                bits[node] = 1 << len(order)
                order.append(node)
            elif done:
                bits[node] = bits[self.left[node]] | bits[self.right[node]]
            else:
                todo += [(node, True), (self.right[node], False), (self.left[node], False)]
        return order, bits


class Groups:
    """Features whose bins share a code: a row has one code a group.

    A group has a code for every combination of its features' bins that occur, at most
    ``limit`` of them, or a single feature.
    """

    def __init__(self, used: list[np.ndarray], limit: int = GROUP_CODES):
        self.used, self.members, self.sizes = used, [], []
        for f in sorted(range(len(used)), key=lambda f: -len(used[f])):
            n = max(1, len(used[f]))
            for k, size in enumerate(self.sizes):
                if size * n <= limit:
                    self.members[k].append(f)
                    self.sizes[k] *= n
                    break
            else:
                self.members.append([f])
                self.sizes.append(n)
        self.shapes = [[max(1, len(used[f])) for f in m] for m in self.members]

    def pack(self, x: np.ndarray) -> np.ndarray:
        """(groups, rows) of codes from bins (features, rows)."""
        out = np.zeros((len(self.members), x.shape[1]), dtype=np.uint16)
        for k, (members, shape) in enumerate(zip(self.members, self.shapes, strict=True)):
            for f, n in zip(members, shape, strict=True):
                place = np.zeros(256, dtype=np.uint16)
                place[self.used[f]] = np.arange(len(self.used[f]))
                out[k] = out[k] * np.uint16(n) + place[x[f]]
        return out

    def bins(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Each feature's group, its number and its bin in every code of the group."""
        for k, (members, shape) in enumerate(zip(self.members, self.shapes, strict=True)):
            for f, at in zip(members, np.unravel_index(np.arange(self.sizes[k]), shape), strict=True):
                yield k, f, self.used[f][at] if len(self.used[f]) else at

    def unpack(self, codes: np.ndarray) -> np.ndarray:
        """The inverse of ``pack``."""
        out = np.zeros((len(self.used), codes.shape[1]), dtype=np.uint8)
        for k, f, bins in self.bins():
            out[f] = bins[codes[k]]
        return out

    def part(self, sums: list[np.ndarray], size: int) -> np.ndarray:
        """(nodes, features, bins, values) from each group's sums by code (values, nodes, codes)."""
        values, nodes = sums[0].shape[:2]
        out = np.zeros((nodes, len(self.used), size, values))
        for own, members, shape in zip(sums, self.members, self.shapes, strict=True):
            own = own.reshape(values, nodes, *shape)
            for k, f in enumerate(members):
                rest = tuple(2 + j for j in range(len(shape)) if j != k)
                one = own.sum(axis=rest).transpose(1, 2, 0)
                out[:, f, self.used[f]] = one[:, :len(self.used[f])]
        return out


class Walk:
    """The leaves of many trees at once.

    Each split closes, for every bin of its feature, the leaves on its other side; what all
    features leave open of a tree is one bit. Trees of at most 8 leaves share words of 64 bits,
    larger ones have a word, and those beyond 64 leaves are walked node by node. A tree's
    rows get codes, and ``node`` says which leaf a code stands for. With ``groups`` rows are
    given by the codes of these.
    """

    def __init__(self, trees: list[Tree], features: int, size: int, groups: Groups | None = None):
        self.trees, self.size, self.groups = trees, size, groups
        self.words: list[np.ndarray] = []
        self.whole: list[int] = []  # the bits of all leaves in each word
        self.node: list[np.ndarray] = []
        self.at: list[tuple[int, int]] = []  # word and byte; byte -1: the whole word, word -1: none
        shared, free = -1, 8
        for tree in trees:
            order, bits = tree.leaves()
            if len(order) > 64:
                self.at.append((-1, -1))
                self.node.append(np.arange(len(tree.feature)))
                continue
            small = len(order) <= 8
            if not small or free == 8:
                self.words.append(np.full((features, size), (1 << 64) - 1, dtype=np.uint64))
                self.whole.append(0)
                if small:
                    shared, free = len(self.words) - 1, 0
            word, shift = (shared, 8 * free) if small else (len(self.words) - 1, 0)
            self.at.append((word, free if small else -1))
            self.whole[word] |= bits[0] << shift
            free += small
            for node, f in enumerate(tree.feature):
                if f >= 0 and node in bits:
                    goes = np.zeros(size, dtype=bool)
                    goes[tree.left_bins[node]] = True
                    closed = [np.uint64(((1 << 64) - 1) ^ (bits[side] << shift))
                              for side in (tree.right[node], tree.left[node])]
                    self.words[word][f] &= np.where(goes, *closed)
            if small:
                node_of = np.zeros(256, dtype=np.int64)
                node_of[[1 << k for k in range(len(order))]] = order
                self.node.append(node_of)
            else:
                self.node.append(np.array(order))
        full = np.uint64((1 << 64) - 1)
        if groups is not None:
            by_code = [[np.full(n, full) for n in groups.sizes] for _ in self.words]
            for k, f, bins in groups.bins():
                for own, word in zip(by_code, self.words, strict=True):
                    own[k] &= word[f][bins]
            self.words = by_code
            self.used = [[k for k, t in enumerate(w) if (t != full).any()] for w in self.words]
            return
        self.used = [np.flatnonzero((w != full).any(axis=1)).tolist() for w in self.words]

    def codes(self, x: np.ndarray) -> list[np.ndarray]:
        """For each tree the code of every row's leaf, from bins (features, rows) or groups' codes."""
        found, bins = [], x
        for table, used, whole in zip(self.words, self.used, self.whole, strict=True):
            open_ = np.full(x.shape[1], whole, dtype=np.uint64)
            for f in used:
                open_ &= np.take(table[f], x[f], mode="clip")
            found.append(open_)
        parts = [w.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8) for w in found]
        if self.groups is not None and any(word < 0 for word, _ in self.at):
            bins = self.groups.unpack(x)
        return [t.leaf_of(bins, self.size) if word < 0 else parts[word][:, byte] if byte >= 0
                else np.frexp(found[word].astype(np.float64))[1] - 1
                for t, (word, byte) in zip(self.trees, self.at, strict=True)]

    def values(self) -> list[np.ndarray]:
        """For each tree the value of every code."""
        return [np.array(t.value)[n] for t, n in zip(self.trees, self.node, strict=True)]

    def sums(self, x: np.ndarray, groups: list[list[int]]) -> list[np.ndarray]:
        """For each group of trees the sum of their values over the rows."""
        codes, values = self.codes(x), self.values()
        out = []
        for group in groups:
            total = np.zeros(x.shape[1])
            for k in group:
                total += np.take(values[k], codes[k], mode="clip")
            out.append(total)
        return out


@dataclass
class Model:
    """A fitted (or growing) model; ``fold`` is the fold that it validates on and does not learn from."""

    params: Params
    fold: int = -1
    trial: int = 0
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    auc: list[float] = field(default_factory=list)
    ended: str = ""

    @property
    def best_round(self) -> int:
        """Trees that scoring uses: up to the best validation AUC (all where there is none)."""
        return int(np.argmax(self.auc)) + 1 if self.auc else len(self.trees)

    def margin(self, x: np.ndarray, bins: int) -> np.ndarray:
        trees = self.trees[:self.best_round]
        return self.base + Walk(trees, len(x), bins).sums(x, [list(range(len(trees)))])[0]


# --- splits on the driver ---------------------------------------------------------------------

def best_split(hist: np.ndarray, p: Params, numbers: int) -> tuple[float, int, list[int], int] | None:
    """Gain, feature, bins that go left and rows there, of a leaf's (features, bins, [g, h, n])."""
    total = hist[0].sum(axis=0)
    order = np.tile(np.arange(hist.shape[1]), (len(hist), 1))
    if numbers < len(hist):
        ratio = hist[numbers:, :, 0] / np.maximum(hist[numbers:, :, 1] + p.l2, 1e-300)
        order[numbers:] = np.argsort(np.where(hist[numbers:, :, 2] > 0, ratio, np.inf), axis=1,
                                     kind="stable")
    best = None
    moved = np.roll(order, -1, axis=1)  # null last: it goes right
    moved[numbers:] = order[numbers:]
    for o in (order, moved):
        left = np.cumsum(np.take_along_axis(hist, o[:, :, None], axis=1), axis=1)[:, :-1]
        right = total - left
        gain = sum(side[..., 0] ** 2 / np.maximum(side[..., 1] + p.l2, 1e-300)
                   for side in (left, right)) - total[0] ** 2 / max(total[1] + p.l2, 1e-300)
        gain[(left[..., 2] < max(1, p.min_rows)) | (right[..., 2] < max(1, p.min_rows))] = -np.inf
        f, k = divmod(int(np.argmax(gain)), gain.shape[1])
        if gain[f, k] > p.min_gain and (best is None or gain[f, k] > best[0] + 1e-12):
            best = float(gain[f, k]), f, sorted(o[f, :k + 1].tolist()), int(left[f, k, 2])
    return best


class Growth:
    """One tree while it grows: every node counted so far, and the queue played over them."""

    def __init__(self, p: Params, numbers: int):
        self.p, self.numbers = p, numbers
        self.tree = Tree()
        self.hist: dict[int, np.ndarray] = {}
        self.split: dict[int, tuple | None] = {}
        self.tree.add()
        self.want = [0]
        self.sibling: dict[int, tuple[int, int]] = {}  # of nodes not counted yet

    def _set(self, node: int, sums: np.ndarray) -> None:
        g, h, n = sums.tolist()
        self.tree.value[node] = -self.p.learning_rate * g / (h + self.p.l2)
        self.tree.cover[node] = round(n)

    def learn(self, node: int, hist: np.ndarray) -> None:
        """Take a counted node, and its sibling from the parent."""
        found = {node: hist}
        if node in self.sibling:
            other, parent = self.sibling.pop(node)
            found[other] = self.hist.pop(parent) - hist
        for k, v in found.items():
            self.hist[k] = v
            self.split[k] = best_split(v, self.p, self.numbers)
            self._set(k, v[0].sum(axis=0))

    def play(self) -> list[int]:
        """Split best leaves first; the nodes (one of each pair) whose counts that still needs.

        Whatever the children of the split that fills the tree hold, they stay leaves: the
        parent's sums give their values.
        """
        chosen, leaves, heap = [], 1, []

        def push(node: int) -> None:
            if (s := self.split.get(node)) is not None:
                heapq.heappush(heap, (-s[0], node))
        push(0)
        want = []
        while heap and leaves < self.p.leaves:
            _, node = heapq.heappop(heap)
            leaves += 1
            chosen.append(node)
            if self.tree.left[node] < 0:
                gain, feature, bins, rows = self.split[node]
                self.tree.feature[node], self.tree.left_bins[node] = feature, bins
                self.tree.gain[node] = gain
                pair = self.tree.add(), self.tree.add()
                self.tree.left[node], self.tree.right[node] = pair
                small = int(2 * rows > self.tree.cover[node])
                self.sibling[pair[small]] = pair[1 - small], node
                left = self.hist[node][feature, bins].sum(axis=0)
                self._set(pair[0], left)
                self._set(pair[1], self.hist[node][0].sum(axis=0) - left)
            new = [k for k in (self.tree.left[node], self.tree.right[node]) if k in self.sibling]
            if not new:
                push(self.tree.left[node])
                push(self.tree.right[node])
            elif leaves < self.p.leaves:
                want += new
        self.chosen = set(chosen)
        self.want = want
        return want

    def finish(self) -> Tree:
        """The tree of the chosen splits alone."""
        out = Tree()

        def copy(node: int) -> int:
            k = out.add(self.tree.value[node], self.tree.cover[node])
            if node in self.chosen:
                out.feature[k], out.left_bins[k] = self.tree.feature[node], self.tree.left_bins[node]
                out.gain[k] = self.tree.gain[node]
                out.left[k] = copy(self.tree.left[node])
                out.right[k] = copy(self.tree.right[node])
            return k
        copy(0)
        return out


# --- passes over the blocks ---------------------------------------------------------------------

BLOCKS = "n int, ids binary, y binary, fold binary, x binary, w binary, margin binary"
NAMES = [c.split()[0] for c in BLOCKS.split(", ")]


def _block_row(data: list[bytes], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([n], pa.int32()), *[pa.array([v], pa.binary()) for v in data]], names=NAMES)


def _packed(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The rows of all batches in tables of ``rows`` rows, the last one of the rest."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            t = pa.Table.from_batches(held)
            while t.num_rows >= rows:
                yield t.slice(0, rows)
                t = t.slice(rows)
            held, n = t.to_batches(), t.num_rows
    if n:
        yield pa.Table.from_batches(held)


def to_blocks(df: DataFrame, bins: Bins, label: str, id_col: str, fold_col: str | None = None,
              rows: int = BLOCK_ROWS) -> DataFrame:
    """Binned rows in blocks; rows without a label are left out; a null fold is -1."""
    d = df.where(F.col(label).isNotNull()).select(
        F.col(id_col).cast("bigint"), F.col(label).cast("double"),
        (F.coalesce(F.col(fold_col).cast("int"), F.lit(-1)) if fold_col else F.lit(-1)).alias("fold"),
        *[F.col(c).cast("double") for c in bins.numbers],
        *[F.col(c).cast("string") for c in bins.categories])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _packed(batches, rows):
            c = [x.combine_chunks() for x in t.columns]
            yield _block_row([c[0].fill_null(0).to_numpy().tobytes(), c[1].to_numpy().tobytes(),
                              c[2].to_numpy().astype(np.int32).tobytes(),
                              bins.encode(c[3:]).tobytes(), b"", b""], t.num_rows)

    return d.mapInArrow(run, BLOCKS)


def to_cells(blocks: DataFrame, features: int, rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of distinct (bins, fold, label) with their number of rows; without ids."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                _, y, fold, x, _, _ = _block(b.slice(i, 1).to_pylist()[0], features, 0, [])
                kind = np.zeros(len(y), dtype=[("x", np.uint8, (features,)), ("fold", "<i4"), ("y", "<f8")])
                kind["x"], kind["fold"], kind["y"] = x.T, fold, y
                cell, count = np.unique(kind.view(f"V{kind.itemsize}"), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.tolist(), pa.binary()), pa.array(count)], names=["cell", "w"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _packed(batches, rows):
            kind = np.frombuffer(b"".join(t.column(0).to_pylist()),
                                 [("x", np.uint8, (features,)), ("fold", "<i4"), ("y", "<f8")])
            yield _block_row([b"", kind["y"].tobytes(), kind["fold"].tobytes(),
                              kind["x"].T.tobytes(),
                              t.column(1).to_numpy().astype(np.float64).tobytes(), b""], t.num_rows)

    cells = blocks.mapInArrow(split, "cell binary, w bigint").groupBy("cell").agg(F.sum("w").alias("w"))
    return cells.sortWithinPartitions("cell").mapInArrow(pack, BLOCKS)


def _share(ids: np.ndarray, p: Params, step: int) -> np.ndarray:
    """Whether each row takes part in a round: the same rows whichever task holds them."""
    with np.errstate(over="ignore"):
        h = (ids.astype(np.uint64) + np.uint64(step * 0x9E3779B9 + p.seed)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(40)).astype(np.float64) < p.row_share * (1 << 24)


def _block(r: dict, features: int, models: int, bases: list[float], kind: type = np.uint8) -> tuple:
    """ids (none in cells), labels, folds, bins (or codes), numbers of rows (cells only) and margins."""
    ids, y = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["y"])
    fold = np.frombuffer(r["fold"], np.int32)
    x = np.frombuffer(r["x"], kind).reshape(features, r["n"])
    w = np.frombuffer(r["w"]) if r["w"] else None
    margin = (np.frombuffer(r["margin"]).reshape(models, r["n"]) if r["margin"]
              else np.repeat(np.array(bases).reshape(-1, 1), r["n"], axis=1))
    return ids, y, fold, x, w, margin


class Fit:
    """All models of one call, grown together."""

    def __init__(self, blocks: DataFrame, bins: Bins, models: list[Model], rows: DataFrame | None = None):
        self.blocks, self.bins, self.models = blocks, bins, models
        self.rows = blocks if rows is None else rows  # with ids, for out-of-fold scores
        self.recent: list[list[Tree]] = [[] for _ in models]  # not in the stored margins yet
        self.scans = 0
        self.groups: Groups | None = None
        self.packed: DataFrame | None = None  # blocks of codes, with the stored margins

    def _pack(self) -> None:
        """Store the blocks with codes of groups in place of bins, by the bins that occur."""
        names = len(self.bins.names)

        def occur(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = np.zeros((names, 256), dtype=bool)
            for b in batches:
                for i in range(b.num_rows):
                    x = _block(b.slice(i, 1).to_pylist()[0], names, 0, [])[3]
                    for f in range(names):
                        seen[f] |= np.bincount(x[f], minlength=256) > 0
            f, v = np.nonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array(v, pa.int32())],
                                             names=["feature", "bin"])
        used: list[list[int]] = [[] for _ in range(names)]
        for r in self.blocks.mapInArrow(occur, "feature int, bin int").distinct().collect():
            used[r["feature"]].append(r["bin"])
        # a task holds three sums a code for up to half the leaves of each model
        nodes = sum(max(1, m.params.leaves // 2) for m in self.models)
        groups = Groups([np.array(sorted(v), dtype=np.int64) for v in used], min(
            GROUP_CODES, GROUP_BYTES // (24 * max(1, names) * max(1, nodes))))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    r = b.slice(i, 1).to_pylist()[0]
                    r["x"] = groups.pack(_block(r, names, 0, [])[3]).tobytes()
                    yield _block_row([r[c] for c in NAMES[1:]], r["n"])
        self.groups, self.packed = groups, self.blocks.mapInArrow(run, BLOCKS).checkpoint(eager=True)

    def _sums(self, task, schema: str, keys: int) -> list:
        """Run ``task`` over all blocks and add up its float rows by (model, node), ``keys`` of them."""
        self.scans += 1
        parts = min(max(1, keys // 4), int(self.packed.sparkSession.conf.get(
            "spark.sql.shuffle.partitions")))

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, total = None, None

            def out():
                return pa.RecordBatch.from_arrays(
                    [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                     pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                    names=["model", "node", "part", "data"])
            for b in batches:
                for m, n, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                   b.column(3).to_pylist(), strict=True):
                    if (m, n) == key:
                        total += np.frombuffer(d)
                        continue
                    if key is not None:
                        yield out()
                    key, total = (m, n), np.frombuffer(d).copy()
            if key is not None:
                yield out()

        # a fixed order of the parts: float sums come out the same on a rerun
        return self.packed.mapInArrow(task, schema).repartition(
            parts, "model", "node").sortWithinPartitions("model", "node", "part").mapInArrow(
            add, schema).collect()

    def count(self, growing: dict[int, Growth], step: int) -> tuple[dict, dict]:
        """Histograms of all wanted nodes, and in a round's first pass the validation scores."""
        names, size, models = len(self.bins.names), self.bins.size, self.models
        recent, bases, groups = self.recent, [m.base for m in models], self.groups
        trees = {m: g.tree for m, g in growing.items()}
        want = {m: list(g.want) for m, g in growing.items()}
        settings = {m: (models[m].params, models[m].fold) for m in growing}
        first = all(w == [0] for w in want.values())
        schema = "model int, node int, part int, data binary"

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            part = TaskContext.get().partitionId()
            # by group: (g, h, n; in a first pass n is that of all models with the same rows)
            hist = {m: [np.zeros((2 if first else 3, len(w), n)) for n in groups.sizes]
                    for m, w in want.items()}
            number = {}
            scores = {m: np.zeros((2, SCORE_BINS)) for m in want}
            order, sets, own_tree = [], [], {}
            for m in want:
                sets.append(list(range(len(order), len(order) + len(recent[m]))))
                order += recent[m]
                if not first:
                    own_tree[m] = len(order)
                    order.append(trees[m])
            walk = Walk(order, names, size, groups)
            values, slots = walk.values(), {}
            for m, k in own_tree.items():
                slot = np.full(len(trees[m].feature), -1)
                slot[want[m]] = np.arange(len(want[m]))
                slots[m] = slot[walk.node[k]]

            def key_of(m: int) -> tuple:
                p, own = settings[m]
                return own, p.row_share, p.seed

            for b in batches:
                for i in range(b.num_rows):
                    ids, y, fold, x, w, margin = _block(
                        b.slice(i, 1).to_pylist()[0], len(groups.sizes), len(recent), bases, np.uint16)
                    codes, drawn, kept, valids = walk.codes(x), {}, {}, {}
                    for m in want:  # the rows that take part, once for all models with the same
                        p, own = settings[m]
                        if own not in valids:
                            valids[own] = (fold == own) & (own >= 0)
                        if (draw := (p.row_share, p.seed)) not in drawn:
                            drawn[draw] = _share(ids, p, step) if p.row_share < 1 else True
                        if (key := key_of(m)) not in kept:
                            rows = np.flatnonzero(~valids[own] & drawn[draw])
                            kept[key] = rows, None
                            if first:
                                mine = [np.take(c, rows).astype(np.intp) for c in x]
                                kept[key] = rows, mine
                                total = number.setdefault(key, [np.zeros(n) for n in groups.sizes])
                                for t, code, n in zip(total, mine, groups.sizes, strict=True):
                                    t += np.bincount(code, None if w is None else w[rows], n)
                    for m, group in zip(want, sets, strict=True):
                        rows, mine = kept[key_of(m)]
                        if first:
                            z = margin[m]
                            if group:
                                z = z + sum(np.take(values[k], codes[k], mode="clip") for k in group)
                            prob = 1 / (1 + np.exp(-z))
                            valid = valids[settings[m][1]]
                            at = np.minimum((prob[valid] * SCORE_BINS).astype(int), SCORE_BINS - 1)
                            for k in (0, 1):
                                is_k = y[valid] == k
                                scores[m][k] += np.bincount(
                                    at[is_k], None if w is None else w[valid][is_k], SCORE_BINS)
                            prob = prob[rows]
                        else:
                            place = np.take(slots[m], codes[own_tree[m]][rows], mode="clip")
                            at = np.flatnonzero(place >= 0)
                            rows, place = rows[at], place[at]
                            z = margin[m][rows]
                            if group:
                                z = z + sum(np.take(values[k], codes[k][rows], mode="clip")
                                            for k in group)
                            prob = 1 / (1 + np.exp(-z))
                        if not len(rows):
                            continue
                        g, h, n = prob - y[rows], prob * (1 - prob), None if w is None else w[rows]
                        if w is not None:
                            g, h = g * n, h * n
                        for k, total in enumerate(hist[m]):
                            code = mine[k] if first else place * groups.sizes[k] + np.take(x[k], rows)
                            for t, v in zip(total, (g, h) if first else (g, h, n), strict=True):
                                t += np.bincount(code, v, t.size).reshape(t.shape)
            out = []
            for m, nodes in want.items():
                own = hist[m]
                if first:
                    same = number.get(key_of(m)) or [np.zeros(n) for n in groups.sizes]
                    own = [np.concatenate([t, n[None, None]]) for t, n in zip(own, same, strict=True)]
                parted = groups.part(own, size)
                out += [(m, n, parted[k]) for k, n in enumerate(nodes)]
            out += [(m, -1, s) for m, s in scores.items() if first]
            for m, n, d in out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m], pa.int32()), pa.array([n], pa.int32()),
                     pa.array([part], pa.int32()), pa.array([d.tobytes()], pa.binary())],
                    names=["model", "node", "part", "data"])

        found, valid = {}, {}
        for r in self._sums(task, schema, sum(len(w) + first for w in want.values())):
            data = np.frombuffer(bytes(r["data"]))
            if r["node"] < 0:
                valid[r["model"]] = data.reshape(2, SCORE_BINS)
            else:
                found[r["model"], r["node"]] = data.reshape(names, size, 3)
        return found, valid

    def fold_margins(self) -> None:
        """Write the blocks again with the recent trees in their margins: lineage ends there."""
        names, size = len(self.bins.names), self.bins.size
        recent, bases, codes = self.recent, [m.base for m in self.models], self.groups

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ends = np.cumsum([0, *map(len, recent)]).tolist()
            groups = [list(range(s, e)) for s, e in zip(ends, ends[1:], strict=False)]
            walk = Walk([t for new in recent for t in new], names, size, codes)
            for b in batches:
                for i in range(b.num_rows):
                    row = b.slice(i, 1)
                    *_, x, _, margin = _block(row.to_pylist()[0], len(codes.sizes), len(recent),
                                              bases, np.uint16)
                    margin = margin + np.stack(walk.sums(x, groups))
                    yield pa.RecordBatch.from_arrays(
                        [*row.columns[:-1], pa.array([margin.tobytes()], pa.binary())], names=NAMES)
        self.packed = self.packed.mapInArrow(run, BLOCKS).checkpoint(eager=True)
        self.recent = [[] for _ in self.models]

    def _validated(self, m: int, scores: np.ndarray) -> None:
        """Note the AUC of the rounds so far; end the model where patience or the budget does."""
        model = self.models[m]
        neg, pos = scores
        pairs = pos.sum() * neg.sum()
        if model.trees and pairs:
            model.auc.append(float((pos * (np.cumsum(neg) - neg / 2)).sum() / pairs))
            if len(model.auc) - model.best_round >= model.params.patience:
                model.ended = "patience"
        if not model.ended and len(model.trees) >= model.params.rounds:
            model.ended = "budget"

    def run(self) -> list[Model]:
        step = 0
        if self.packed is None:
            self._pack()
        while open_ := [m for m, x in enumerate(self.models) if not x.ended]:
            growing = {m: Growth(self.models[m].params, len(self.bins.numbers)) for m in open_}
            while asked := {m: g for m, g in growing.items() if g.want}:
                found, valid = self.count(asked, step)
                for m, s in valid.items():
                    self._validated(m, s)
                for (m, node), h in found.items():
                    p = self.models[m].params
                    if p.feature_share < 1:
                        keep = np.random.default_rng([p.seed, step]).permutation(len(h))
                        drop = keep[max(1, round(p.feature_share * len(h))):]
                        drop = drop[drop > 0]  # the first feature's sums are the leaf's
                        h = h.copy()
                        h[drop] = 0
                    growing[m].learn(node, h)
                growing = {m: g for m, g in growing.items() if not self.models[m].ended}
                for g in growing.values():
                    g.play()
            for m, g in growing.items():
                tree = g.finish()
                self.models[m].trees.append(tree)
                self.recent[m].append(tree)
                if len(tree.feature) == 1:
                    self.models[m].ended = "no split"
            step += 1
            if step % FOLD_EVERY == 0:
                self.fold_margins()
        return self.models


def start(df: DataFrame, bins: Bins, label: str, id_col: str, settings: list[tuple[Params, int, int]],
          fold_col: str | None = None) -> Fit:
    """A fit of (params, validation fold or -1, trial) models over the labelled rows of ``df``."""
    ensure_checkpoint_dir(df.sparkSession)
    # blocks of one scan split would all lie in its partition: deal them over the cores once
    blocks = to_blocks(df, bins, label, id_col, fold_col)
    cores = df.sparkSession.sparkContext.defaultParallelism
    blocks = blocks.repartition(max(cores, blocks.rdd.getNumPartitions())).checkpoint(eager=True)
    rows = blocks
    if all(p.row_share >= 1 for p, _, _ in settings):
        cells = to_cells(blocks, len(bins.names))
        blocks = cells.repartition(max(cores, cells.rdd.getNumPartitions())).checkpoint(eager=True)
    sums = {}

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                y, fold = np.frombuffer(r["y"]), np.frombuffer(r["fold"], np.int32)
                for k in np.unique(fold).tolist():
                    yield pa.RecordBatch.from_pydict({"fold": [k], "y": [float(y[fold == k].sum())],
                                                      "n": [int((fold == k).sum())]})
    for r in rows.mapInArrow(totals, "fold bigint, y double, n bigint").groupBy("fold").agg(
            F.sum("y").alias("y"), F.sum("n").alias("n")).collect():  # a row for each fold
        sums[r["fold"]] = r["y"], r["n"]
    models = []
    for p, own, trial in settings:
        y, n = (sum(v[k] for f, v in sums.items() if own < 0 or f != own) for k in (0, 1))
        rate = min(max(y / n, 1e-6), 1 - 1e-6) if n else 0.5
        models.append(Model(p, own, trial, float(np.log(rate / (1 - rate))),
                            ended="" if n else "no rows"))
    return Fit(blocks, bins, models, rows)


def fit_folds(df: DataFrame, bins: Bins, label: str, k: int, id_col: str, fold_col: str = "fold",
              params: Params | None = None) -> Fit:
    """L1 + L2: one model a fold, each stopped on its own fold, all grown in the same scans."""
    f = start(df, bins, label, id_col, [(params or Params(), i, 0) for i in range(k)], fold_col)
    f.run()
    return f


def search(df: DataFrame, bins: Bins, label: str, k: int, id_col: str, trials: list[dict],
           fold_col: str = "fold", params: Params | None = None) -> tuple[DataFrame, Fit]:
    """Every trial (overrides of ``params``) on all folds; scans do not grow with the trials.

    Returns (trial, params, score: mean of the folds' best validation AUC, is_best) and the fit.
    """
    base = params or Params()
    f = start(df, bins, label, id_col, [(replace(base, **t), i, n) for n, t in enumerate(trials)
                                        for i in range(k)], fold_col)
    f.run()
    score = [float(np.mean([max(m.auc, default=0.5) for m in f.models if m.trial == n]))
             for n in range(len(trials))]
    best = int(np.argmax(score)) if score else -1
    return df.sparkSession.createDataFrame(
        [(n, json.dumps(t, sort_keys=True), s, n == best)
         for n, (t, s) in enumerate(zip(trials, score, strict=True))],
        "trial int, params string, score double, is_best boolean"), f


def out_of_fold(fit: Fit) -> DataFrame:
    """(row_id, label, fold, score): each row scored by the model that validated on its fold."""
    names, bins, models = len(fit.bins.names), fit.bins.size, fit.models

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, y, fold, x, *_ = _block(b.slice(i, 1).to_pylist()[0], names, len(models), [
                    m.base for m in models])
                for m in models:
                    at = np.flatnonzero(fold == m.fold)
                    score = 1 / (1 + np.exp(-m.margin(x[:, at], bins)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at]), pa.array(y[at].astype(np.int32)), pa.array(fold[at]),
                         pa.array(score)], names=["row_id", "label", "fold", "score"])
    return fit.rows.mapInArrow(run, "row_id bigint, label int, fold int, score double")


def score(df: DataFrame, bins: Bins, models: list[Model], id_col: str) -> DataFrame:
    """L3 + L9: (id, score), the mean of the models' probabilities; null features go where fits sent them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = bins.encode(b.columns[1:])
                s = np.mean([1 / (1 + np.exp(-m.margin(x, bins.size))) for m in models], axis=0)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], names=[id_col, "score"])
    d = df.select(F.col(id_col).cast("bigint").alias(id_col),
                  *[F.col(c).cast("double") for c in bins.numbers],
                  *[F.col(c).cast("string") for c in bins.categories])
    return d.mapInArrow(run, f"`{id_col}` bigint, score double")


def node_table(spark: SparkSession, fit: Fit) -> DataFrame:
    """L4: every node of the trees that scoring uses: model, tree, node, feature, gain, cover, value."""
    names = fit.bins.names
    rows = [(i, t, n, names[f] if f >= 0 else None, tree.gain[n], tree.cover[n], tree.value[n])
            for i, m in enumerate(fit.models) for t, tree in enumerate(m.trees[:m.best_round])
            for n, f in enumerate(tree.feature)]
    return spark.createDataFrame(rows, "model int, tree int, node int, feature string, gain double, "
                                       "cover bigint, value double")


def total_gain(nodes: DataFrame) -> DataFrame:
    """L4: (model, feature, gain, splits) summed over a model's splits."""
    return nodes.where("feature is not null").groupBy("model", "feature").agg(
        F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("splits"))


def to_json(bins: Bins, models: list[Model]) -> str:
    """Everything that scoring needs, as text."""
    return json.dumps({"bins": asdict(bins), "models": [asdict(m) for m in models]})


def from_json(text: str) -> tuple[Bins, list[Model]]:
    """The inverse of ``to_json``."""
    d = json.loads(text)
    return Bins(**d["bins"]), [Model(**{**m, "params": Params(**m["params"]),
                                        "trees": [Tree(**t) for t in m["trees"]]})
                               for m in d["models"]]
