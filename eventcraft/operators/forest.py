"""Random forests whose importances select features.

Rows are binned once into stored blocks of one byte a value. A pass over the blocks counts, for
every node of a level of every tree, the classes by bin of the node's own draw of features; a shuffle
by tree adds the counts up, the task that does picks each node's best split, and the driver, which
gets the picked splits alone, holds the trees. How often a row is in a tree's bag follows from seed, block
and tree, so that it is not stored. Every ``STATE_EVERY`` levels the nodes are stored of the rows of
each tree that are still counted, and between these a row walks down from there.

Bags (Poisson of mean 1), Gini gains, draws of as many features as the square root of their number,
limits of a node and importances are those of Spark ML's ``RandomForestClassifier``, whose own fit
stores two numbers a row and tree and sends every node's counts from every partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcraft.session import ensure_checkpoint_dir, settings

#: rows of a block, levels between stored nodes, bytes of a task's counts, rows that a task counts, about
BLOCK_ROWS, STATE_EVERY, COUNT_BYTES, TASK_ROWS = 1 << 16, 5, 96 << 20, 1 << 21
BLOCK = "block bigint, n int, y binary, x binary, state binary"
MAX_CLASSES = 100
#: a block, or the counts of a tree, at a time between Spark and Python: both are large
ONE_BLOCK = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
#: of 65,536 even numbers, how often a row is in a bag: a Poisson draw of mean 1
BAG = np.searchsorted(np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 12)])),
                      (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def fit_cuts(d: DataFrame, n: int, bins: int) -> list[np.ndarray]:
    """At most ``bins`` - 1 cuts of each feature (a value equal to a cut goes left): between all values
    of a feature of at most ``bins`` ones, else quantiles."""
    some = d.agg(*[F.approx_count_distinct(F.get("v", F.lit(k)), 0.05).alias(f"c{k}") for k in range(n)]).first()
    few = [k for k in range(n) if some[k] <= 2 * bins]
    sets = d.agg(*[F.collect_set(F.get("v", F.lit(k))).alias(f"c{k}") for k in few]).first() if few else []
    cuts: dict[int, np.ndarray] = {k: np.unique(v)[:-1] for k, v in zip(few, sets, strict=True) if len(v) <= bins}
    many = [k for k in range(n) if k not in cuts]
    if many:
        got = d.select(*[F.get("v", F.lit(k)).alias(f"c{k}") for k in many]).approxQuantile(
            [f"c{k}" for k in many], [(k + 1) / bins for k in range(bins - 1)], 0.1 / bins)
        cuts |= {k: np.unique(v) for k, v in zip(many, got, strict=True)}
    return [cuts[k] for k in range(n)]


def to_blocks(d: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """Binned rows (label ``y``, values ``v``) in blocks, numbered by partition and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first, at = TaskContext.get().partitionId() << 32, 0

        def packed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            y, x = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held], axis=1)
            return pa.RecordBatch.from_arrays(
                [pa.array([first + at], pa.int64()), pa.array([len(y)], pa.int32()),
                 pa.array([y.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()),
                 pa.array([b""], pa.binary())], names=["block", "n", "y", "x", "state"])
        held, n = [], 0
        for b in batches:
            s = 0
            while s < b.num_rows:
                part = b.slice(s, BLOCK_ROWS - n)
                s += part.num_rows
                v = part.column(1).flatten().to_numpy().reshape(part.num_rows, len(cuts))
                held.append((part.column(0).to_numpy().astype(np.uint8), np.stack(
                    [np.searchsorted(c, v[:, k]).astype(np.uint8) for k, c in enumerate(cuts)])))
                n += part.num_rows
                if n == BLOCK_ROWS:
                    yield packed(held)
                    held, n, at = [], 0, at + 1
        if n:
            yield packed(held)
    return d.select("y", "v").mapInArrow(run, BLOCK)


@dataclass
class Tree:
    """Nodes as columns. A split sends bins up to ``cut`` to node ``left`` and others to the next one; a
    node without a split leads to itself. ``place``: where it is among the nodes being counted, or -1;
    ``alive``: rows there are still counted, now or below."""
    left: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    feature: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    cut: np.ndarray = field(default_factory=lambda: np.full(1, 255, np.uint8))
    place: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    alive: np.ndarray = field(default_factory=lambda: np.ones(1, bool))
    draws: np.ndarray | None = None  # features of each node being counted
    gain: np.ndarray | None = None  # by feature

    def split(self, nodes: np.ndarray, feature: np.ndarray, cut: np.ndarray, goes_on: np.ndarray) -> None:
        """``nodes`` get two children each; ``goes_on`` [nodes, 2]: whether they are counted next."""
        n, new = len(self.left), 2 * len(nodes)
        counted = np.flatnonzero(self.place >= 0)
        self.alive[counted] = False
        self.left[nodes], self.feature[nodes], self.cut[nodes] = n + 2 * np.arange(len(nodes)), feature, cut
        self.alive[nodes] = goes_on.any(axis=1)
        on = goes_on.ravel()
        self.left = np.concatenate([self.left, n + np.arange(new)])
        self.feature = np.concatenate([self.feature, np.zeros(new, np.int64)])
        self.cut = np.concatenate([self.cut, np.full(new, 255, np.uint8)])
        self.place = np.concatenate([np.full(n, -1), np.where(on, np.cumsum(on) - 1, -1)])
        self.alive = np.concatenate([self.alive, on])


def bag(seed: int, block: int, tree: int, n: int) -> np.ndarray:
    return BAG[np.random.Generator(np.random.SFC64([seed, block, tree])).integers(0, 1 << 16, n, np.uint16)]


def walked(x: np.ndarray, n: int, tree: Tree, rows: np.ndarray, at: np.ndarray, steps: int) -> tuple:
    """Rows that are still counted, and their nodes."""
    for k in range(steps + 1):
        on = tree.alive[at]
        if not on.all():
            rows, at = rows[on], at[on]
        if k < steps:
            at = tree.left[at] + (x[tree.feature[at] * n + rows] > tree.cut[at])
    return rows, at


def to_state(parts: Iterator[tuple[np.ndarray, np.ndarray]], wide: bool) -> bytes:
    """Each tree's rows that are still counted, and their nodes."""
    kinds = np.uint32 if BLOCK_ROWS > 1 << 16 else np.uint16, np.uint32 if wide else np.uint16
    sizes, data = [wide], []
    for part in parts:
        sizes.append(len(part[0]))
        data += [v.astype(k).tobytes() for v, k in zip(part, kinds, strict=True)]
    return b"".join([np.array(sizes, np.int32).tobytes(), *data])


class State:
    """Where the rows of a block are: at the root, or at the nodes of ``to_state``."""

    def __init__(self, r: dict, trees: int, seed: int):
        self.r, self.seed, self.sizes = r, seed, None
        if r["state"]:
            head = np.frombuffer(r["state"], np.int32, trees + 1)
            self.kinds = [np.dtype(np.uint32 if BLOCK_ROWS > 1 << 16 else np.uint16),
                          np.dtype(np.uint32 if head[0] else np.uint16)]
            self.sizes = head[1:].astype(np.int64)
            self.starts = 4 * len(head) + np.concatenate([[0], np.cumsum(
                self.sizes * sum(k.itemsize for k in self.kinds))])

    def of(self, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows in the bag of a tree, their nodes, and all rows' numbers in the bag."""
        w = bag(self.seed, self.r["block"], t, self.r["n"])
        if self.sizes is None:
            rows = np.flatnonzero(w)
            return rows, np.zeros(len(rows), np.int64), w
        at, n, (a, b) = self.starts[t], self.sizes[t], self.kinds
        return (np.frombuffer(self.r["state"], a, n, at).astype(np.int64),
                np.frombuffer(self.r["state"], b, n, at + n * a.itemsize).astype(np.int64), w)


def count_block(r: dict, trees: list[Tree], some: list[int], steps: int, seed: int, classes: int, bins: int,
                out: dict[int, np.ndarray]) -> None:
    """Adds [node, draw, bin, class] counts of a block to ``out`` for the trees ``some``."""
    n, x, y = r["n"], np.frombuffer(r["x"], np.uint8), np.frombuffer(r["y"], np.uint8)
    state, size = State(r, len(trees), seed), bins * classes
    for t in some:
        tree, (rows, at, w) = trees[t], state.of(t)
        rows, at = walked(x, n, tree, rows, at, steps)
        if not len(rows):
            continue
        place = tree.place[at]
        base, weight, nodes = place * size + y[rows], w[rows].astype(np.float64), len(tree.draws)
        for j in range(tree.draws.shape[1]):
            code = x[(tree.draws[:, j] * n)[place] + rows].astype(np.int64)
            code *= classes
            code += base
            out[t][:, j] += np.bincount(code, weight, nodes * size).reshape(nodes, bins, classes).astype(np.int32)


def best_splits(counts: np.ndarray, draws: np.ndarray, least: int) -> dict[str, np.ndarray]:
    """Of [node, draw, bin, class] counts each node's best split (gain 0: none), with its rows' classes."""
    left = np.cumsum(counts, axis=2)[:, :, :-1].astype(np.float64)
    total = counts[:, 0].sum(axis=1).astype(np.float64)
    right = total[:, None, None] - left
    nl, nr, n = left.sum(-1), right.sum(-1), total.sum(-1)

    def purity(c, n):  # rows times the sum of squared shares
        return (c * c).sum(-1) / np.maximum(n, 1)
    gain = (purity(left, nl) + purity(right, nr) - purity(total, n)[:, None, None]) / np.maximum(
        n, 1)[:, None, None]
    gain[(nl < least) | (nr < least)] = -1
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    node, j, cut = np.arange(len(gain)), best // gain.shape[2], best % gain.shape[2]
    return {"gain": flat[node, best], "feature": draws[node, j], "cut": cut, "rows": n,
            "left": left[node, j, cut], "right": right[node, j, cut]}


def _counted(blocks: DataFrame, trees: list[Tree], some: list[int], steps: int, seed: int, classes: int,
             bins: int, least: int) -> dict[int, dict[str, np.ndarray]]:
    """One pass: the best splits of the nodes of the trees ``some``."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast(trees)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = {t: np.zeros((*shared.value[t].draws.shape, bins, classes), np.int32) for t in some}
        for b in batches:
            for i in range(b.num_rows):
                count_block(b.slice(i, 1).to_pylist()[0], shared.value, some, steps, seed, classes, bins, out)
        for t in some:
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([out.pop(t).tobytes()],
                                                                                 pa.binary())], names=["tree", "data"])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for t, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                got = np.frombuffer(data, np.int32)
                if t not in sums:
                    sums[t] = np.zeros(len(got), np.int64)
                sums[t] += got
        for t, v in sums.items():
            draws = shared.value[t].draws
            best = best_splits(v.reshape(*draws.shape, bins, classes), draws, least)
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([pickle.dumps(best)],
                                                                                 pa.binary())], names=["tree", "data"])
    import pickle
    parts = max(1, min(len(some), spark.sparkContext.defaultParallelism))
    schema = "tree int, data binary"
    with settings(spark, ONE_BLOCK):
        got = blocks.mapInArrow(task, schema).repartition(parts, "tree").mapInArrow(pick, schema).collect()
    shared.unpersist()
    return {r["tree"]: pickle.loads(bytes(r["data"])) for r in got}


def _stored(blocks: DataFrame, trees: list[Tree], steps: int, seed: int) -> DataFrame:
    """The blocks with the rows of every tree that are in its bag and still counted, and their nodes."""
    shared = blocks.sparkSession.sparkContext.broadcast(trees)
    wide, total = max(len(t.left) for t in trees) > 1 << 16, len(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                n, x, state = r["n"], np.frombuffer(r["x"], np.uint8), State(r, total, seed)
                new = to_state((walked(x, n, tree, *state.of(t)[:2], steps)
                                for t, tree in enumerate(shared.value)), wide)
                yield pa.RecordBatch.from_arrays(
                    [*[b.slice(i, 1).column(k) for k in range(4)], pa.array([new], pa.binary())],
                    names=["block", "n", "y", "x", "state"])
    with settings(blocks.sparkSession, ONE_BLOCK):
        return blocks.mapInArrow(run, BLOCK).checkpoint(eager=True)


def _draw(rng: np.random.Generator, nodes: int, features: int) -> np.ndarray:
    k = int(np.ceil(np.sqrt(features)))
    return np.argsort(rng.random((nodes, features)), axis=1)[:, :k]


def grow(blocks: DataFrame, features: int, classes: int, bins: int, num_trees: int, depth: int, least: int,
         seed: int) -> list[Tree]:
    """All trees, level by level; ``least`` rows of the bag at each side of a split."""
    rng, steps = np.random.default_rng(seed), 0
    trees = [Tree(draws=_draw(rng, 1, features), gain=np.zeros(features)) for _ in range(num_trees)]
    for level in range(depth):
        left = [t for t, tree in enumerate(trees) if len(tree.draws)]
        if not left:
            break
        if steps >= STATE_EVERY:
            blocks, steps = _stored(blocks, trees, steps, seed), 0
        room, some, found = COUNT_BYTES, [], {}
        for t in left:
            size = trees[t].draws.size * bins * classes * 4
            if some and size > room:
                found |= _counted(blocks, trees, some, steps, seed, classes, bins, least)
                some, room = [], COUNT_BYTES
            some.append(t)
            room -= size
        found |= _counted(blocks, trees, some, steps, seed, classes, bins, least)
        steps += 1
        for t in left:
            tree, f = trees[t], found[t]
            good = f["gain"] > 1e-12
            # as in Spark ML: a child of one class or of the last level is a leaf
            on = np.stack([(c.max(axis=1) < c.sum(axis=1)) & (c.sum(axis=1) >= 2 * least)
                           for c in (f["left"][good], f["right"][good])], axis=1) & (level + 1 < depth)
            np.add.at(tree.gain, f["feature"][good], f["gain"][good] * f["rows"][good])
            tree.split(np.flatnonzero(tree.place >= 0)[good], f["feature"][good],
                       f["cut"][good].astype(np.uint8), on)
            tree.draws = _draw(rng, int(on.sum()), features)
    return trees


class ForestModel(Model):
    def __init__(self, trees: list[Tree]):
        super().__init__()
        self.trees = trees

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - Spark ML's name
        """The mean over the trees of their shares of gain by feature, summing up to one."""
        shares = [t.gain / t.gain.sum() for t in self.trees if t.gain.sum() > 0]
        total = np.sum(shares, axis=0) if shares else np.zeros(len(self.trees[0].gain))
        return DenseVector(total / (total.sum() or 1.0))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        raise NotImplementedError("the forest selects features; it does not score rows")


class Forest(Estimator):
    """Stage of a pipeline; ``least`` rows at each side of a split."""

    def __init__(self, label: str, num_trees: int = 100, depth: int = 30, least: int = 1, seed: int = 42,
                 bins: int = 32, features: str = "features"):
        super().__init__()
        self.label, self.num_trees, self.depth, self.least = label, num_trees, depth, least
        self.seed, self.bins, self.features = seed, bins, features

    def _fit(self, dataset: DataFrame) -> ForestModel:
        spark = dataset.sparkSession
        ensure_checkpoint_dir(spark)
        v, y = vector_to_array(F.col(self.features)), F.col(self.label).cast("double")
        wrong = F.coalesce((y < 0) | (y != F.floor(y)) | (y >= MAX_CLASSES) | F.isnan(y), F.lit(True))
        bad = F.coalesce(F.exists(v, lambda a: F.isnan(a) | (F.abs(a) == float("inf"))), F.lit(True))
        d = dataset.select(
            F.when(wrong, F.raise_error(F.lit(f"labels must be whole numbers from 0 to {MAX_CLASSES - 1}"))).otherwise(
                y).cast("int").alias("y"),
            F.when(bad, F.raise_error(F.lit("features must not be null, NaN or infinite"))).otherwise(v).alias("v"))
        n, top, width = d.agg(F.count(F.lit(1)), F.max("y"), F.max(F.size("v"))).first()
        if not n:
            raise ValueError("no rows to fit")
        cuts = fit_cuts(d, width, self.bins)
        tasks = max(spark.sparkContext.defaultParallelism, -(-n // TASK_ROWS))
        # few tasks, each with many blocks: a task sends the counts of every node
        blocks = to_blocks(d, cuts).checkpoint(eager=True)
        blocks = blocks.repartitionByRange(tasks, "block").checkpoint(eager=True)
        return ForestModel(grow(blocks, width, max(2, top + 1), self.bins, self.num_trees, self.depth,
                                self.least, self.seed))
