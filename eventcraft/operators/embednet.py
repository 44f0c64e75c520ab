"""A net with category embeddings whose parameters are a keyed table.

The embedding of every (column, value) is a row of a table that only Spark holds: a step joins
the rows that a batch uses, adds up sparse gradients by key and updates those rows. What the
driver holds is the dense part - (columns x width + numbers) x hidden numbers - whatever the
number of categories.

Training rows are packed once into blocks; a block lists each of its keys once, so a value
that a third of all rows share is sent to a block once and comes back as one gradient.

Blocks are stored by their number, the list of what they use and the table by key, so a step is
one plan with two exchanges: weights go to the blocks, gradients to the keys. The driver, which
plans every step of a long fit, then stays small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcraft.operators.evaluate import auc
from eventcraft.session import STORED_ROWS, ensure_checkpoint_dir, let_go, settings

BLOCK_ROWS = 4096
#: blocks, and uses of a key by a block, that are stored in a partition, about
PART_BLOCKS, PART_USES = 64, 1 << 16
BLOCK = ("block bigint, n int, id binary, y binary, num binary, slot binary, keys array<string>")
DENSE = "\0dense"  # key of the dense part's gradient; categories' keys start with a digit
GRADIENT = "key string, block bigint, g array<double>, n bigint, loss double"
TABLE = "key string, w array<double>, m array<double>, v array<double>, t int"


@dataclass(frozen=True)
class Settings:
    categories: tuple[str, ...]
    numbers: tuple[str, ...] = ()
    width: int = 8
    hidden: int = 16
    rate: float = 0.05
    epochs: int = 50
    patience: int = 7
    min_gain: float = 1e-4
    batch_rows: int = 1 << 20
    seed: int = 42


@dataclass
class Net:
    """Fitted state: the embedding table, the dense numbers, and the rounds' validation AUC."""
    settings: Settings
    table: DataFrame
    dense: np.ndarray
    aucs: list[float] = field(default_factory=list)
    ended: str = "budget"


def shapes(s: Settings) -> list[tuple[int, ...]]:
    inputs = len(s.categories) * s.width + len(s.numbers)
    return [(inputs, s.hidden), (s.hidden,), (s.hidden,), (1,)]


def parts(s: Settings, dense: np.ndarray) -> list[np.ndarray]:
    out, at = [], 0
    for shape in shapes(s):
        n = int(np.prod(shape))
        out.append(dense[at:at + n].reshape(shape))
        at += n
    return out


def start_dense(s: Settings) -> np.ndarray:
    rng = np.random.default_rng(s.seed)
    w1, b1, w2, b2 = shapes(s)
    return np.concatenate([
        rng.normal(0, np.sqrt(2 / w1[0]), w1).ravel(), np.zeros(b1),
        rng.normal(0, np.sqrt(1 / w2[0]), w2), np.zeros(b2)])


def start_table(blocks: DataFrame, s: Settings) -> DataFrame:
    """One row for each key; its first weights follow from the key alone."""
    unit = F.transform(F.sequence(F.lit(0), F.lit(s.width - 1)), lambda i: F.xxhash64(
        "key", i, F.lit(s.seed)).cast("double") / F.lit(2.0**63))
    zero = F.array_repeat(F.lit(0.0), s.width)
    return blocks.select(F.explode("keys").alias("key")).distinct().select(
        "key", F.transform(unit, lambda x: x * 0.5).alias("w"), zero.alias("m"), zero.alias("v"),
        F.lit(0).alias("t"))


def to_blocks(df: DataFrame, s: Settings, id_col: str, label: str | None = None) -> DataFrame:
    """Pack rows: ids, labels (0 without ``label``), numbers (null and NaN as 0) and, for each
    category, the place of its key in the block's list. Null is a value like others."""
    keys = [F.concat(F.lit(f"{i}:"), F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")))
            for i, c in enumerate(s.categories)]
    nums = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in s.numbers]
    y = F.col(label).cast("double") if label else F.lit(0.0)
    d = df.select(F.col(id_col).cast("bigint").alias("id"), y.alias("y"),
                  F.array(*nums).cast("array<double>").alias("num"), F.array(*keys).alias("key"))
    n = max(1, -(-d.count() // BLOCK_ROWS))

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("id").combine_chunks()
        keys, slot = np.unique(t["key"].combine_chunks().flatten().to_numpy(zero_copy_only=False),
                               return_inverse=True)
        num = t["num"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table({
            "block": pa.array([t["block"][0].as_py()], pa.int64()),
            "n": pa.array([t.num_rows], pa.int32()),
            "id": [t["id"].to_numpy().astype(np.int64).tobytes()],
            "y": [t["y"].to_numpy().astype(np.float64).tobytes()],
            "num": [num.astype(np.float64).tobytes()],
            "slot": [slot.astype(np.int32).tobytes()],
            "keys": pa.array([keys.tolist()], pa.list_(pa.string()))})
    return d.withColumn("block", F.pmod(F.xxhash64("id", F.lit(s.seed)), F.lit(n))).groupBy(
        "block").applyInArrow(pack, BLOCK)


@dataclass
class Stored:
    """Blocks by number, and which blocks use a key at which place of their list, by key; both are
    checkpointed in ``parts`` and ``use_parts`` partitions that joins find in place."""
    blocks: DataFrame
    uses: DataFrame
    parts: int
    use_parts: int

    def where(self, batches: int, k: int) -> Stored:
        own = F.pmod("block", F.lit(batches)) == k
        return replace(self, blocks=self.blocks.where(own), uses=self.uses.where(own))


def uses_of(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", F.posexplode("keys").alias("place", "key"))


def store(blocks: DataFrame) -> Stored:
    """``blocks`` must be checkpointed: they are read to count them and to store them by number."""
    n, uses = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    # two at least: of a single partition Spark forgets the key
    parts = max(2, min(n, max(cores, -(-n // PART_BLOCKS))))
    use_parts = max(2, -(-uses // PART_USES))
    with settings(blocks.sparkSession, STORED_ROWS):
        kept = blocks.repartition(parts, "block").sortWithinPartitions("block").checkpoint(eager=True)
        return Stored(kept, uses_of(kept).repartition(use_parts, "key").sortWithinPartitions(
            "key").checkpoint(eager=True), parts, use_parts)


def with_weights(blocks: DataFrame | Stored, table: DataFrame) -> DataFrame:
    """Every block with the weights of its keys, (place, w) pairs: at most its rows x columns.
    Keys that the table does not hold are left out and count as zeros.

    Both joins are merge joins: Spark counts a list as one element, so it takes lists of
    weights for small and would gather them on the driver to broadcast them."""
    stored = isinstance(blocks, Stored)
    uses, rows = (blocks.uses, blocks.blocks) if stored else (uses_of(blocks), blocks)
    got = uses.join(table.select("key", "w").hint("merge"), "key").withColumnRenamed("block", "__b")
    if stored:
        got = got.repartition(blocks.parts, "__b")
    got = got.groupBy("__b").agg(F.collect_list(F.struct("place", "w")).alias("weights"))
    return rows.join(got.hint("merge"), F.col("block") == F.col("__b"), "left").drop("__b")


def forward(s: Settings, dense: np.ndarray, r: dict) -> tuple[np.ndarray, ...]:
    """ids, labels, slots, inputs, hidden values and scores of one block."""
    emb = np.zeros((len(r["keys"]), s.width))
    if r["weights"]:
        emb[[e["place"] for e in r["weights"]]] = [e["w"] for e in r["weights"]]
    slot = np.frombuffer(r["slot"], np.int32).reshape(r["n"], len(s.categories))
    num = np.frombuffer(r["num"]).reshape(r["n"], len(s.numbers))
    x = np.concatenate([emb[slot].reshape(r["n"], -1), num], axis=1)
    w1, b1, w2, b2 = parts(s, dense)
    h = np.maximum(x @ w1 + b1, 0)
    p = 1 / (1 + np.exp(-np.clip(h @ w2 + b2, -35, 35)))
    return np.frombuffer(r["id"], np.int64), np.frombuffer(r["y"]), slot, x, h, p


def gradients(blocks: DataFrame | Stored, table: DataFrame, dense: np.ndarray, s: Settings) -> DataFrame:
    """(key, g, n, loss): gradients of the summed log loss by key over all blocks; the dense
    part's is the row of key ``DENSE``, with the rows' number and their loss."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                _, y, slot, x, h, p = forward(s, dense, r)
                w1, _, w2, _ = parts(s, dense)
                d = p - y
                dh = np.outer(d, w2) * (h > 0)
                g = np.concatenate([(x.T @ dh).ravel(), dh.sum(0), h.T @ d, [d.sum()]])
                dx = (dh @ w1.T)[:, :len(s.categories) * s.width].reshape(-1, s.width)
                per = np.zeros((len(r["keys"]), s.width))
                np.add.at(per, slot.ravel(), dx)
                loss = -float(np.sum(np.where(y > 0.5, np.log(p), np.log1p(-p))))
                k = len(per)
                yield pa.RecordBatch.from_arrays([
                    pa.array([DENSE, *r["keys"]]), pa.array([r["block"]] * (k + 1), pa.int64()),
                    pa.array([g.tolist(), *per.tolist()], pa.list_(pa.float64())),
                    pa.array([r["n"]] + [0] * k, pa.int64()), pa.array([loss] + [0.0] * k)],
                    names=["key", "block", "g", "n", "loss"])
    sparse = with_weights(blocks, table).mapInArrow(run, GRADIENT)
    if isinstance(blocks, Stored):  # where the table's rows are
        sparse = sparse.repartition(blocks.use_parts, "key")
    # at most one gradient a block and key, added up in the blocks' order: the same in every run
    rows = F.array_sort(F.collect_list(F.struct("block", "g")))
    total = F.aggregate(rows, F.transform(F.element_at(rows, 1)["g"], lambda x: x * 0.0),
                        lambda acc, r: F.zip_with(acc, r["g"], lambda u, v: u + v))
    return sparse.groupBy("key").agg(total.alias("g"), F.sum("n").alias("n"), F.sum("loss").alias("loss"))


def adam(w, m, v, g, t, rate):
    m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
    return w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8), m, v


def _moved(table: DataFrame, grads: DataFrame, n: int, rate: float) -> DataFrame:
    """``update`` with the dense part's gradient sum in the row of key ``DENSE``, if the table has it."""
    g = grads.select("key", F.col("g").alias("own"), F.transform("g", lambda x: x / n).alias("g")).hint("merge")
    moves = F.col("g").isNotNull() & (F.col("key") != DENSE)
    t = F.col("t") + F.when(moves, 1).otherwise(0)
    m = F.when(moves, F.zip_with("m", "g", lambda a, b: a * 0.9 + b * 0.1)).otherwise(F.col("m"))
    v = F.when(moves, F.zip_with("v", "g", lambda a, b: a * 0.999 + b * b * 0.001)).otherwise(F.col("v"))
    step = F.zip_with("m", "v", lambda a, b: (a / (1 - F.pow(F.lit(0.9), F.col("t")))) / (
        F.sqrt(b / (1 - F.pow(F.lit(0.999), F.col("t")))) + 1e-8) * rate)
    w = F.when(F.col("moves"), F.zip_with("w", step, lambda a, b: a - b)).otherwise(F.col("w"))
    return table.join(g, "key", "left").select(
        "key", "w", m.alias("m"), v.alias("v"), t.alias("t"), moves.alias("moves"),
        F.when(F.col("key") == DENSE, F.col("own")).alias("own")).select(
        "key", w.alias("w"), "m", "v", "t", "own")


def update(table: DataFrame, grads: DataFrame, n: int, rate: float) -> DataFrame:
    """The table after one step: rows with a gradient move, the others stay as they are."""
    return _moved(table, grads, n, rate).drop("own")


def fit(train: DataFrame, valid: DataFrame, s: Settings, label: str, id_col: str) -> Net:
    """Train in epochs of seeded batches, score ``valid`` after each, keep the best epoch's state
    and stop after ``patience`` epochs that gain no more than ``min_gain`` AUC."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    blocks = store(to_blocks(train, s, id_col, label).checkpoint(eager=True))
    held = store(to_blocks(valid, s, id_col, label).checkpoint(eager=True))
    rows = blocks.blocks.agg(F.sum("n")).first()[0] or 0
    batches = -(-rows // s.batch_rows)
    sizes = {r["k"]: r["n"] for r in blocks.blocks.groupBy(F.pmod("block", F.lit(batches)).alias(
        "k")).agg(F.sum("n").alias("n")).collect()} if batches else {}
    dense = start_dense(s)
    m, v, t = np.zeros_like(dense), np.zeros_like(dense), 0
    # the row of the dense part carries its gradient to the driver
    own = spark.createDataFrame([(DENSE, [], [], [], 0)], TABLE)
    with settings(spark, STORED_ROWS):
        table = start_table(blocks.blocks, s).unionByName(own).repartition(
            blocks.use_parts, "key").sortWithinPartitions("key").checkpoint(eager=True)
    best, aucs, since = Net(s, table.where(F.col("key") != DENSE), dense), [], 0
    for _ in range(s.epochs if batches else 0):
        for k in range(batches):
            if k not in sizes:  # fewer blocks than batches
                continue
            with settings(spark, STORED_ROWS):
                step = _moved(table, gradients(blocks.where(batches, k), table, dense, s), sizes[k],
                              s.rate).checkpoint(eager=True)
            g = step.where(F.col("own").isNotNull()).select("own").collect()[0]["own"]
            table = step.drop("own")
            t += 1
            dense, m, v = adam(dense, m, v, np.array(g) / sizes[k], t, s.rate)
        # the curve reads the scores several times; its tasks, which the driver keeps account of, follow their number
        with settings(spark, STORED_ROWS | {"spark.sql.shuffle.partitions": str(held.parts)}):
            scored = _scored(held, table, dense, s).checkpoint(eager=True)
            now = auc(scored, "label", "score").first()
        aucs.append(now["auc"] if now and now["auc"] is not None else 0.5)
        if len(aucs) == 1 or aucs[-1] > max(best.aucs) + s.min_gain:
            best, since = Net(s, table.where(F.col("key") != DENSE), dense, list(aucs)), 0
        else:
            since += 1
            if since >= s.patience:
                return replace(best, aucs=aucs, ended="patience")
        let_go(spark)
    return replace(best, aucs=aucs)


def _scored(blocks: DataFrame | Stored, table: DataFrame, dense: np.ndarray, s: Settings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, y, _, _, _, p = forward(s, dense, b.slice(i, 1).to_pylist()[0])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(y.astype(np.int32)),
                                                  pa.array(p)], names=["id", "label", "score"])
    return with_weights(blocks, table).mapInArrow(run, "id bigint, label int, score double")


def score(df: DataFrame, net: Net, id_col: str) -> DataFrame:
    """(id, score) of every row; values that training did not hold count as zeros."""
    return _scored(to_blocks(df, net.settings, id_col), net.table, net.dense, net.settings).select(
        F.col("id").alias(id_col), "score")
