"""Helpers shared by the operators: inputs, shared folder, Arrow builders, word hashes, components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventcraft.session import ensure_checkpoint_dir

#: bytes of text (or of values) that one step inside a task works on at once; hashing needs
#: about forty times as much for a moment
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    schema = df.schema
    df.write.options(**options).parquet(path)
    return spark.read.schema(schema).parquet(path)


def fold(col: Column | str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(parts)


#: what modules keep in a Python worker between tasks: vocabularies and word caches
HELD: dict[str, dict] = {}


def give_back(keep: str = "") -> None:
    """Drop what other stages (all of HELD but ``keep``) left in a reused worker, and free its memory."""
    for name, held in HELD.items():
        if name != keep:
            held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed memory otherwise
    if trim is not None:
        trim(0)


def lean(step: Callable[[Iterator], Iterator], keep: str = "") -> Callable[[Iterator], Iterator]:
    """A task's ``step`` over Arrow batches that leaves little behind in its worker.

    Workers outlive their tasks, and those of all stages share an executor's memory with
    later stages, also with those that run without Python.
    """
    def run(batches: Iterator) -> Iterator:
        give_back(keep)
        yield from step(batches)
        give_back(keep)
    return run


def slices(batches: Iterator[pa.RecordBatch], column: int = 1,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each slice holds about ``limit`` bytes of ``column``."""
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        col = b.column(column)
        off = np.frombuffer(col.buffers()[1], dtype=np.int64 if pa.types.is_large_string(col.type)
                            or pa.types.is_large_binary(col.type) else np.int32,
                            count=col.offset + n + 1)[col.offset:].astype(np.int64)
        start = 0
        while start < n:
            end = int(np.searchsorted(off, off[start] + limit, side="right")) - 1
            end = min(n, max(end, start + 1))
            yield b.slice(start, end - start)
            start = end


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the row offsets into them (null: empty)."""
    if pa.types.is_large_string(col.type):
        col = col.cast(pa.string())
    col = col.fill_null("")
    buf = col.buffers()[2]
    off = np.frombuffer(col.buffers()[1], dtype=np.int32,
                        count=col.offset + len(col) + 1)[col.offset:].astype(np.int64)
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def int_lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List column from flat values and row offsets, without a copy."""
    flat = pa.array(values, type=kind)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), flat)


_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x2545F4914F6CDD1D)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply) over a uint64 array."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (in ``data``) of words ``[^\\x20\\x09-\\x0D]+``, and words before each row.

    ``data`` holds the rows' bytes end to end; a word never crosses a row's end.
    """
    n = len(data)
    if n == 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(len(offsets), np.int64),)
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]  # row starts also cut words
    first[inner] |= word[inner]
    last[inner - 1] |= word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word after lower-casing A-Z."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    length = ends - starts
    total = int(length.sum())
    first = np.cumsum(length) - length
    within = np.arange(total, dtype=np.int64) - np.repeat(first, length)
    chars = _LOWER[data[np.repeat(starts, length) + within]].astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(
            int(length.max()), _BASE, dtype=np.uint64)]))
        chars *= powers[within]
        return mix64(np.add.reduceat(chars, first) + length.astype(np.uint64) * _MULT)


#: a group with more rows than this (or than a 50,000th of the table) is joined by broadcast
HOT_ROWS = 1000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], count: str,
                total: int) -> DataFrame:
    """``rows`` joined to one row per group, whose hot keys never meet in one task.

    ``groups`` holds each key once with the number of its rows in ``count``.
    At most 50,000 groups can have more than a 50,000th of all ``total`` rows, so
    those are broadcast; the rest, none of them large, join by a shuffle.
    """
    limit = max(HOT_ROWS, total // 50_000)
    hot = groups.where(F.col(count) > limit)
    names = [c for c in rows.columns if c not in keys] + [
        c for c in groups.columns if c not in keys]
    by_hot = rows.join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(
        groups.where(F.col(count) <= limit), keys)
    return by_hot.select(*keys, *names).unionByName(rest.select(*keys, *names))


#: edges that one task may unite; more of them alternate star steps over all tasks
TASK_EDGES = 1 << 20


def unite(batches: Iterator[pa.RecordBatch], limit: int = TASK_EDGES) -> Iterator[pa.RecordBatch]:
    """Edges (a, b), a > b, that connect the same ids: each id is linked to the smallest one it reaches.

    The ids of at most ``limit`` edges are held at once, then their links are passed on
    and it begins anew.
    """
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = y
        return x

    def links() -> pa.RecordBatch:
        pairs = [(x, root(x)) for x in up]
        pairs = [p for p in pairs if p[0] != p[1]]
        return pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

    seen = 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if a != b and (x := root(a)) != (y := root(b)):
                up[max(x, y)] = min(x, y)
        seen += batch.num_rows
        if seen >= limit:
            yield links()
            up, seen = {}, 0
    if up:
        yield links()


def spanning(edges: DataFrame, limit: int = TASK_EDGES) -> DataFrame:
    """``unite`` the edges (a, b) of each task."""
    return edges.select("a", "b").mapInArrow(lean(lambda it: unite(it, limit)), "a bigint, b bigint")


def connected(edges: DataFrame, rounds: int = 60, task_edges: int = TASK_EDGES,
              united: bool = False) -> DataFrame:
    """(id, component): the smallest id reachable from each id that has an edge (a, b).

    Tasks first unite their own edges, which leaves at most one edge for each id of a
    task (``united``: the tasks that made the edges did so, and need no second Python
    worker for it). Up to ``task_edges`` of them are then united by one task. More of them
    alternate two steps until nothing changes: every vertex links its larger
    neighbours to the smallest id it sees, then its smaller neighbours likewise. The
    edge list never grows, each round is cut with ``checkpoint()``, and a vertex of
    any degree is a partial aggregation and a split join, never one task's work.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = (edges.select("a", "b") if united else spanning(edges)).distinct().checkpoint()
    if e.count() <= task_edges:
        e = spanning(e.coalesce(1), 2 * task_edges).checkpoint()
        return _labels(e)

    def mark() -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(
            F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = mark()
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        large = join_groups(both, low, ["a"], "n", 2 * seen[0]).where("b > a").select(
            F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct().checkpoint()
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        e = join_groups(large, low, ["a"], "n", 2 * seen[0]).select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("m").alias("b")).distinct().checkpoint()
        if (now := mark()) == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return _labels(e)


def _labels(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        stars.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def shared_ids(rows: DataFrame, classes: DataFrame, id_col: str, keys: list[str],
               total: int) -> DataFrame:
    """Edges (a, b) from each id whose rows lie in several classes to those classes' ``rep``.

    ``classes`` holds ``keys``, ``rep`` and the number of rows in ``copies``. The rows of
    such ids, few as a rule, are stored: both halves of the join read them.
    """
    several = rows.groupBy(id_col).agg(F.min(F.xxhash64(*keys)).alias("x"), F.max(
        F.xxhash64(*keys)).alias("y")).where("x <> y").select(id_col)
    rows = rows.join(several, id_col, "left_semi").select(id_col, *keys).checkpoint()
    return join_groups(rows, classes.select(*keys, "rep", "copies"), keys, "copies", total).select(
        F.col(id_col).alias("a"), F.col("rep").alias("b"))


class Forest:
    """Union-find over small indices; the least index is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables that hold whole groups of the first ``keys`` columns, from sorted Arrow batches."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        n = b.num_rows
        same = np.ones(n - 1, dtype=bool)
        for k in range(keys):
            v = b.column(k).to_numpy(zero_copy_only=False)
            same &= v[1:] == v[:-1]
        cuts = np.flatnonzero(~same)
        if held and any(held[-1].column(k)[-1] != b.column(k)[0] for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        if len(cuts):
            at = int(cuts[-1]) + 1
            yield pa.Table.from_batches([*held, b.slice(0, at)])
            held = [b.slice(at)]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)


def runs(table: pa.Table, keys: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the groups of the first ``keys`` columns."""
    n = table.num_rows
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for k in range(keys):
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    starts = np.flatnonzero(new)
    return starts, np.append(starts[1:], n)


def block_pairs(df: DataFrame, blocks: str, salt: Column) -> DataFrame:
    """Deal each row to its block's pairs: columns i <= j, and ``side`` 1 for the later block.

    ``blocks`` names the group's number of blocks (1: the row is dealt once).
    Every two rows of a group meet in exactly one (i, j), whose size is that of
    two blocks at most, however large the group is.
    """
    own = F.pmod(salt, F.col(blocks)).cast("int")
    d = df.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int"))))
    return d.withColumns({
        "i": F.least("own", "other"), "j": F.greatest("own", "other"),
        "side": (F.col("own") > F.col("other")).cast("int")}).drop("own", "other")


class Recent:
    """A bounded cache of two generations: what is in use moves on, the rest is dropped."""

    def __init__(self, limit: int, longest: int = 128):
        self.limit, self.longest = limit, longest
        self.now: dict = {}
        self.before: dict = {}
        self.long: list = []

    def one(self, key: str, make):
        """The value of a single key."""
        if (v := self.now.get(key)) is None:
            if (v := self.before.get(key)) is None:
                v = make(key)
            if len(key) <= self.longest:
                if len(self.now) > self.limit:
                    self.before, self.now = self.now, {}
                self.now[key] = v
        return v

    def _turn(self) -> dict:
        """The current generation, a new one if it is full, without the last call's long keys."""
        if len(self.now) > self.limit:
            self.before, self.now = self.now, {}
        for k in self.long:
            self.now.pop(k, None)
            self.before.pop(k, None)
        self.long = []
        return self.now

    def fill(self, keys: list[str], make) -> dict:
        """The current generation, with every one of ``keys`` in it until the next call."""
        return self.fill_all(keys, lambda new: list(map(make, new)))

    def fill_all(self, keys: list[str], make_all) -> dict:
        """The same; ``make_all`` gets all new keys at once."""
        now = self._turn()
        new = []
        for k in set(keys).difference(now):
            if (v := self.before.get(k)) is None:
                new.append(k)
            else:
                now[k] = v
        if new:
            now.update(zip(new, make_all(new), strict=True))
            self.long = [k for k in new if len(k) > self.longest]
        return now
