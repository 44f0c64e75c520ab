"""Language-model scores of a hashed maximum-entropy model with a class-factored softmax.

    P(word | context) = P(group | context) P(class | group, context) P(word | class)

A word's class comes from the word alone: the end and the most frequent words
have classes of their own, other words share them by a hash of their last two
bytes. Group and class are log-linear in features of the two words before:
their classes, the words themselves (next and skip), and the pair of classes,
the latter three hashed. Inside a class a word has its smoothed share of the
class's training tokens, with one share left for all unseen words, so that the
whole sums to one.

Word counts cover all training documents. They are looked up once for each slice
of documents and distinct word, so what is shuffled follows the corpus, no word
is a hot key, and no vocabulary is broadcast. The weights (a fixed size) are
trained in rounds over all training documents: every task takes mini-batch steps
from the shared weights, and their steps are averaged by the number of times a
feature was seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventcraft.llm.common import (
    mix64,
    slices,
    text_bytes,
    word_hashes,
    word_spans,
    write_table,
)

#: groups and classes in a group; classes 1..TOP are single frequent words, 0 is the end
GROUPS, MEMBERS, TOP = 8, 16, 15
CLASSES = GROUPS * MEMBERS
#: buckets of each hashed feature
BUCKETS = 2048
#: text of a slice, whose words are looked up together
SLICE_TEXT = 40 << 20
ROUNDS, STEP, BATCH_TOKENS = 2, 0.5, 16384

END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
#: rows of the weights: bias, class before, class two before, then three hashed features
_CLASS_ROWS = CLASSES + 1
_HASHED = 1 + 2 * _CLASS_ROWS
ROWS = _HASHED + 3 * BUCKETS
FEATURES = 6


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with an end after each row, their suffix classes, and row offsets."""
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends)
    last = data[ends - 1].astype(np.uint64) if len(ends) else np.zeros(0, np.uint64)
    prev = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.uint64) \
        if len(ends) else last
    low = [np.where((x >= 65) & (x <= 90), x + np.uint64(32), x) for x in (last, prev)]
    with np.errstate(over="ignore"):
        suffix = mix64(low[0] * np.uint64(256) + low[1] + np.uint64(1))
    cls = (suffix % np.uint64(CLASSES - 1 - TOP)).astype(np.int64) + 1 + TOP
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    off = first + np.arange(len(first))
    out, kind = np.full(off[-1], END), np.zeros(off[-1], np.int64)
    at = np.arange(len(h)) + row
    out[at], kind[at] = h, cls
    return out, kind, off


def context(h: np.ndarray, cls: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Feature rows [feature, token] of the two tokens before each one in its document."""
    n = len(h)
    at = np.arange(n) - np.repeat(off[:-1], np.diff(off))
    h1 = np.where(at >= 1, np.roll(h, 1), START)
    h2 = np.where(at >= 2, np.roll(h, 2), START)
    c1 = np.where(at >= 1, np.roll(cls, 1), CLASSES)
    c2 = np.where(at >= 2, np.roll(cls, 2), CLASSES)
    b = np.uint64(BUCKETS)
    with np.errstate(over="ignore"):
        pair = mix64((c1 * _CLASS_ROWS + c2).astype(np.uint64) + np.uint64(7))
        skip = mix64(h2 + np.uint64(3))
    hashed = [(x % b).astype(np.int64) + _HASHED + k * BUCKETS
              for k, x in enumerate((h1, skip, pair))]
    return np.stack([np.zeros(n, np.int64), 1 + c1, 1 + _CLASS_ROWS + c2, *hashed])


def new_weights() -> tuple[np.ndarray, np.ndarray]:
    return (np.zeros((ROWS, GROUPS), np.float32),
            np.zeros((ROWS * GROUPS, MEMBERS), np.float32))


def _softmax(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = x - x.max(axis=1, keepdims=True)
    e = np.exp(x)
    s = e.sum(axis=1, keepdims=True)
    return x - np.log(s), e / s


def class_scores(weights: tuple[np.ndarray, np.ndarray], rows: np.ndarray,
                 cls: np.ndarray) -> np.ndarray:
    """Natural-log probability of each token's class."""
    g, m = cls // MEMBERS, cls % MEMBERS
    at = np.arange(len(cls))
    group, _ = _softmax(sum(weights[0][r] for r in rows))
    member, _ = _softmax(sum(weights[1][r * GROUPS + g] for r in rows))
    return group[at, g].astype(np.float64) + member[at, m]


def train_step(weights: tuple[np.ndarray, np.ndarray], rows: np.ndarray, cls: np.ndarray,
               step: float) -> np.ndarray:
    """One mini-batch step in place; how often each feature row was seen."""
    g, m = cls // MEMBERS, cls % MEMBERS
    at = np.arange(len(cls))
    _, pg = _softmax(sum(weights[0][r] for r in rows))
    _, pm = _softmax(sum(weights[1][r * GROUPS + g] for r in rows))
    pg[at, g] -= 1
    pm[at, m] -= 1
    flat = rows.ravel()
    seen = np.bincount(flat, minlength=ROWS)
    some = np.flatnonzero(seen)
    each = np.tile(at, len(rows))
    for k in range(GROUPS):
        total = np.bincount(flat, weights=pg[each, k], minlength=ROWS)
        weights[0][some, k] -= step * (total[some] / seen[some])
    flat = (rows * GROUPS + g).ravel()
    hits = np.bincount(flat, minlength=ROWS * GROUPS)
    some = np.flatnonzero(hits)
    for k in range(MEMBERS):
        total = np.bincount(flat, weights=pm[each, k], minlength=ROWS * GROUPS)
        weights[1][some, k] -= step * (total[some] / hits[some])
    return seen


def _own_class(h: np.ndarray, cls: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Classes with those of the frequent words (sorted hashes and their class)."""
    if not len(top):
        return cls
    k = np.minimum(np.searchsorted(top[0], h), len(top[0]) - 1)
    return np.where(top[0][k] == h, top[1][k].astype(np.int64), cls)


def _sliced(docs: DataFrame) -> DataFrame:
    """(slice, doc_id, held_out, text): consecutive rows of a task, about SLICE_TEXT of text each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, size, k = TaskContext.get().partitionId() << 24, 0, 0
        for b in slices(batches, 2, SLICE_TEXT // 8):
            size += b.column(2).nbytes
            if size > SLICE_TEXT:
                k, size = k + 1, 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(b.num_rows, part + k)), *b.columns],
                names=["slice", "doc_id", "held_out", "text"])

    return docs.mapInArrow(run, "slice bigint, doc_id bigint, held_out boolean, text string")


def _slice_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slice, word, class, n): distinct words of each slice and their training count."""
    for b in slices(batches, 2, 8 << 20):
        ids = b.column(0).to_numpy()
        for s in np.unique(ids).tolist():
            own = b.filter(pa.array(ids == s))
            h, cls, off = tokens_of(*text_bytes(own.column(2)))
            learn = np.repeat(~own.column(1).to_numpy(zero_copy_only=False), np.diff(off))
            words, at, inv = np.unique(h, return_index=True, return_inverse=True)
            n = np.bincount(inv, weights=learn, minlength=len(words)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(words), s)), pa.array(words.view(np.int64)),
                 pa.array(cls[at].astype(np.int16)), pa.array(n)],
                names=["slice", "word", "cls", "n"])


BLOCK_ROWS = 32
_STEPS = "shard int, block int, data binary"


def _train(prepared: DataFrame, top: np.ndarray, rounds: int, step: float) -> tuple:
    """Weights after ``rounds`` averaged passes, each over its share of the training documents."""
    sc = prepared.sparkSession.sparkContext
    weights = new_weights()
    width = GROUPS * (1 + MEMBERS) + 1
    learn = prepared.where(~F.col("held_out")).select("text", F.pmod(
        F.xxhash64("doc_id", "text"), F.lit(rounds)).alias("round"))
    for k in range(rounds):
        shared = sc.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            own = tuple(w.copy() for w in shared.value)
            seen = np.zeros(ROWS, np.int64)
            for b in slices(batches, 0, 2 << 20):
                h, cls, off = tokens_of(*text_bytes(b.column(0)))
                cls = _own_class(h, cls, top)
                rows = context(h, cls, off)
                for s in range(0, len(h), BATCH_TOKENS):
                    seen += train_step(own, rows[:, s:s + BATCH_TOKENS],
                                       cls[s:s + BATCH_TOKENS], step)
            if not seen.any():
                return
            moved = np.concatenate([
                own[0] - shared.value[0],
                (own[1] - shared.value[1]).reshape(ROWS, -1)], axis=1) * seen[:, None]
            data = np.concatenate([moved, seen[:, None]], axis=1).astype(np.float32)
            shard = TaskContext.get().partitionId() % 32
            blocks = range(0, ROWS, BLOCK_ROWS)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(blocks), pa.int32()),
                 pa.array([r // BLOCK_ROWS for r in blocks], pa.int32()),
                 pa.array([data[r:r + BLOCK_ROWS].tobytes() for r in blocks], pa.binary())],
                names=["shard", "block", "data"])

        def add(t: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x, np.float32).astype(np.float64)
                        for x in t.column("data").to_pylist())
            return t.slice(0, 1).set_column(
                t.schema.get_field_index("data"), "data",
                pa.array([total.astype(np.float32).tobytes()], pa.binary()))

        got = learn.where(F.col("round") == k).select("text").mapInArrow(run, _STEPS)
        got = got.groupBy("shard", "block").applyInArrow(add, _STEPS).groupBy(
            "block").applyInArrow(add, _STEPS).select("block", "data").collect()
        shared.unpersist()
        data = np.zeros((ROWS, width), np.float64)
        for r in got:
            x = np.frombuffer(bytes(r["data"]), np.float32).reshape(-1, width)
            data[r["block"] * BLOCK_ROWS:r["block"] * BLOCK_ROWS + len(x)] = x
        moved = data[:, :-1] / np.maximum(data[:, -1:], 1)
        weights = (weights[0] + moved[:, :GROUPS].astype(np.float32),
                   weights[1] + moved[:, GROUPS:].reshape(-1, MEMBERS).astype(np.float32))
    return weights


SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
          "train_tokens bigint, base_score double, score double")


def lm_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
              rounds: int = ROUNDS, step: float = STEP) -> DataFrame:
    """Unigram base and model score (log10) of every row, learned where ``held_out`` is false.

    A null or empty text is the end alone; a null ``held_out`` counts as false.
    Rows that share an id are scored each. Without training text every base
    probability is 1. An empty table gives no rows; other columns are left out.
    """
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                    F.coalesce(held_out, F.lit(False)).alias("held_out"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sc = docs.sparkSession.sparkContext
    prepared = write_table(_sliced(d), "slices", compression="zstd")
    words = prepared.select("slice", "held_out", "text").mapInArrow(
        _slice_words, "slice bigint, word bigint, cls smallint, n bigint")
    w = Window.partitionBy("word")
    looked = words.select("slice", "word", "cls", "n", F.sum("n").over(w).alias("c"), (
        F.row_number().over(w.orderBy("slice")) == 1).alias("first"))
    looked = write_table(looked, "words", compression="zstd")
    distinct = looked.where("first and c > 0")
    best = distinct.where(F.col("word") != int(END.view(np.int64))).orderBy(
        F.desc("c"), "word").limit(TOP).collect()
    found = np.array(sorted((np.int64(r["word"]).view(np.uint64), k + 1)
                            for k, r in enumerate(best)), dtype=np.uint64).reshape(-1, 2).T
    top = found if found.size else np.zeros((0, 0), np.uint64)
    size = np.zeros((2, CLASSES))
    singles = F.create_map(*[x for k, r in enumerate(best) for x in (
        F.lit(r["word"]), F.lit(k + 1))]) if best else None
    cls = F.col("cls").cast("int")
    if singles is not None:
        cls = F.coalesce(singles[F.col("word")], cls)
    for r in distinct.groupBy(cls.alias("k")).agg(
            F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():  # one row a class
        size[:, r["k"]] = r["n"], r["v"]
    total, kinds = int(size[0].sum()), int(size[1].sum())
    weights = sc.broadcast(_train(prepared, top, rounds, step))
    inside = np.log10(size.sum(axis=0) + 1)
    base = np.log10(total + kinds + 1)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        word, at = np.unique(right.column("word").to_numpy().view(np.uint64), return_index=True)
        c = right.column("c").to_numpy()[at]
        for b in slices(left.combine_chunks().to_batches(), 3, 2 << 20):
            h, cls, off = tokens_of(*text_bytes(b.column(3)))
            cls = _own_class(h, cls, top)
            n = c[np.searchsorted(word, h)]
            share = np.log10(n + 1.0)
            rows, own = context(h, cls, off), np.empty(len(h))
            for s in range(0, len(h), BATCH_TOKENS):
                e = s + BATCH_TOKENS
                own[s:e] = class_scores(weights.value, rows[:, s:e], cls[s:e])
            own = own / np.log(10) + share - inside[cls]
            first = off[:-1]
            parts.append(pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), pa.array(np.diff(off)),
                 pa.array(np.add.reduceat((n > 0).astype(np.int64), first)),
                 pa.array(np.full(b.num_rows, total)),
                 pa.array(np.add.reduceat(share - base, first)),
                 pa.array(np.add.reduceat(own, first))], names=_NAMES))
        return pa.Table.from_batches(parts, schema=_SCHEMA)

    return prepared.groupBy("slice").cogroup(
        looked.select("slice", "word", "c").groupBy("slice")).applyInArrow(score, SCORES)


_NAMES = [x.split()[0] for x in SCORES.split(", ")]
_SCHEMA = pa.schema(list(zip(_NAMES, (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(),
                                      pa.float64(), pa.float64()), strict=True)))
