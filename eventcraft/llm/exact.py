"""Exact duplicates by a minimal perfect hash over the digests of a history.

The history's distinct digests are dealt into shards of bounded size. Each shard
is one stored row: a minimal perfect hash (levels of bits; a digest sits at the
first level where no other digest shares its bit, and its slot is the number of
set bits before it) and, slot by slot, the full digest, the locator of its winner
and the number of its copies.

Any digest, known or not, hashes to some slot, so a lookup compares all 32 bytes
of the slot's digest. Members are repeats of the slot's winner and leave; the
others form groups of their own. Rows are first aggregated by digest, so a text
that a third of all rows share is one row per task before anything is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventcraft.llm.common import join_groups, mix64, runs, shared_path, sorted_groups, write_table

#: bits of a level for each digest that is still without a slot
GAMMA = 2.0
#: digests of a shard, on average
SHARD_DIGESTS = 1 << 16

INDEX = ("shard bigint, n bigint, levels array<binary>, digests binary, winners array<bigint>, "
         "copies array<bigint>")
CLASSES = "digest binary, keep_id bigint, group_size bigint, known boolean"


def _words(digests: bytes) -> np.ndarray:
    """Four 64-bit words for each 32-byte digest."""
    return np.frombuffer(digests, dtype="<u8").reshape(-1, 4)


def _bits(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """The bit of each digest at a level of ``size`` bits."""
    odd = np.random.default_rng([level, 11]).integers(
        0, 1 << 63, size=4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    with np.errstate(over="ignore"):
        return (mix64((words * odd).sum(axis=1, dtype=np.uint64)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Maps n distinct digests one to one onto 0 .. n-1; other digests to any of them, or to -1."""

    def __init__(self, levels: list[bytes]):
        self.levels = [np.unpackbits(np.frombuffer(x, np.uint8), bitorder="little") for x in levels]
        self.before = [np.cumsum(x, dtype=np.int64) - x for x in self.levels]
        self.first = np.cumsum([0, *(int(x.sum()) for x in self.levels)])

    @staticmethod
    def build(words: np.ndarray) -> list[bytes]:
        """The levels' bits for distinct digests (rows of four words)."""
        levels, left = [], words
        while len(left):
            size = 8 * math.ceil(max(8, GAMMA * len(left)) / 8)
            at = _bits(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").tobytes())
            left = left[~alone[at]]
        return levels

    def slots(self, words: np.ndarray) -> np.ndarray:
        out = np.full(len(words), -1, dtype=np.int64)
        left = np.arange(len(words))
        for k, level in enumerate(self.levels):
            if not len(left):
                break
            at = _bits(words[left], k, len(level))
            hit = level[at] == 1
            out[left[hit]] = self.first[k] + self.before[k][at[hit]]
            left = left[~hit]
        return out


def text_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text with each run of ASCII white space as one space; null: empty."""
    plain = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.unhex(F.sha2(plain, 256))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest) of every row."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       text_digest(F.col(text_col)).alias("digest"))


def classes(rows: DataFrame) -> DataFrame:
    """One row per distinct digest: its smallest id (null ids are passed over) and its rows."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"),
                                      F.count(F.lit(1)).alias("group_size"))


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards))


def write_index(history: DataFrame, path: str, shard_digests: int = SHARD_DIGESTS) -> None:
    """Write the index of ``history`` (digest, keep_id, group_size; digests distinct) to ``path``.

    The number of shards follows from the counted digests, and is at least one.
    """
    spark = history.sparkSession
    shards = max(1, math.ceil(history.count() / shard_digests))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, 1):
            for s, e in zip(*(x.tolist() for x in runs(t, 1)), strict=True):
                g = t.slice(s, e - s).combine_chunks()
                data = b"".join(g.column("digest").to_pylist())
                words = _words(data)
                levels = PerfectHash.build(words)
                order = np.argsort(PerfectHash(levels).slots(words))  # slot by slot
                g = g.take(pa.array(order))
                yield pa.RecordBatch.from_arrays(
                    [g.column("shard")[:1].combine_chunks(), pa.array([e - s], pa.int64()),
                     pa.array([levels], pa.list_(pa.binary())),
                     pa.array([words[order].tobytes()], pa.binary()),
                     pa.array([g.column("keep_id").to_pylist()], pa.list_(pa.int64())),
                     pa.array([g.column("group_size").to_pylist()], pa.list_(pa.int64()))],
                    names=["shard", "n", "levels", "digests", "winners", "copies"])

    dealt = history.select(_shard(shards).alias("shard"), "digest", "keep_id", "group_size")
    dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(build, INDEX).write.parquet(
        f"{path}/shards")
    spark.createDataFrame([(shards,)], "shards bigint").coalesce(1).write.parquet(f"{path}/size")


class _Shard:
    """One shard's slots while new digests are looked up in it."""

    def __init__(self, row: dict):
        self.hash = PerfectHash(row["levels"])
        self.words = _words(row["digests"])
        self.named = np.array([w is not None for w in row["winners"]], dtype=bool)
        self.winner = np.array([w or 0 for w in row["winners"]], dtype=np.int64)
        self.copies = np.array(row["copies"], dtype=np.int64)

    def absorb(self, words: np.ndarray, ids: np.ndarray, named: np.ndarray,
               copies: np.ndarray) -> np.ndarray:
        """Which digests are members (all bytes equal); their ids and rows go to their slots."""
        slot = self.hash.slots(words)
        member = slot >= 0
        member[member] = (self.words[slot[member]] == words[member]).all(axis=1)
        at = slot[member]
        np.add.at(self.copies, at, copies[member])
        for k, i in zip(at[named[member]].tolist(), ids[member & named].tolist(), strict=True):
            self.winner[k] = min(int(self.winner[k]), i) if self.named[k] else i
            self.named[k] = True
        return member

    def classes(self) -> pa.RecordBatch:
        data = self.words.tobytes()
        return _batch([data[32 * k:32 * k + 32] for k in range(len(self.copies))],
                      pa.array(self.winner, mask=~self.named), pa.array(self.copies), True)


def _batch(digest: list, keep: pa.Array, size: pa.Array, known: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(digest, pa.binary()), keep.cast(pa.int64()), size.cast(pa.int64()),
         pa.array([known] * len(digest), pa.bool_())],
        names=["digest", "keep_id", "group_size", "known"])


def look_up(spark: SparkSession, path: str, new: DataFrame, whole: bool = True) -> DataFrame:
    """Merge the classes ``new`` (distinct digests) into the index at ``path``.

    Returns one row per distinct digest: the smallest id and all rows of history and
    ``new`` together; ``known`` tells digests of the history. Without ``whole``
    slots that nothing new met are left out. Only one shard is held at a time, and
    new digests stream past it.
    """
    index = spark.read.schema(INDEX).parquet(f"{path}/shards")
    shards = spark.read.schema("shards bigint").parquet(f"{path}/size").first()[0]
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in index.schema.fields[1:]]
    asked = new.select(_shard(shards).alias("shard"), *none, F.lit(1).alias("kind"), "digest",
                       "keep_id", "group_size")
    rows = index.select("*", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("digest"),
                        F.lit(None).cast("bigint").alias("keep_id"),
                        F.lit(None).cast("bigint").alias("group_size")).unionByName(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, met = None, None, False
        for b in batches:
            at = np.flatnonzero(np.diff(b.column(0).to_numpy())) + 1
            for s, e in zip([0, *at], [*at, b.num_rows], strict=True):
                if e == s:
                    continue
                g = b.slice(s, e - s)
                if g.column(0)[0].as_py() != shard:
                    if held is not None and (whole or met):
                        yield held.classes()
                    shard, held, met = g.column(0)[0].as_py(), None, False
                if g.column(6)[0].as_py() == 0:
                    held = _Shard(g.slice(0, 1).to_pylist()[0])
                    g = g.slice(1)
                if not g.num_rows:
                    continue
                digest = g.column(7).to_pylist()
                if held is None:
                    member = np.zeros(len(digest), bool)
                else:
                    named = g.column(8).is_valid().to_numpy(zero_copy_only=False)
                    member = held.absorb(_words(b"".join(digest)),
                                         g.column(8).fill_null(0).to_numpy(), named,
                                         g.column(9).to_numpy())
                    met |= bool(member.any())
                alone = np.flatnonzero(~member)
                yield _batch([digest[k] for k in alone.tolist()], g.column(8).take(pa.array(alone)),
                             g.column(9).take(pa.array(alone)), False)
        if held is not None and (whole or met):
            yield held.classes()

    return rows.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(run, CLASSES)


def mark(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (doc_id, digest) with their class: doc_id, keep_id, group_size, kept, text_sha256.

    A group whose rows have no id at all keeps them (keep_id is null); a row
    without an id in a group that has one goes.
    """
    joined = join_groups(rows, found.select("digest", "keep_id", "group_size"), ["digest"],
                         "group_size", rows.count())
    return joined.select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def duplicates(history: DataFrame, docs: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", shard_digests: int = SHARD_DIGESTS) -> DataFrame:
    """Every row of ``history`` and ``docs`` with the row that stays of its equal texts.

    Texts are equal when identical after each run of ASCII white space became
    one space; a null text counts as empty, and is equal to an empty one. Of equal
    texts the smallest id stays, whichever side it is on; rows that share an id and
    a text are one document and share its answer. Null ids: see ``mark``. Other
    columns are left out; empty tables give no rows.
    """
    spark = docs.sparkSession
    own = [id_col, text_col]
    rows = write_table(
        digests(history.select(*own), *own).withColumn("old", F.lit(True)).unionByName(
            digests(docs.select(*own), *own).withColumn("old", F.lit(False))), "digests")
    path = shared_path(spark, "digest-index")
    write_index(write_table(classes(rows.where("old")), "history"), path, shard_digests)
    found = write_table(look_up(spark, path, classes(rows.where("not old"))), "classes")
    return mark(rows.select("doc_id", "digest"), found)
