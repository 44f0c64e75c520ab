"""b-bit MinHash near-duplicates of word-shingle sets, confirmed on the whole sets.

1. Each document gives the distinct hashes of its 5-word shingles, 128 minima,
   band keys of up to 5 minima each, and the low 2 bits of every minimum packed
   into 32 bytes. Equal sets collapse into one class by a fingerprint.
2. Class representatives that share a band key are compared by bit counts of
   their packed signatures; the share of equal 2-bit values, corrected for
   chance matches, estimates the similarity. Pairs within five standard errors
   of the threshold (or above) join the same coarse group.
3. Inside a coarse group pairs are confirmed on full shingle sets, the likeliest
   first; pairs that confirmed links already connect are left out.
4. Components of confirmed links, carried back to every copy.

Only spanning links leave a task, never a group's pairs. Buckets and coarse
groups beyond a block's size are dealt out as block pairs. Bands follow from the
threshold: a pair at it misses all of them with a probability of at most MISS
(0.85: 25 bands of 5 minima, 4e-7; 0.8: 28 bands of 4, 4e-7).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcraft.llm.common import (
    Forest,
    block_pairs,
    connected,
    join_groups,
    lean,
    mix64,
    runs,
    shared_ids,
    slices,
    sorted_groups,
    text_bytes,
    unite,
    word_hashes,
    word_spans,
    write_table,
)

WORDS, ROWS, MINIMA = 5, 5, 128
#: a pair at the threshold shares no band at most this often
MISS = 5e-7
#: rows of a bucket, documents and shingles of a coarse group that meet as one block
BUCKET_BLOCK, GROUP_BLOCK, SHINGLE_BLOCK = 2048, 512, 1 << 20
#: ids that may be broadcast to pick the texts of coarse groups (16 bytes each)
BROADCAST_IDS = 1_000_000

_RNG = np.random.default_rng(20240607)
_A = _RNG.integers(1, 1 << 63, size=MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, size=MINIMA, dtype=np.uint64)
_C = _RNG.integers(1, 1 << 63, size=max(WORDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_EVEN = np.uint64(0x5555555555555555)


def bands_for(threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Bands and minima a band, so that a pair at the threshold is missed so rarely.

    The most minima a band, up to ROWS, whose bands fit in MINIMA; bands of a single
    minimum take as many as they need.
    """
    for rows in range(ROWS, 0, -1):
        same = threshold ** rows
        bands = 1 if same >= 1 else math.ceil(math.log(miss) / math.log1p(-same))
        if bands * rows <= MINIMA:
            break
    return bands, rows


def _family(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands of at least MINIMA hash functions."""
    if count <= MINIMA:
        return _A, _B
    rng = np.random.default_rng([20240607, 1])
    a = rng.integers(1, 1 << 63, size=count - MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, size=count - MINIMA, dtype=np.uint64)
    return np.concatenate([_A, a]), np.concatenate([_B, b])


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row of UTF-8 texts."""
    starts, ends, first = word_spans(data, offsets)
    with np.errstate(over="ignore"):
        h = word_hashes(data, starts, ends)
        n = len(h) - WORDS + 1
        full = sum((h[k:k + n] * _C[k] for k in range(WORDS)), np.uint64(WORDS)) if n > 0 else h[:0]
        full = mix64(full)
        out = []
        for s, e in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if e - s >= WORDS:
                out.append(np.unique(full[s:e - WORDS + 1]))
            elif e > s:
                out.append(mix64((h[s:e] * _C[:e - s]).sum(keepdims=True, dtype=np.uint64)
                                 + np.uint64(e - s)))
            else:
                out.append(h[:0])
    return out


def minima(shingles: np.ndarray, count: int = MINIMA) -> np.ndarray:
    """The least value of each hash function over a shingle set."""
    a, b = _family(count)
    low = np.full(len(a), np.uint64(0xFFFFFFFFFFFFFFFF))
    with np.errstate(over="ignore"):
        for k in range(0, len(shingles), 1024):
            v = shingles[k:k + 1024, None] * a
            v += b
            np.minimum(low, v.min(axis=0), out=low)
    return mix64(low)


def low_bits(values: np.ndarray) -> bytes:
    """The low two bits of each of the first MINIMA minima, packed."""
    two = (values[:MINIMA] & np.uint64(3)).reshape(-1, 32)
    shift = np.arange(0, 64, 2, dtype=np.uint64)
    return np.bitwise_or.reduce(two << shift, axis=1).tobytes()


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        v = values[:bands * rows].reshape(bands, rows) * _C[:rows]
        return mix64(v.sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(
            np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of packed signatures (last axis: words), corrected for chance."""
    x = a ^ b
    differ = np.bitwise_count((x | (x >> np.uint64(1))) & _EVEN).sum(axis=-1, dtype=np.int64)
    return (1 - differ / MINIMA - 0.25) / 0.75


def least_estimate(threshold: float, errors: float = 5.0) -> float:
    """The threshold less so many standard errors of the estimate."""
    m = threshold + (1 - threshold) / 4
    return threshold - errors * math.sqrt(m * (1 - m) / MINIMA) / 0.75


SIGNATURES = ("doc_id bigint, n_shingles bigint, print1 bigint, print2 bigint, "
              "keys array<bigint>, low binary")
SETS = "doc_id bigint, shingles binary, low binary"


def signatures(docs: DataFrame, bands: int, rows: int, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Set size, set fingerprint, band keys and packed low bits of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            n, p1, p2, keys, low = [], [], [], [], []
            for s in shingle_sets(*text_bytes(b.column(1))):
                n.append(len(s))
                if not len(s):
                    p1.append(0), p2.append(0), keys.append(None), low.append(None)
                    continue
                p1.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                p2.append(int(np.bitwise_xor.reduce(mix64(s)).view(np.int64)))
                m = minima(s, bands * rows)
                keys.append(band_keys(m, bands, rows))
                low.append(low_bits(m))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(p1, pa.int64()),
                 pa.array(p2, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(low, pa.binary())],
                names=["doc_id", "n_shingles", "print1", "print2", "keys", "low"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), SIGNATURES)


def _words(col: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=np.uint64).reshape(len(col), -1)


def _near(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Spanning links of the estimated-near pairs of each bucket (key, i, j, doc_id, side, low)."""
    for t in sorted_groups(batches, 3):
        starts, ends = runs(t, 3)
        wide = ends - starts > 1
        starts, ends = starts[wide], ends[wide]
        if not len(starts):
            continue
        size = ends - starts
        rows = np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())
        t = t.take(pa.array(rows))
        ids, side = t.column("doc_id").to_numpy(), t.column("side").to_numpy()
        i, j = t.column("i").to_numpy(), t.column("j").to_numpy()
        low = _words(t.column("low"))
        starts = np.cumsum(size) - size
        hub = np.repeat(starts, size)
        near = similarity(low, low[hub]) >= least
        near &= (i == j) | (side != side[hub])
        links = {(x, y) for x, y in zip(ids[near].tolist(), ids[hub[near]].tolist(), strict=True)
                 if x != y}
        left = np.add.reduceat((~near).astype(np.int64), starts)
        for s, n in zip(starts[left > 0].tolist(), size[left > 0].tolist(), strict=True):
            if n < 3 and i[s] == j[s]:
                continue
            links |= _bucket(ids[s:s + n], side[s:s + n], low[s:s + n], i[s] == j[s], least)
        if links:
            a, b = zip(*links, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             names=["a", "b"])


def _bucket(ids: np.ndarray, side: np.ndarray, low: np.ndarray, same: bool,
            least: float) -> set[tuple[int, int]]:
    forest, links = Forest(len(ids)), set()
    left = np.arange(len(ids)) if same else np.flatnonzero(side == 0)
    right = left if same else np.flatnonzero(side == 1)
    for k in range(0, len(left), 256):
        part = left[k:k + 256]
        x, y = np.nonzero(similarity(low[part][:, None, :], low[right][None, :, :]) >= least)
        for u, v in zip(part[x].tolist(), right[y].tolist(), strict=True):
            if u != v and forest.join(u, v):
                links.add((int(ids[u]), int(ids[v])))
    return links


def _confirm(batches: Iterator[pa.RecordBatch], num: int, den: int,
             least: float) -> Iterator[pa.RecordBatch]:
    """Spanning confirmed links of each coarse group (component, i, j, doc_id, side, sets)."""
    for t in sorted_groups(batches, 3):
        out = []
        for s, e in zip(*(x.tolist() for x in runs(t, 3)), strict=True):
            g = t.slice(s, e - s)
            ids, side = g.column("doc_id").to_numpy(), g.column("side").to_numpy()
            low = _words(g.column("low"))
            sets = [np.frombuffer(x, dtype=np.uint64) for x in g.column("shingles").to_pylist()]
            size = np.array([len(x) for x in sets])
            same = g.column("i")[0] == g.column("j")[0]
            left = np.arange(len(ids)) if same else np.flatnonzero(side == 0)
            right = left if same else np.flatnonzero(side == 1)
            if not len(left) or not len(right):
                continue
            est = similarity(low[left][:, None, :], low[right][None, :, :])
            n, m = size[left][:, None], size[right][None, :]
            est[(den * np.minimum(n, m) < num * np.maximum(n, m)) | (est < least)] = -1
            if same:
                est[np.tril_indices(len(ids))] = -1
            x, y = np.nonzero(est >= least)
            order = np.argsort(-est[x, y], kind="stable")
            forest = Forest(len(ids))
            for u, v in zip(left[x[order]].tolist(), right[y[order]].tolist(), strict=True):
                if forest.root(u) == forest.root(v):
                    continue
                both = np.concatenate((sets[u], sets[v]))
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                if den * common >= num * (len(both) - common):
                    forest.join(u, v)
                    out.append((int(ids[u]), int(ids[v])))
        if out:
            a, b = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             names=["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Documents link when ``den * |intersection| >= num * |union|`` of their
    distinct 5-word shingles (words are lower-cased A-Z runs without ASCII
    white space; fewer than five words: one shingle of all of them). A text that
    is null, empty or has no word links with nothing. Rows that share an id are
    one vertex and all are returned; a row with a null id links with nothing,
    has a null component and is kept. Other columns are left out; an empty
    table gives no rows.
    """
    if not 0 < num <= den:
        raise ValueError("the threshold must be above 0 and at most 1")
    spark = docs.sparkSession
    least = least_estimate(num / den)
    sig = write_table(signatures(docs, *bands_for(num / den), id_col, text_col), "signatures")
    real = sig.where("doc_id is not null and n_shingles > 0")
    total = sig.count()
    # what several plans read is stored: plans that repeat it keep many more stages, tasks and
    # broadcasts in the driver's memory at once
    prints = ["print1", "print2", "n_shingles"]
    classes = real.groupBy(*prints).agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")).checkpoint()
    own = write_table(real.join(
        classes.select("print1", "print2", F.col("rep").alias("doc_id")),
        ["doc_id", "print1", "print2"]).select("doc_id", "n_shingles", "keys", "low"), "classes")

    # buckets: (band key) -> representatives; large ones as block pairs
    banded = own.select("doc_id", "low", F.explode("keys").alias("key"))
    large = own.select(F.explode("keys").alias("key")).groupBy("key").count().where(
        F.col("count") > BUCKET_BLOCK).select(
        "key", F.ceil(F.col("count") / BUCKET_BLOCK).alias("blocks")).checkpoint()
    few = large.count() <= 100_000
    banded = banded.join(F.broadcast(large) if few else large, "key", "left")
    banded = block_pairs(banded.withColumn("blocks", F.coalesce("blocks", F.lit(1))), "blocks",
                         F.xxhash64("doc_id"))
    near = banded.select("key", "i", "j", "doc_id", "side", "low").repartition(
        "key", "i", "j").sortWithinPartitions("key", "i", "j", "doc_id").mapInArrow(
        lean(lambda it: unite(_near(it, least))), "a bigint, b bigint")
    coarse = connected(near, united=True).checkpoint()

    # coarse groups: the whole shingle sets of their members meet
    member = own.select("doc_id", "n_shingles").join(
        coarse.withColumnRenamed("id", "doc_id"), "doc_id").checkpoint()
    sizes = member.groupBy("component").agg(
        F.count(F.lit(1)).alias("n"), F.greatest(
            F.ceil(F.count(F.lit(1)) / GROUP_BLOCK),
            F.ceil(F.sum("n_shingles") / SHINGLE_BLOCK)).alias("blocks")).checkpoint()
    member = join_groups(member.select("doc_id", "component"), sizes, ["component"], "n",
                         total).checkpoint()
    picked = member.select("doc_id")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(picked) if member.count() <= BROADCAST_IDS else picked, "doc_id", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = shingle_sets(*text_bytes(b.column(1)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x.tobytes() for x in found], pa.binary()),
                 pa.array([low_bits(minima(x)) for x in found], pa.binary())],
                names=["doc_id", "shingles", "low"])

    group = block_pairs(texts.mapInArrow(lean(sets), SETS).join(member, "doc_id"), "blocks",
                        F.xxhash64("doc_id"))
    links = group.select("component", "i", "j", "doc_id", "side", "shingles", "low").repartition(
        "component", "i", "j").sortWithinPartitions("component", "i", "j", "doc_id").mapInArrow(
        lean(lambda it: unite(_confirm(it, num, den, least))), "a bigint, b bigint")
    # an id in several classes is still one vertex
    found = connected(links.unionByName(shared_ids(
        real.select("doc_id", *prints), classes, "doc_id", prints, total)), united=True)

    classes = classes.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        *prints, "copies", F.coalesce("component", "rep").alias("component_id")).checkpoint()
    linked = join_groups(real.select("doc_id", *prints), classes, prints, "copies", total).select(
        "doc_id", "n_shingles", "component_id")
    alone = sig.where("doc_id is null or n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
