"""Embedding near-duplicates by randomly rotated binary codes with correction factors.

A unit vector is turned by several random rotations; the signs of its
coordinates are its code, and for every rotation the inner product of the vector
with its own code is stored. For a code ``c`` of vector x with factor f and any
unit vector y, ``<c, y> / f`` estimates ``<x, y>`` without bias; its spread is
known, so a bound of several deviations tells which pairs can reach the
threshold. Only those are computed exactly, in double precision.

Pairs come from bands of 16 code bits, inside a label. The number of bands
follows from the threshold: a pair at it misses all bands with probability
1e-6. Equal vectors collapse first; a pair counts in its first common band only;
large buckets are dealt out as block pairs. Tasks return link counts and
spanning links, never pairs.
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
    runs,
    shared_ids,
    sorted_groups,
    write_table,
)
from eventcraft.llm.topk import usable

BAND_BITS = 16
MISS = 1e-6
#: deviations that a pair's estimate may lie below the threshold and still be recomputed
ERRORS = 6.0
BLOCK = 1024
#: buckets up to this size go through one vectorised pass with many others
SMALL = 16


def bands_for(threshold: float, miss: float = MISS) -> int:
    """Bands of BAND_BITS sign bits so that a pair at the threshold is missed so rarely."""
    same = (1 - math.acos(threshold) / math.pi) ** BAND_BITS
    return max(1, math.ceil(math.log(miss) / math.log1p(-same)))


def rotations(dim: int, bits: int, seed: int = 7) -> np.ndarray:
    """Random orthogonal matrices of ``dim``, side by side, with at least ``bits`` columns."""
    rng = np.random.default_rng([seed, dim])
    count = -(-bits // dim)
    return np.concatenate([np.linalg.qr(rng.standard_normal((dim, dim)))[0]
                           for _ in range(count)], axis=1)


class Coder:
    """Codes and factors of unit vectors of one length."""

    _made: dict[tuple[int, int], "Coder"] = {}

    def __init__(self, dim: int, bands: int):
        self.dim, self.bands = dim, bands
        self.turn = rotations(dim, bands * BAND_BITS)
        self.count = self.turn.shape[1] // dim
        self.width = self.turn.shape[1]

    @classmethod
    def of(cls, dim: int, bands: int) -> "Coder":
        if (dim, bands) not in cls._made:
            cls._made[dim, bands] = cls(dim, bands)
        return cls._made[dim, bands]

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the code of each row; its factors, one for each rotation."""
        y = unit @ self.turn
        code = np.packbits(y > 0, axis=1)
        factor = np.abs(y).reshape(len(unit), self.count, self.dim).sum(axis=2) / math.sqrt(
            self.dim)
        return code, factor

    def keys(self, code: np.ndarray) -> np.ndarray:
        """The bands of a code as 16-bit numbers."""
        return np.ascontiguousarray(code[:, :2 * self.bands]).view(np.uint16)

    def scaled(self, code: np.ndarray, factor: np.ndarray) -> np.ndarray:
        """Signs over factor: its product with a rotated vector is the mean estimate."""
        sign = np.unpackbits(code, axis=1, count=self.width).astype(np.float64) * 2 - 1
        per = np.repeat(factor, self.dim, axis=1) * math.sqrt(self.dim) * self.count
        return sign / per

    def spread(self, factor: np.ndarray) -> np.ndarray:
        """Deviation of the mean estimate by row, for any other unit vector."""
        f = np.clip(factor, 1e-6, 1.0)
        var = (1 - f * f) / (f * f) / max(1, self.dim - 1)
        return np.sqrt(var.sum(axis=1)) / self.count


CODED = ("label string, dim int, rep bigint, copies bigint, vector binary, code binary, "
         "factor binary, keys array<int>")


def _matrix(col: pa.Array, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=dtype).reshape(len(col), -1)


def _pairs(batches: Iterator[pa.RecordBatch], threshold: float,
           bands: int) -> Iterator[pa.RecordBatch]:
    """(kind, a, b) of buckets: 0: a has b more links; 1: a spanning link from a to b."""
    for t in sorted_groups(batches, 6):
        starts, ends = runs(t, 6)
        wide = ends - starts > 1
        starts, ends = starts[wide], ends[wide]
        if not len(starts):
            continue
        dims = t.column("dim").to_numpy()
        added: dict[int, int] = {}
        links: list[tuple[int, int]] = []
        for dim in np.unique(dims[starts]).tolist():
            own = dims[starts] == dim
            _bucket_pairs(t, starts[own], ends[own], Coder.of(dim, bands), threshold, added, links)
        kind = [0] * len(added) + [1] * len(links)
        a = [*added, *(x[0] for x in links)]
        b = [*added.values(), *(x[1] for x in links)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
            names=["kind", "a", "b"])


def _bucket_pairs(t: pa.Table, starts: np.ndarray, ends: np.ndarray, coder: Coder,
                  threshold: float, added: dict[int, int],
                  links: list[tuple[int, int]]) -> None:
    size = ends - starts
    rows = np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())
    t = t.take(pa.array(rows))
    ids, copies = t.column("rep").to_numpy(), t.column("copies").to_numpy()
    band, side = t.column("band").to_numpy(), t.column("side").to_numpy()
    same = t.column("i").to_numpy() == t.column("j").to_numpy()
    vec = _matrix(t.column("vector").combine_chunks(), np.float64)
    code = _matrix(t.column("code").combine_chunks(), np.uint8)
    factor = _matrix(t.column("factor").combine_chunks(), np.float64)
    keys = coder.keys(code)
    unit = vec / np.linalg.norm(vec, axis=1)[:, None]
    low = ERRORS * coder.spread(factor)
    ends = np.cumsum(size)
    starts = ends - size
    forest = Forest(len(ids))

    def exact(x: np.ndarray, y: np.ndarray) -> None:
        """Count and join the pairs that reach the threshold and have no earlier common band."""
        ok = ids[x] != ids[y]
        ok &= same[x] | (side[x] != side[y])
        x, y = x[ok], y[ok]
        cos = np.einsum("ij,ij->i", vec[x], vec[y]) / (
            np.sqrt(np.einsum("ij,ij->i", vec[x], vec[x]))
            * np.sqrt(np.einsum("ij,ij->i", vec[y], vec[y])))
        ok = cos >= threshold
        x, y = x[ok], y[ok]
        common = keys[x] == keys[y]
        first = common.argmax(axis=1) == band[x]
        for u, v in zip(x.tolist(), y.tolist(), strict=True):
            if forest.join(u, v):
                links.append((int(ids[u]), int(ids[v])))
        for u, v in zip(x[first].tolist(), y[first].tolist(), strict=True):
            a, b = int(ids[u]), int(ids[v])
            added[a] = added.get(a, 0) + int(copies[v])
            added[b] = added.get(b, 0) + int(copies[u])

    small = size <= SMALL
    last = np.repeat(ends, size)
    take = np.repeat(small, size)
    for lag in range(1, int(size[small].max(initial=1))):
        x = np.flatnonzero(take & (np.arange(len(ids)) + lag < last))
        for k in range(0, len(x), 4096):
            u = x[k:k + 4096]
            v = u + lag
            est = np.einsum("ij,ij->i", coder.scaled(code[u], factor[u]), unit[v] @ coder.turn)
            near = est >= threshold - low[u]
            exact(u[near], v[near])
    for s, e in zip(starts[~small].tolist(), ends[~small].tolist(), strict=True):
        turned = unit[s:e] @ coder.turn
        for k in range(s, e, 256):
            m = min(e, k + 256)
            est = coder.scaled(code[k:m], factor[k:m]) @ turned.T
            est[np.arange(s, e)[None, :] <= np.arange(k, m)[:, None]] = -np.inf
            x, y = np.nonzero(est >= threshold - low[k:m, None])
            for z in range(0, len(x), 1 << 16):
                exact(x[z:z + (1 << 16)] + k, y[z:z + (1 << 16)] + s)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str | None = "label", threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``.

    Two vectors link when they have equal non-null labels (any two where
    ``label_col`` is None), equal length, and a cosine of at least ``threshold``
    in double precision. Null vectors, zero vectors and those with null or
    non-finite components link with nothing. Rows that share an id are one
    vertex: identical ones count once, different ones link under that id, and
    all are returned. A row with a null id links with nothing, has a null
    component and is kept. Empty tables give no rows; other columns are left out.
    """
    bands = bands_for(threshold)
    label = F.lit("") if label_col is None else F.col(label_col).cast("string")
    d = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), label.alias("label"),
                       F.col(vector_col).cast("array<double>").alias("v"))
    good = d.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v"))
                   & F.exists("v", lambda x: x != 0))
    total = d.count()
    classes = good.groupBy("label", "v").agg(
        F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim in np.unique(b.column(1).to_numpy()).tolist():
                own = b.filter(pa.compute.equal(b.column(1), dim))
                coder = Coder.of(dim, bands)
                vec = own.column(4).flatten().to_numpy().reshape(-1, dim)
                # a power of two brings very large and very small values into range
                vec = np.ldexp(vec, -np.frexp(np.abs(vec).max(axis=1))[1][:, None])
                c, f = coder.encode(vec / np.linalg.norm(vec, axis=1)[:, None])
                keys = coder.keys(c).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    *(own.column(k) for k in range(4)),
                    pa.array([x.tobytes() for x in vec], pa.binary()),
                    pa.array([x.tobytes() for x in c], pa.binary()),
                    pa.array([x.tobytes() for x in f], pa.binary()),
                    pa.array(list(keys), pa.list_(pa.int32()))],
                    names=["label", "dim", "rep", "copies", "vector", "code", "factor", "keys"])

    coded = write_table(classes.select("label", F.size("v").alias("dim"), "rep", "copies", "v")
                        .mapInArrow(code, CODED), "codes")
    bucket = ["label", "dim", "band", "key"]
    banded = coded.select("rep", "label", "dim", F.posexplode("keys").alias("band", "key"))
    sizes = banded.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn(
        "blocks", F.ceil(F.col("n") / BLOCK))
    dealt = block_pairs(join_groups(banded, sizes, bucket, "n", total * bands), "blocks",
                        F.xxhash64("rep", F.lit(3)))
    rows = dealt.select(*bucket, "i", "j", "side", "rep").join(
        coded.select("rep", "label", "dim", "copies", "vector", "code", "factor"),
        ["rep", "label", "dim"])
    keys = [F.xxhash64("label").alias("label_key"), "dim", "band", "key", "i", "j"]
    out = write_table(
        rows.select(*keys, "side", "rep", "copies", "vector", "code", "factor").repartition(
            "label_key", "dim", "band", "key", "i", "j").sortWithinPartitions(
            "label_key", "dim", "band", "key", "i", "j", "rep").mapInArrow(
            lambda it: _pairs(it, threshold, bands), "kind int, a bigint, b bigint"), "links")
    more = out.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("more"))
    own = good.withColumn("h1", F.xxhash64("label", "v")).withColumn(
        "h2", F.xxhash64("v", F.lit(17), "label")).select("vec_id", "h1", "h2")
    hashed = classes.select("rep", F.xxhash64("label", "v").alias("h1"),
                            F.xxhash64("v", F.lit(17), "label").alias("h2"), "copies")
    # an id in several classes is still one vertex
    found = connected(out.where("kind = 1").select("a", "b").unionByName(shared_ids(
        own, hashed, "vec_id", ["h1", "h2"], total)))
    found = found.withColumnRenamed("id", "rep")

    # a class's links and component, carried to its members
    info = coded.select("rep", "copies").join(more, "rep", "left").join(found, "rep", "left")
    info = info.groupBy("rep").agg(F.max("copies").alias("copies"), F.max("more").alias("more"),
                                   F.min("component").alias("component"))
    member = join_groups(own, hashed.join(info.drop("copies"), "rep"), ["h1", "h2"], "copies", total)
    member = member.groupBy("vec_id").agg(
        F.max(F.coalesce("more", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.min(F.coalesce("component", "rep")).alias("component_id"))
    out = d.select("vec_id").join(member, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"),
                                             F.lit(True)))
