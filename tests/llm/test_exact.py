import hashlib
import re

import numpy as np
import pytest

from eventcraft.llm import exact
from eventcraft.llm.queries import QUERIES
from eventcraft.llm.common import shared_path


def brute(rows):
    groups = {}
    plain = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    for (i, _), t in zip(rows, plain, strict=True):
        groups.setdefault(t, []).append(i)
    out = []
    for (i, _), t in zip(rows, plain, strict=True):
        keep = min((x for x in groups[t] if x is not None), default=None)
        out.append((i, keep, len(groups[t]), keep is None or i == keep,
                    hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept",
                                       "text_sha256").collect()), key=str)


def test_perfect_hash_is_one_to_one():
    words = np.random.default_rng(1).integers(0, 1 << 63, size=(5000, 4), dtype=np.uint64)
    for n in (0, 1, 2, 5000):
        h = exact.PerfectHash(exact.PerfectHash.build(words[:n]))
        assert sorted(h.slots(words[:n]).tolist()) == list(range(n))
    assert (h.slots(~words) < 5000).all()  # strangers get any slot or none


def test_strangers_are_told_apart_by_their_bytes():
    words = np.arange(4 * 64, dtype=np.uint64).reshape(-1, 4)
    levels = exact.PerfectHash.build(words)
    order = np.argsort(exact.PerfectHash(levels).slots(words))
    shard = exact._Shard({"levels": levels, "digests": words[order].tobytes(),
                          "winners": [None] * 64, "copies": [1] * 64})
    other = words.copy()
    other[:, 3] += 1
    ask = np.concatenate([words[:10], other])
    n = len(ask)
    member = shard.absorb(ask, np.arange(n), np.ones(n, bool), np.ones(n, np.int64))
    assert member.tolist() == [True] * 10 + [False] * 64
    assert shard.copies.sum() == 74 and shard.named.sum() == 10


@pytest.mark.parametrize("share", [0, 1, 2, 3])
def test_duplicates_equal_brute_force(spark, ugly, share):
    r = np.random.default_rng(5)
    rows = [(int(i), f"text  {int(r.integers(0, 40))}\n" + " " * int(r.integers(0, 3)))
            for i in r.permutation(300)] + [(1000 + i, "hot text") for i in range(2500)]
    rows += [(x.doc_id, x.text) for x in ugly.select("doc_id", "text").collect()]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)],
                               "doc_id bigint, text string, k int")
    old = [df.where("false"), df.where("k % 2 = 0"), df.where("k % 3 > 0"), df][share]
    new = [df, df.where("k % 2 = 1"), df.where("k % 3 = 0"), df.where("false")][share]
    assert found(exact.duplicates(old, new, shard_digests=16)) == brute(rows)


def test_index_of_a_history_serves_later_batches(spark):
    def make(rows):
        return exact.classes(exact.digests(spark.createDataFrame(rows, "doc_id bigint, text string")))
    path = shared_path(spark, "test-index")
    exact.write_index(make([(5, "a b"), (9, "a  b"), (7, "c")]), path, 1)
    out = {(r.keep_id, r.group_size, r.known) for r in exact.look_up(
        spark, path, make([(3, "a\tb"), (11, "d"), (12, "d")])).collect()}
    assert out == {(3, 3, True), (7, 1, True), (11, 2, False)}
    met = exact.look_up(spark, path, make([(3, "a\tb")]), whole=False).collect()
    assert (3, 3, True) in {(r.keep_id, r.group_size, r.known) for r in met}


def test_empty(empty):
    assert exact.duplicates(empty, empty).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(QUERIES["op11_exact_dedup"](spark, sf)) == brute(rows)
