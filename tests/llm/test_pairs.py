import itertools

import numpy as np
import pytest

from eventcraft.llm import embed, minhash, topk
from eventcraft.llm.common import connected


def components(ids, links):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_connected(spark):
    links = [(1, 2), (3, 2), (7, 8), (9, 8), (9, 4), (20, 20), (5, 6), *((30, k) for k in
                                                                        range(31, 90))]
    e = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.id: r.component for r in connected(e).collect()}
    want = components({x for p in links for x in p}, links)
    assert got == {k: v for k, v in want.items() if k != 20}
    assert connected(e.where("false")).count() == 0


@pytest.mark.parametrize("task_edges", [0, 1 << 20])
def test_connected_by_stars_and_in_one_task(spark, task_edges):
    r = np.random.default_rng(8)
    links = [(int(a), int(b)) for a, b in r.integers(0, 3000, size=(2000, 2))] + [
        (k, k + 1) for k in range(5000, 5200)] + [(9000, k) for k in range(9001, 9400)]
    e = spark.createDataFrame(links, "a bigint, b bigint").repartition(6)
    got = {r.id: r.component for r in connected(e, task_edges=task_edges).collect()}
    want = components({x for p in links for x in p}, links)
    own = {a for p in links if p[0] != p[1] for a in p}
    assert got == {k: v for k, v in want.items() if k in own}


def test_an_id_in_two_classes_is_one_vertex(spark):
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six seven"
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (9, b), (11, "other words here")],
                                 "doc_id bigint, text string")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert got == [(3, 3, True), (5, 3, False), (5, 3, False), (9, 3, False), (11, 11, True)]
    vectors = spark.createDataFrame(
        [(3, "x", [1.0, 0.0]), (5, "x", [1.0, 0.0]), (5, "x", [0.0, 1.0]), (9, "x", [0.0, 1.0])],
        "vec_id bigint, label string, embedding array<double>")
    got = sorted((r.vec_id, r.component_id) for r in embed.near_duplicates(vectors).collect())
    assert got == [(3, 3), (5, 3), (5, 3), (9, 3)]


def test_the_last_plan_repeats_no_earlier_step(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x y z u v w"), (3, "o p")],
                                 "doc_id bigint, text string")
    plan = minhash.near_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    # what is left joins the documents to their stored classes, hot ones by broadcast
    assert plan.count("Exchange") <= 8 and plan.count("HashAggregate") == 0


def near_texts(n=60, seed=3):
    r = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(400)]
    base = [list(r.choice(words, 120)) for _ in range(4)]
    rows = []
    for k in range(n):
        t = list(base[k % 4])
        for _ in range(int(r.integers(0, 4))):
            t[int(r.integers(0, len(t)))] = str(r.choice(words))
        rows.append((k, " ".join(t).upper() if k % 7 == 0 else " \n".join(t)))
    return rows


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else (
        {tuple(w)} if w else set())


def brute(rows, num=85, den=100):
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and den * len(
        sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    comp = components(sets, links)
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}


@pytest.mark.parametrize("bucket,group", [(2048, 512), (8, 5)])
def test_minhash_equals_brute_force(spark, monkeypatch, bucket, group):
    """Also with tiny blocks, so that buckets and groups are dealt out as block pairs."""
    monkeypatch.setattr(minhash, "BUCKET_BLOCK", bucket)
    monkeypatch.setattr(minhash, "GROUP_BLOCK", group)
    rows = [*near_texts(), (100, None), (101, ""), (102, "two words"), (103, "Two  WORDS"),
            (104, "two other"), (105, " \t")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in minhash.near_duplicates(d).collect()}
    assert got == brute(rows)


def test_bands_follow_from_the_threshold(spark):
    for t in (0.05, 0.3, 0.5, 0.7, 0.8, 0.85, 0.95, 1.0):
        bands, rows = minhash.bands_for(t)
        assert (1 - t ** rows) ** bands <= minhash.MISS
        assert bands * rows <= minhash.MINIMA or rows == 1
    assert minhash.bands_for(0.85) == (25, 5)
    rows = near_texts()
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    for num in (5, 50):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
               for r in minhash.near_duplicates(d, num=num).collect()}
        assert got == brute(rows, num)


def test_minhash_edges(spark, ugly, empty):
    got = minhash.near_duplicates(ugly).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == 13 and by[1][0].kept and not by[2][0].kept and by[2][0].component_id == 1
    assert all(r.kept and r.component_id is None for r in by[None])
    assert [r.n_shingles for r in by[3] + by[4] + by[5]] == [0, 0, 0]
    assert len(by[7]) == 2 and {r.component_id for r in by[7]} == {7}
    assert minhash.near_duplicates(empty).count() == 0


def test_b_bit_estimate_is_unbiased():
    r = np.random.default_rng(5)
    for share in (0.5, 0.85):
        got = []
        for _ in range(60):
            pool = r.integers(0, 1 << 63, size=400, dtype=np.uint64)
            both = int(400 * share)
            half = (400 - both) // 2
            a, b = pool[:both + half], np.concatenate([pool[:both], pool[both + half:]])
            x, y = (np.frombuffer(minhash.low_bits(minhash.minima(s)), np.uint64) for s in (a, b))
            got.append(minhash.similarity(x, y))
        assert abs(np.mean(got) - share) < 0.03


def test_rotated_codes_estimate_without_bias():
    r = np.random.default_rng(2)
    coder = embed.Coder.of(48, 10)
    x = r.standard_normal((3000, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = x + 0.1 * r.standard_normal(x.shape)
    y /= np.linalg.norm(y, axis=1)[:, None]
    code, factor = coder.encode(x)
    est = np.einsum("ij,ij->i", coder.scaled(code, factor), y @ coder.turn)
    true = np.einsum("ij,ij->i", x, y)
    assert abs((est - true).mean()) < 0.01
    assert (est >= true - embed.ERRORS * coder.spread(factor)).all()


def vectors(seed=1, n=120, dim=12):
    r = np.random.default_rng(seed)
    base = r.standard_normal((6, dim))
    rows = []
    for k in range(n):
        v = base[k % 6] + r.standard_normal(dim) * (0.0 if k % 10 == 0 else 0.09)
        rows.append((k, [float(x) for x in v.astype(np.float32)], k % 2 if k % 11 else None))
    return rows


@pytest.mark.parametrize("block,small", [(1024, 16), (8, 4)])
def test_embeddings_equal_brute_force(spark, monkeypatch, block, small):
    monkeypatch.setattr(embed, "BLOCK", block)
    monkeypatch.setattr(embed, "SMALL", small)
    bad = [(200, None, 0), (201, [0.0] * 12, 0), (202, [float("nan")] + [1.0] * 11, 0),
           (203, [None] + [1.0] * 11, 0), (204, [1.0, 2.0], 0), (205, [2.0, 4.0], 0), (206, [], 0),
           (207, [float("inf")] * 12, 0)]
    rows = [*vectors(), *bad]
    d = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    ok = {i: (np.array(v), g) for i, v, g in rows if v and g is not None and all(
        x is not None and np.isfinite(x) for x in v) and any(v)}
    links = [(a, b) for a, b in itertools.combinations(ok, 2) if ok[a][1] == ok[b][1]
             and len(ok[a][0]) == len(ok[b][0]) and ok[a][0] @ ok[b][0]
             >= 0.98 * np.linalg.norm(ok[a][0]) * np.linalg.norm(ok[b][0])]
    comp = components([r[0] for r in rows], links)
    n = {i: sum(i in p for p in links) for i, _, _ in rows}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept)
           for r in embed.near_duplicates(d).collect()}
    assert len(links) > 100
    assert got == {i: (n[i], comp[i], comp[i] == i) for i in comp}


def test_embedding_edges(spark):
    schema = "vec_id bigint, embedding array<float>, label int, n_links int, rep string"
    rows = [(1, [1.0, 0.0], 0, 9, "a"), (1, [1.0, 0.0], 0, 9, "a"), (2, [1.0, 0.0], 0, 9, "b"),
            (None, [1.0, 0.0], 0, 9, "c")]
    d = spark.createDataFrame(rows, schema)
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept)
                 for r in embed.near_duplicates(d).collect())
    assert got == [(0, 0, None, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False)]
    assert embed.near_duplicates(d.where("false")).count() == 0


@pytest.mark.parametrize("blocks", [(4096, 1024), (16, 3)])
def test_top_k_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[1])
    r = np.random.default_rng(4)
    rows = [(k, [int(x) for x in r.integers(-9, 10, size=6)]) for k in range(150)]
    rows += [(150, [0] * 6), (151, [2, 1]), (152, [3, 1]), (153, None), (None, [1] * 6),
             (154, [None] * 6), (155, [10 ** 9] * 6)]
    d = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>")
    ok = {i: v for i, v in rows if i is not None and v and None not in v}
    want = []
    for q in (i for i in ok if i % 10 == 0 or i > 150):
        s = sorted((-sum(x * y for x, y in zip(ok[q], v, strict=True)), i)
                   for i, v in ok.items() if i != q and len(v) == len(ok[q]))[:5]
        want += [(q, k + 1, i, -x) for k, (x, i) in enumerate(s)]
    got = topk.top_k(d, d.where("vec_id % 10 = 0 or vec_id > 150"), 5).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(d.where("false"), d, 5).count() == 0


def test_threshold_walk_stops_early():
    v = np.zeros((4096, 4))
    v[:, 0] = np.arange(4096)
    best, score, depth = topk.SortedLists(np.arange(4096), v).top(np.array([1.0, 0, 0, 0]), -1, 5)
    assert score.tolist() == [4095, 4094, 4093, 4092, 4091] and depth <= 32
