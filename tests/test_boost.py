import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventcraft.operators import boost
from eventcraft.operators.evaluate import auc


def rows(n=4000, seed=2):
    r = np.random.default_rng(seed)
    out = []
    for i in range(n):
        a, c = r.normal(), int(r.integers(0, 12))
        y = int((a > 0.3) != (c in (1, 4, 6, 9))) if r.random() > 0.1 else int(r.integers(0, 2))
        out.append((i, None if i % 17 == 0 else float(a), float(r.normal()),
                    None if i % 29 == 0 else f"c{c}", y, i % 3))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        rows(), "row_id bigint, a double, b double, c string, y int, fold int").repartition(5)


def brute_split(hist, p, numbers):
    """Every cut of numbers with nulls on either side, every set of a category's bins."""
    best = -np.inf
    g, h, n = hist[0].sum(axis=0)

    def gain(left):
        lg, lh, ln = left
        if ln < max(1, p.min_rows) or n - ln < max(1, p.min_rows):
            return -np.inf
        return lg ** 2 / (lh + p.l2) + (g - lg) ** 2 / (h - lh + p.l2) - g ** 2 / (h + p.l2)
    for f in range(len(hist)):
        bins = range(hist.shape[1])
        if f < numbers:
            sets = [s for k in range(1, len(bins)) for s in (list(bins[:k]), list(bins[1:k + 1]))]
        else:
            sets = [list(s) for k in range(1, len(bins)) for s in itertools.combinations(bins, k)]
        for s in sets:
            best = max(best, gain(hist[f, s].sum(axis=0)))
    return best


def test_split_equals_brute_force():
    r = np.random.default_rng(0)
    for k in range(40):
        hist = np.abs(r.normal(size=(3, 7, 3)))
        hist[..., 0] = r.normal(size=(3, 7))
        hist[..., 2] = r.integers(0, 20, size=(3, 7))
        hist[hist[..., 2] == 0] = 0
        hist[1:, 0] += hist[0].sum(axis=0) - hist[1:].sum(axis=1)  # the same rows under each feature
        hist[..., 1] = np.abs(hist[..., 1]) + hist[..., 2] * 0.1
        hist[1:, 0, 1:] += hist[0].sum(axis=0)[1:] - hist[1:].sum(axis=1)[:, 1:]
        if (hist[..., 1] < 0).any() or (hist[..., 2] < 0).any():
            continue
        p = boost.Params(min_rows=1, l2=0.0 if k % 2 else 1.0, min_gain=-1.0)
        got = boost.best_split(hist, p, 2)
        assert got is not None
        left = hist[got[1], got[2]].sum(axis=0)
        total = hist[0].sum(axis=0)
        right = total - left
        assert got[0] == pytest.approx(left[0] ** 2 / (left[1] + p.l2) + right[0] ** 2 / (
            right[1] + p.l2) - total[0] ** 2 / (total[1] + p.l2))
        if p.l2 == 0:  # the sorted order of categories is the best one without the penalty
            assert got[0] == pytest.approx(brute_split(hist, p, 2))
        numbers = boost.best_split(hist[:2], p, 2)
        assert numbers[0] == pytest.approx(brute_split(hist[:2], p, 2))


def grow_one_by_one(x, y, p, numbers, size):
    """A tree by one best split at a time, histograms counted afresh for every leaf."""
    base = np.log(y.mean() / (1 - y.mean()))
    prob = 1 / (1 + np.exp(-base))
    g, h = prob - y, np.full(len(y), prob * (1 - prob))

    def hist(at):
        out = np.zeros((len(x), size, 3))
        for f in range(len(x)):
            for k, w in enumerate((g, h, np.ones(len(y)))):
                out[f, :, k] = np.bincount(x[f, at], w[at], size)
        return out
    leaves = [(np.arange(len(y)), boost.best_split(hist(np.arange(len(y))), p, numbers))]
    gains = []
    while len(leaves) < p.leaves and any(s for _, s in leaves):
        k = max(range(len(leaves)), key=lambda i: leaves[i][1][0] if leaves[i][1] else -1)
        at, s = leaves.pop(k)
        gains.append(s[0])
        go = np.isin(x[s[1], at], s[2])
        leaves += [(part, boost.best_split(hist(part), p, numbers)) for part in (at[go], at[~go])]
    return sorted(gains), sorted(len(a) for a, _ in leaves)


def test_first_tree_equals_one_split_at_a_time(spark, frame):
    bins = boost.fit_bins(frame, ["a", "b"], ["c"], size=16)
    p = boost.Params(rounds=1, leaves=9, min_rows=30)
    fit = boost.start(frame, bins, "y", "row_id", [(p, -1, 0)])
    tree = fit.run()[0].trees[0]
    pdf = frame.orderBy("row_id").toPandas()
    import pyarrow as pa
    x = bins.encode([pa.array(pdf["a"], from_pandas=True), pa.array(pdf["b"], from_pandas=True),
                     pa.array(pdf["c"], pa.string(), from_pandas=True)])
    gains, sizes = grow_one_by_one(x, pdf["y"].to_numpy().astype(float), p, 2, 16)
    assert sorted(v for v in tree.gain if v) == pytest.approx(gains)
    assert sorted(c for c, f in zip(tree.cover, tree.feature, strict=True) if f < 0) == sizes
    assert fit.scans <= 1 + 8 + 1
    # L4: total gain is the sum over the splits' rows of the node table
    nodes = boost.node_table(spark, fit)
    want = {}
    for f, v in zip(tree.feature, tree.gain, strict=True):
        if f >= 0:
            want[bins.names[f]] = want.get(bins.names[f], 0) + v
    assert {r.feature: r.gain for r in boost.total_gain(nodes).collect()} == pytest.approx(want)


def test_planted_set_of_categories_is_found(frame):
    bins = boost.fit_bins(frame, ["a", "b"], ["c"], size=16)
    only = boost.Bins([], ["c"], [], bins.values, 16)
    p = boost.Params(rounds=1, leaves=2, min_rows=1, learning_rate=1.0)
    d = frame.where("a > 0.3")
    fit = boost.start(d, only, "y", "row_id", [(p, -1, 0)])
    tree = fit.run()[0].trees[0]
    left = {bins.values[0][k - 1] for k in tree.left_bins[0] if 0 < k <= len(bins.values[0])}
    planted = {"c1", "c4", "c6", "c9"}
    assert planted <= left or not planted & left
    assert len(left & {f"c{k}" for k in range(12)}) in (4, 8)


def test_folds_patience_scores_and_state(spark, frame):
    bins = boost.fit_bins(frame, ["a", "b"], ["c"], size=32)
    p = boost.Params(rounds=3000, patience=6, learning_rate=0.3, leaves=8, min_rows=10,
                     row_share=0.8, feature_share=0.9)
    fit = boost.fit_folds(frame, bins, "y", 3, "row_id", params=p)
    assert [m.ended for m in fit.models] == ["patience"] * 3
    for m in fit.models:
        assert len(m.trees) - m.best_round >= 6
    oof = boost.out_of_fold(fit)
    assert oof.count() == frame.count()
    assert auc(oof, "label", "score").first()["auc"] > 0.85
    again = boost.from_json(boost.to_json(bins, fit.models))
    one = {r.row_id: r.score for r in boost.score(frame, bins, fit.models, "row_id").collect()}
    two = {r.row_id: r.score for r in boost.score(frame, *again, "row_id").collect()}
    assert one == two and all(0 < s < 1 for s in one.values())


def test_search_scans_do_not_grow_with_trials(frame):
    bins = boost.fit_bins(frame, ["a", "b"], ["c"], size=16)
    base = boost.Params(rounds=2, leaves=4)
    scans = []
    for n in (2, 20):
        trials = [{"learning_rate": 0.01 + 0.02 * k, "leaves": 4} for k in range(n)]
        ledger, fit = boost.search(frame, bins, "y", 3, "row_id", trials, params=base)
        scans.append(fit.scans)
        out = ledger.collect()
        assert len(out) == n and sum(r.is_best for r in out) == 1
        assert max(out, key=lambda r: r.score).is_best
    assert scans[1] <= scans[0] + 2


def test_odd_tables(spark, frame):
    bins = boost.fit_bins(frame, ["a", "b"], ["c"], size=16)
    p = boost.Params(rounds=3)
    none = boost.start(frame.where("false"), bins, "y", "row_id", [(p, -1, 0)])
    assert none.run()[0].ended == "no rows" and boost.out_of_fold(none).count() == 0
    same = boost.start(frame.where("y = 1"), bins, "y", "row_id", [(p, -1, 0)])
    assert same.run()[0].trees[0].feature == [-1]
    odd = spark.createDataFrame([(1, None, float("nan"), None, 1, None), (1, 2.0, 1.0, "new", 0, None),
                                 (None, 2.0, 1.0, "", None, 0)], frame.schema)
    assert boost.score(odd, bins, same.models, "row_id").count() == 3
    assert boost.fit_bins(frame.where("false"), ["a"], ["c"]).values == [[]]


def random_tree(r, features, size, leaves):
    tree = boost.Tree()
    tree.add(float(r.normal()))
    open_ = [0]
    while len(open_) < leaves:
        k = open_.pop(int(r.integers(len(open_))))
        tree.feature[k] = int(r.integers(features))
        tree.left_bins[k] = np.flatnonzero(r.random(size) < 0.5).tolist()
        tree.left[k], tree.right[k] = tree.add(float(r.normal())), tree.add(float(r.normal()))
        open_ += [tree.left[k], tree.right[k]]
    return tree


def test_walk_finds_the_leaves_of_many_trees_at_once():
    r = np.random.default_rng(5)
    x = r.integers(0, 32, (6, 500)).astype(np.uint8)
    trees = [random_tree(r, 6, 32, n) for n in (1, 2, 8, 9, 3, 64, 65, 8, 8, 1, 5, 7, 8, 8, 31, 8)]
    walk = boost.Walk(trees, 6, 32)
    for tree, node, code in zip(trees, walk.node, walk.codes(x), strict=True):
        assert (node[code] == tree.leaf_of(x, 32)).all()
    want = sum(np.array(t.value)[t.leaf_of(x, 32)] for t in trees)
    assert np.allclose(walk.sums(x, [list(range(len(trees))), []])[0], want)


def test_rows_alike_are_one_cell_and_count_as_rows(spark, frame):
    """The same trees from cells as from rows; a fit reads fewer rows than the table has."""
    bins = boost.fit_bins(frame, ["a"], ["c"], size=4)
    d = frame.select("row_id", "a", "c", "y", F.expr("cast(row_id % 3 as int)").alias("fold"))
    settings = [(boost.Params(rounds=3, leaves=5, min_rows=5), k, 0) for k in range(3)]
    fit = boost.start(d, bins, "y", "row_id", settings, "fold")
    cells = [r["n"] for r in fit.blocks.collect()]
    rows = boost.start(d, bins, "y", "row_id", settings, "fold")
    rows.blocks = rows.rows
    assert sum(cells) <= 4 * 4 * 2 * 3 < frame.where("y is not null").count() == sum(
        r["n"] for r in rows.blocks.collect())
    for a, b in zip(fit.run(), rows.run(), strict=True):
        assert a.auc == pytest.approx(b.auc)
        for s, t in zip(a.trees, b.trees, strict=True):
            assert (s.feature, s.left_bins, s.cover) == (t.feature, t.left_bins, t.cover)
            assert s.value == pytest.approx(t.value)
    assert boost.out_of_fold(fit).count() == frame.where("y is not null").count()


def test_features_share_codes_and_part_into_the_same_sums():
    r = np.random.default_rng(7)
    levels = (2, 31, 3, 5, 31, 2, 12, 1, 256, 0)
    used = [np.sort(r.choice(256, n, replace=False)) for n in levels]
    x = np.stack([u[r.integers(0, len(u), 700)] if len(u) else np.zeros(700) for u in used]).astype(np.uint8)
    for limit in (1, 64, 1024):
        groups = boost.Groups(used, limit)
        codes = groups.pack(x)
        assert sorted(f for m in groups.members for f in m) == list(range(len(levels)))
        assert all(n <= limit or len(m) == 1 for n, m in zip(groups.sizes, groups.members, strict=True))
        assert (groups.unpack(codes)[:9] == x[:9]).all()
        place, w = r.integers(0, 3, 700), r.normal(size=(2, 700))
        sums = [np.stack([np.bincount(place * n + c, v, 3 * n).reshape(3, n) for v in w])
                for c, n in zip(codes, groups.sizes, strict=True)]
        got = groups.part(sums, 256)
        for f in range(9):
            for k, v in enumerate(w):
                want = np.bincount(place * 256 + x[f], v, 3 * 256).reshape(3, 256)
                assert got[:, f, :, k] == pytest.approx(want)
        trees = [random_tree(r, 9, 256, n) for n in (1, 8, 30, 70, 5)]
        walk = boost.Walk(trees, len(levels), 256, groups)
        for tree, node, code in zip(trees, walk.node, walk.codes(codes), strict=True):
            assert (node[code] == tree.leaf_of(x, 256)).all()


def test_passes_read_fewer_codes_than_features_and_not_the_last_split(frame):
    """Blocks hold shared codes; the split that fills a tree needs no pass for its leaves."""
    d = frame.selectExpr("row_id", "a", "c", "y", "cast(row_id % 2 as double) as d",
                         "cast(row_id % 3 as double) as e", "cast(row_id % 7 as double) as f")
    bins = boost.fit_bins(d, ["a", "d", "e", "f"], ["c"], size=32)
    fit = boost.start(d, bins, "y", "row_id", [(boost.Params(rounds=1, leaves=2, row_share=0.8), -1, 0)])
    tree = fit.run()[0].trees[0]
    assert len(fit.groups.sizes) < 5
    assert fit.scans == 2  # the root's, and the one that ends the fit
    assert sum(tree.cover[k] for k in (tree.left[0], tree.right[0])) == tree.cover[0] > 0
    assert tree.value[tree.left[0]] != tree.value[tree.right[0]]
