"""Property tests against brute force on small generated inputs."""
import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import events_df
from eventcraft.operators import evaluate, rank, sequence, split
from eventcraft.operators.encode import fit_vocab

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_auc(y, s):
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = s[y == 1], s[y == 0]
    if len(pos) == 0 or len(neg) == 0:
        return None
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    return (gt + 0.5 * eq) / (len(pos) * len(neg))


labels_scores = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=60)


@SETTINGS
@given(labels_scores)
def test_auc_matches_brute_force_and_flips(spark, data):
    df = spark.createDataFrame([(y, float(s)) for y, s in data], "y int, s double")
    want = brute_auc([y for y, _ in data], [s for _, s in data])
    got = evaluate.auc(df, "y", "s").first()["auc"]
    flipped = evaluate.auc(df.withColumn("s", -F.col("s")), "y", "s").first()["auc"]
    if want is None:
        assert got is None and flipped is None
    else:
        assert abs(got - want) < 1e-12 and abs(flipped - (1 - want)) < 1e-12


@SETTINGS
@given(labels_scores)
def test_pr_curve_matches_brute_force(spark, data):
    df = spark.createDataFrame([(y, float(s)) for y, s in data], "y int, s double")
    ys = np.array([y for y, _ in data])
    ss = np.array([s for _, s in data], dtype=float)
    for r in evaluate.pr_curve(df, "y", "s").collect():
        sel = ss >= r["threshold"]
        assert r["tp"] == int((ys[sel] == 1).sum()) and r["fp"] == int((ys[sel] == 0).sum())


@SETTINGS
@given(st.lists(st.integers(0, 1), min_size=5, max_size=80), st.integers(2, 5))
def test_folds_disjoint_complete_balanced(spark, ys, k):
    df = spark.createDataFrame([(i, y) for i, y in enumerate(ys)], "row_id long, y int")
    f = split.stratified_folds(df, "y", k, 42).collect()
    assert sorted(r["row_id"] for r in f) == list(range(len(ys)))
    for lab in (0, 1):
        sizes = [sum(1 for r in f if r["y"] == lab and r["fold"] == i) for i in range(k)]
        assert max(sizes) - min(sizes) <= 1
    again = {r["row_id"]: r["fold"] for r in split.stratified_folds(df, "y", k, 42).collect()}
    assert again == {r["row_id"]: r["fold"] for r in f}


@SETTINGS
@given(st.lists(st.integers(0, 1), min_size=3, max_size=80))
def test_undersample_size_exact(spark, ys):
    df = spark.createDataFrame([(i, y) for i, y in enumerate(ys)], "row_id long, y int")
    n1, n0 = sum(ys), len(ys) - sum(ys)
    got = split.undersample(df, "y", 0.5, 42).groupBy("y").count().collect()
    got = {r["y"]: r["count"] for r in got}
    mn, mj = min(n0, n1), max(n0, n1)
    if mn == 0:  # one class only: nothing to balance against, every row stays
        assert sorted(got.values()) == [mj]
        return
    want_major = mj if n0 == n1 else min(mj, int(mn / 0.5))
    assert sorted(got.values()) == sorted([mn, want_major])


@SETTINGS
@given(st.lists(st.text(alphabet="abcXY_1", min_size=0, max_size=3), min_size=1, max_size=30))
def test_vocab_codes_dense_and_sorted(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    codes = sorted((r["code"], r["value"]) for r in fit_vocab(df, ["v"]).collect())
    assert [c for c, _ in codes] == list(range(len(codes)))
    values = [v for _, v in codes]
    assert values == sorted(values, key=lambda s: s.encode("utf-8"))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 40)),
                min_size=1, max_size=70))
def test_rank_elapsed_sequence_vs_brute_force(spark, evs):
    rows = [(i, d, f"t{i}", ts) for i, (d, ts) in enumerate(evs)]
    df = events_df(spark, rows)
    # tiny buckets, a tiny hot-device threshold and tiny chunks force the two-level
    # rank, the adaptive bucket width and the halo path
    r = sequence.event_rank(df, bucket_ms=7, target_rows=4)
    s = sequence.trailing_sequence(r, "eid", pad="0", length=5, chunk_rows=6)
    el = sequence.add_first_and_elapsed(df)
    got = {x["row_id"]: (x["event_rank"], x["seq"]) for x in s.collect()}
    ela = {x["row_id"]: x["time_since_first"] for x in el.collect()}
    for d in {d for _, d, _, _ in rows}:
        mine = sorted([x for x in rows if x[1] == d], key=lambda x: (x[3], x[0]))
        for pos, x in enumerate(mine):
            toks = [y[2] for y in mine[max(0, pos - 4):pos + 1]]
            assert got[x[0]] == (pos + 1, ["0"] * (5 - len(toks)) + toks)
            assert ela[x[0]] == (x[3] - mine[0][3]) / 1000.0 >= 0


@SETTINGS
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_hash_rank_matches_global_order(spark, groups):
    df = spark.createDataFrame([(i, g) for i, g in enumerate(groups)], "row_id long, g int")
    got = {r["row_id"]: r["rank"] for r in rank.hash_rank(df, ["g"], "row_id", 7, digits=1).collect()}
    import hashlib
    for g in set(groups):
        ids = sorted((i for i, x in enumerate(groups) if x == g),
                     key=lambda i: (hashlib.md5(f"7|{i}".encode()).hexdigest(), i))
        assert [got[i] for i in ids] == list(range(1, len(ids) + 1))


@SETTINGS
@given(st.integers(1, 60), st.integers(1, 12))
def test_row_ranges_contiguous_and_complete(spark, n, k):
    from eventcraft.sources.slicing import assign_row_ranges
    df = spark.createDataFrame([(i * 3,) for i in range(n)], "row_id long")
    got = sorted((r["row_id"], r["part"]) for r in assign_row_ranges(df, k).collect())
    size = -(-n // k)
    assert [p for _, p in got] == [i // size + 1 for i in range(n)]
