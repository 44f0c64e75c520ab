"""The three end-to-end flows on the smallest tables (tiny budgets)."""
import os

from pyspark.sql import functions as F

from eventcraft.plans import runs
from eventcraft.sources.event_log import event_log

SF = "/root/testdata/sf0.001"


def _split(spark):
    el = event_log(spark, SF, udmap="bad_rows")
    return el.where(F.col("split") == "train"), el.where(F.col("split") == "test")


def test_tree_run_outputs(spark, tmp_path):
    tr, te = _split(spark)
    out = runs.tree_run(tr, te, out_dir=str(tmp_path), k=2, undersample_ratio=0.5,
                        params={"maxIter": 5})
    n_tr, n_te = tr.count(), te.count()
    assert out["oof"].count() == n_tr
    sub = out["submission"]
    assert sub.count() == n_te and sub.select("row_id").distinct().count() == n_te
    lo, hi = sub.agg(F.min("score"), F.max("score")).first()
    assert 0 <= lo <= hi <= 1
    folds = {r["fold"] for r in out["thresholds"].collect()}
    assert folds == {"fold_1", "fold_2", "OOF", "Average"}
    assert {r["class_name"] for r in out["report"].collect()} >= {"0", "1", "accuracy"}
    stamp = os.listdir(str(tmp_path))[0]
    written = set(os.listdir(os.path.join(str(tmp_path), stamp)))
    assert {"submission_prob", "submission_binary", "importance", "thresholds"} <= written


def test_fit_save_then_score(spark, tmp_path):
    tr, te = _split(spark)
    state = str(tmp_path / "state")
    fit = runs.fit_and_save(tr, state, rounds=2, patience=1, iters_per_round=3)
    assert fit["history"].count() >= 1
    out = str(tmp_path / "sub")
    scored = runs.score_with_state(te, state, out_dir=out)
    n = te.count()
    assert scored.count() == n
    assert {r[0] for r in scored.select("is_new_did").distinct().collect()} <= {0, 1}
    back = spark.read.option("header", True).csv(out)
    assert back.count() == n and back.columns == ["did", "is_new_did"]


def test_union_scope_features(spark):
    from eventcraft.operators.device import device_stats_union
    from eventcraft.plans.features import union_tree_features
    tr, te = _split(spark)
    ftr, fte = union_tree_features(tr, te)
    assert ftr.count() == tr.count() and fte.count() == te.count()
    want = {r["did"]: (r["mid_count"], r["eid_nunique"]) for r in device_stats_union(tr, te).collect()}
    got = {r["did"]: (r["mid_count"], r["eid_nunique"])
           for r in ftr.select("did", "mid_count", "eid_nunique").distinct().collect()}
    assert all(want[d] == v for d, v in got.items())
    # counted over train and test together: the union counts are the full-table counts
    full = {r["did"]: r["n"] for r in tr.unionByName(te).groupBy("did").count()
            .withColumnRenamed("count", "n").collect()}
    assert all(want[d][0] == full[d] for d in want)
