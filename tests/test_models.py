"""Invariants for fits: OOF coverage, score range, planted signal, save/load."""
from pyspark.sql import functions as F

from eventcraft.operators.evaluate import auc
from eventcraft.plans.model import fit_pipeline, gbt, out_of_fold, positive_score, search
from eventcraft.plans.registry import load_state, save_state
from eventcraft.sources.event_log import event_log

SF = "/root/testdata/sf0.001"


def _planted(spark):
    el = event_log(spark, SF)
    # a feature that carries the label plus noise, and one that carries nothing
    noise = (F.abs(F.hash(F.col("row_id"))) % 1000) / 1000.0
    return el.select("row_id", "is_new_did",
                     (F.col("is_new_did") * 1.0 + noise * 0.8).alias("signal"),
                     F.col("mid").cast("double").alias("mid"))


def test_oof_one_score_per_row_and_signal(spark):
    df = _planted(spark)
    res = out_of_fold(df, ["signal", "mid"], "is_new_did", 3, 42, test=df,
                      make_estimator=lambda: gbt(label="is_new_did", validation_col="__is_val",
                                                 maxIter=10))
    oof = res["oof"]
    n = df.count()
    assert oof.count() == n and oof.select("row_id").distinct().count() == n
    lo, hi = oof.agg(F.min("score"), F.max("score")).first()
    assert 0.0 <= lo and hi <= 1.0
    assert auc(oof, "is_new_did", "score").first()["auc"] > 0.9
    assert res["test"].count() == n
    imp = res["importance"]
    assert imp.select("fold").distinct().count() == 3


def test_save_load_scores_equal(spark, tmp_path):
    df = _planted(spark)
    m = fit_pipeline(df, ["signal", "mid"], gbt(label="is_new_did", maxIter=5))
    before = {r["row_id"]: r["score"] for r in positive_score(m.transform(df)).collect()}
    path = str(tmp_path / "state")
    save_state(spark, m, {"threshold": 0.5, "features": ["signal", "mid"]}, path)
    m2, cfg = load_state(spark, path)
    after = {r["row_id"]: r["score"] for r in positive_score(m2.transform(df)).collect()}
    assert cfg["threshold"] == 0.5 and before == after


def test_search_resumes_from_ledger(spark, tmp_path):
    df = _planted(spark)
    ledger = str(tmp_path / "ledger")
    first = search(df, ["signal", "mid"], "is_new_did", n_trials=2, k=2, ledger_path=ledger)
    assert first.count() == 2 and first.where("is_best").count() == 1
    again = search(df, ["signal", "mid"], "is_new_did", n_trials=3, k=2, ledger_path=ledger)
    # only the third trial ran; the ledger holds each trial once
    assert sorted(r["trial_id"] for r in again.collect()) == [0, 1, 2]
    assert spark.read.parquet(ledger).count() == 3


def test_forest_partitions_grow_with_the_rows(spark, monkeypatch):
    from eventcraft.plans import model
    seen = []

    def fit(df, cols, est, _fit=model.fit_pipeline):
        seen.append((df.rdd.getNumPartitions(), df.rdd.glom().map(len).max(), df.count()))
        return _fit(df, cols, est)
    monkeypatch.setattr(model, "fit_pipeline", fit)
    monkeypatch.setattr(model, "FOREST_ROWS", 20)
    df = _planted(spark).withColumn("y", (F.col("signal") > 0.5).cast("int")).coalesce(2)
    assert model.forest_select(df, ["signal", "mid"], "y", num_trees=3, max_depth=3).count() > 0
    parts, most, rows = seen[0]
    assert parts >= rows / 20 and most <= 2 * 20 and rows == df.count()
