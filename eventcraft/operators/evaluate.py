"""Exact binary-classification metrics as DataFrame queries.

Rows are first aggregated by distinct score (one row per score with its
positive and negative counts - a hot score collapses), then running counts
come from the two-level prefix sum in ``rank.py``. AUC is exact with ties
(a tied positive/negative pair counts one half).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcraft.functions.mathfn import F1_GUARD, label_at
from eventcraft.operators.rank import running_totals
from eventcraft.session import ensure_checkpoint_dir


def score_counts(df: DataFrame, label: str, score: str, groups: list[str] | None = None) -> DataFrame:
    """Positives / negatives per distinct score (per group); a null score or label raises,
    so that a metric is never taken over a part of the rows."""
    def whole(c: str) -> F.Column:
        return F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null in column {c}"))).otherwise(
            F.col(c))
    y = whole(label).cast("int")
    return (df.groupBy(*(groups or []), whole(score).cast("double").alias("threshold"))
            .agg(F.sum(y).cast("bigint").alias("pos"), F.sum(1 - y).cast("bigint").alias("neg")))


def pr_curve(df: DataFrame, label: str, score: str, groups: list[str] | None = None) -> DataFrame:
    """V2: one row per distinct score t: tp, fp (rows with score >= t), precision, recall."""
    g = list(groups or [])
    sc = score_counts(df, label, score, g)
    rt = running_totals(sc, "threshold", ["pos", "neg"], unique=True, group_cols=g)
    tp = F.col("pos_total") - F.col("pos_lt")
    fp = F.col("neg_total") - F.col("neg_lt")
    out = rt.select(*g, "threshold", tp.cast("bigint").alias("tp"), fp.cast("bigint").alias("fp"),
                    F.col("pos_total").cast("bigint").alias("n_pos"),
                    F.col("neg_total").cast("bigint").alias("n_neg"))
    return out.withColumns({
        "precision": F.when(F.col("tp") + F.col("fp") > 0,
                            F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(F.lit(0.0)),
        "recall": F.when(F.col("n_pos") > 0, F.col("tp") / F.col("n_pos")).otherwise(F.lit(1.0)),
    })


def auc(df: DataFrame, label: str, score: str, groups: list[str] | None = None) -> DataFrame:
    """V1: exact ROC AUC per group; null when only one class is present."""
    g = list(groups or [])
    sc = score_counts(df, label, score, g)
    rt = running_totals(sc, "threshold", ["pos", "neg"], unique=True, group_cols=g)
    pairs = F.col("pos").cast("double") * (F.col("neg_lt").cast("double") + F.col("neg") / 2.0)
    agg = rt.groupBy(*g).agg(F.sum(pairs).alias("__s"), F.sum("pos").alias("n_pos"),
                             F.sum("neg").alias("n_neg"))
    val = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                 F.col("__s") / (F.col("n_pos").cast("double") * F.col("n_neg")))
    return agg.select(*g, val.alias("auc"), F.col("n_pos").cast("bigint"),
                      F.col("n_neg").cast("bigint"))


def f1_curve(curve: DataFrame, guard: float = F1_GUARD) -> DataFrame:
    p, r = F.col("precision"), F.col("recall")
    f = 2 * r * p / (r + p + F.lit(guard))
    return curve.withColumn("f1", F.coalesce(F.nanvl(f, F.lit(0.0)), F.lit(0.0)))


def best_f1(df: DataFrame, label: str, score: str, groups: list[str] | None = None) -> DataFrame:
    """V3: threshold with the highest guarded F1; ties -> the lowest threshold (K4)."""
    g = list(groups or [])
    c = f1_curve(pr_curve(df, label, score, g))
    pick = F.min_by(F.struct("threshold", "f1"), F.struct(-F.col("f1"), F.col("threshold")))
    return c.groupBy(*g).agg(pick.alias("b")).select(*g, "b.threshold", "b.f1")


def best_f1_strict(df: DataFrame, label: str, score: str, default_threshold: float = 0.5) -> DataFrame:
    """V4: unguarded F1 over thresholds with p + r > 0; strictly greater wins, so ties
    keep the lowest threshold; no positive F1 -> (default_threshold, 0)."""
    c = pr_curve(df, label, score)
    p, r = F.col("precision"), F.col("recall")
    c = c.where(p + r > 0).withColumn("f1", 2 * p * r / (p + r)).where(F.col("f1") > 0)
    pick = F.min_by(F.struct("threshold", "f1"), F.struct(-F.col("f1"), F.col("threshold")))
    got = c.agg(pick.alias("b")).select(
        F.coalesce(F.col("b.threshold"), F.lit(default_threshold)).alias("threshold"),
        F.coalesce(F.col("b.f1"), F.lit(0.0)).alias("f1"))
    return got


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, yh = F.col(label).cast("int"), F.col(pred).cast("int")
    return df.agg(
        F.sum(((y == 1) & (yh == 1)).cast("bigint")).alias("tp"),
        F.sum(((y == 0) & (yh == 1)).cast("bigint")).alias("fp"),
        F.sum(((y == 1) & (yh == 0)).cast("bigint")).alias("fn"),
        F.sum(((y == 0) & (yh == 0)).cast("bigint")).alias("tn"))


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """V5: share of rows with prediction == label."""
    return df.agg(F.avg((F.col(label).cast("int") == F.col(pred).cast("int")).cast("double"))
                  .alias("accuracy"))


def f1_at(df: DataFrame, label: str, score: str, threshold: float, inclusive: bool = False) -> DataFrame:
    """V6: F1 of the positive class at a fixed threshold (0 when undefined)."""
    d = df.withColumn("__pred", label_at(F.col(score), threshold, inclusive))
    c = confusion(d, label, "__pred")
    den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return c.select("tp", "fp", "fn", "tn", F.when(den > 0, 2 * F.col("tp") / den)
                    .otherwise(F.lit(0.0)).alias("f1"))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """V7: precision / recall / F1 / support per class, then accuracy, macro and
    weighted averages (undefined ratios -> 0)."""
    c = confusion(df, label, pred)

    def safe(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    # class 1 and class 0 seen from their own side
    p1, r1 = safe(tp, tp + fp), safe(tp, tp + fn)
    p0, r0 = safe(tn, tn + fn), safe(tn, tn + fp)
    f = lambda p, r: F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    rows = c.select(
        p0.alias("p0"), r0.alias("r0"), f(p0, r0).alias("f0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), f(p1, r1).alias("f1"), s1.alias("s1"),
        safe(tp + tn, n).alias("acc"), n.alias("n"))
    def item(name, p, r, f, n):
        return F.struct(F.lit(name).alias("class_name"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        n.cast("bigint").alias("support"))
    c_ = F.col
    items = F.array(
        item("0", c_("p0"), c_("r0"), c_("f0"), c_("s0")),
        item("1", c_("p1"), c_("r1"), c_("f1"), c_("s1")),
        item("accuracy", F.lit(None), F.lit(None), c_("acc"), c_("n")),
        item("macro avg", (c_("p0") + c_("p1")) / 2, (c_("r0") + c_("r1")) / 2,
             (c_("f0") + c_("f1")) / 2, c_("n")),
        item("weighted avg", safe(c_("p0") * c_("s0") + c_("p1") * c_("s1"), c_("n")),
             safe(c_("r0") * c_("s0") + c_("r1") * c_("s1"), c_("n")),
             safe(c_("f0") * c_("s0") + c_("f1") * c_("s1"), c_("n")), c_("n")))
    return rows.select(F.inline(items))


def fold_thresholds(df: DataFrame, label: str, score: str, fold: str = "fold") -> DataFrame:
    """V8: best-F1 threshold per fold, plus an ``OOF`` row over all rows and an
    ``Average`` row (mean of the fold rows).

    Each row is counted once under its fold and once under ``OOF``, so all
    curves come from one grouped pass over the source.
    """
    name = F.concat(F.lit("fold_"), (F.col(fold) + 1).cast("string"))
    tagged = df.select(label, score, F.explode(F.array(name, F.lit("OOF"))).alias("__fold"))
    b = best_f1(tagged, label, score, ["__fold"]).select(
        F.col("__fold").alias("fold"), F.col("f1").alias("f1_score"), "threshold")
    avg = b.where(F.col("fold") != "OOF").agg(
        F.lit("Average").alias("fold"), F.avg("f1_score").alias("f1_score"),
        F.avg("threshold").alias("threshold"))
    return b.unionByName(avg)


def log_loss(df: DataFrame, label: str, prob: str | None = None, logit: str | None = None,
             pos_weight: float = 1.0, eps: float = 1e-15) -> DataFrame:
    """V9: mean binary cross-entropy; from probabilities (clamped) or logits (exact for any size)."""
    y = F.col(label).cast("double")
    if logit is not None:  # log(1 + exp(-z)) and log(1 + exp(z)) without overflow or clamp
        z = F.col(logit).cast("double")
        tail = F.log1p(F.exp(-F.abs(z)))
        loss = (F.lit(pos_weight) * y * (F.greatest(-z, F.lit(0.0)) + tail)
                + (1 - y) * (F.greatest(z, F.lit(0.0)) + tail))
    else:
        p = F.least(F.greatest(F.col(prob).cast("double"), F.lit(eps)), F.lit(1 - eps))
        loss = -(F.lit(pos_weight) * y * F.log(p) + (1 - y) * F.log(1 - p))
    return df.agg(F.avg(loss).alias("log_loss"))


def two_labelings(df: DataFrame, label: str, score: str, fold: str = "fold") -> DataFrame:
    """Label rows with the OOF threshold and with the mean fold threshold;
    report both thresholds and the positive rate each gives."""
    ensure_checkpoint_dir(df.sparkSession)
    df = df.select(label, score, fold).checkpoint()  # read for the thresholds and for the rates
    ft = fold_thresholds(df, label, score, fold)
    t = {r["fold"]: r["threshold"] for r in ft.where(F.col("fold").isin("OOF", "Average")).collect()}
    t_oof, t_avg = t.get("OOF"), t.get("Average")
    return df.agg(
        F.lit(t_oof).alias("threshold_oof"),
        F.avg(label_at(F.col(score), t_oof)).alias("rate_oof"),
        F.lit(t_avg).alias("threshold_avg"),
        F.avg(label_at(F.col(score), t_avg)).alias("rate_avg"))
