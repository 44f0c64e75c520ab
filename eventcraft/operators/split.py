"""Stratified folds, holdout, undersampling and class weights.

All draws are a per-label rank of ``md5(seed|row_id)`` computed with the
two-level rank, so they are reproducible, exact in size and never gather a
label's rows into one task. numpy's own shuffles cannot be reproduced; the
rules (sizes, strata, disjointness) are what is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcraft.operators.rank import hash_rank
from eventcraft.sources.schema import LABEL, ROW_ID


def stratified_folds(df: DataFrame, label: str = LABEL, k: int = 5, seed: int = 42,
                     id_col: str = ROW_ID, fold_col: str = "fold",
                     keep_rank: bool = False) -> DataFrame:
    """fold = (rank within label - 1) mod k; class sizes per fold differ by <= 1.

    ``keep_rank`` leaves the rank in ``__rk`` for ``outside_fold``."""
    r = hash_rank(df, [label], id_col, seed, "__rk")
    r = r.withColumn(fold_col, ((F.col("__rk") - 1) % k).cast("int"))
    return r if keep_rank else r.drop("__rk")


def outside_fold(d: DataFrame, fold: int, k: int, label: str = LABEL, ratio: float | None = None,
                 fold_col: str = "fold", counts: dict | None = None) -> DataFrame:
    """Rows outside one fold, undersampled as ``undersample`` does, without a shuffle.

    ``d`` carries the rank of ``stratified_folds``; the folds take ranks in turn,
    so a row's rank among its label's rows outside the fold is the rank less
    the fold's rows before it. ``counts`` holds the rows by (label, fold).
    """
    out = d.where(F.col(fold_col) != fold)
    if not ratio:
        return out
    n: dict = {}
    for (y, f), c in counts.items():
        if f != fold:
            n[y] = n.get(y, 0) + c
    if not n:
        return out
    least = min(n.values())
    keep = F.coalesce(*[F.when(F.col(label).eqNullSafe(F.lit(y)), F.lit(
        c if c == least else min(c, int(least // ratio)))) for y, c in n.items()])
    z = F.col("__rk") - 1
    rank = F.when(z >= fold, F.col("__rk") - (F.floor((z - fold) / k) + 1)).otherwise(F.col("__rk"))
    return out.where(rank <= keep)


def _label_counts(df: DataFrame, groups: list[str]) -> DataFrame:
    # one row per (groups) value: labels / folds, a handful of rows
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("__cnt"))


def holdout(df: DataFrame, label: str = LABEL, frac: float = 0.2, seed: int = 42,
            id_col: str = ROW_ID, out: str = "is_valid") -> DataFrame:
    """R2: per label, the first floor(frac * n_label) rows of the seeded order are held out."""
    # the label sizes come with the rank (same count table), no extra pass
    r = hash_rank(df, [label], id_col, seed, "__rk", with_total=True)
    return r.withColumn(out, (F.col("__rk") <= F.floor(F.col("__rk_total") * frac)).cast("int")
                        ).drop("__rk", "__rk_total")


def undersample(df: DataFrame, label: str = LABEL, ratio: float = 0.5, seed: int = 42,
                id_col: str = ROW_ID, groups: list[str] | None = None) -> DataFrame:
    """Keep every minority row and floor(n_minority / ratio) majority rows (per group).

    ``ratio`` is minority / majority after sampling (0.5 -> 2 majority rows
    per minority row). ``groups`` lets one call treat several training sets
    (e.g. one per fold) at once.
    """
    g = list(groups or [])
    # one row per (group, label): a handful of rows, read once
    counts = _label_counts(df, g + [label]).collect()
    nmin = {}
    for r in counts:
        key = tuple(r[c] for c in g)
        nmin[key] = min(nmin.get(key, r["__cnt"]), r["__cnt"])
    keep = []
    for r in counts:
        m = nmin[tuple(r[c] for c in g)]
        n = r["__cnt"]
        keep.append((*[r[c] for c in g], r[label], n if n == m else min(n, int(m // ratio))))
    schema = df.select(*g, label).schema.add("__keep", "long")
    keep_df = df.sparkSession.createDataFrame(keep, schema)
    rk = hash_rank(df, g + [label], id_col, seed, "__rk")
    rk = rk.join(F.broadcast(keep_df), g + [label], "left")
    return rk.where(F.col("__rk") <= F.col("__keep")).drop("__rk", "__keep")


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Positives, negatives and pos_weight = neg / pos (one aggregate)."""
    y = F.col(label).cast("int")
    return df.agg(F.sum(y).cast("bigint").alias("n_pos"),
                  F.sum(1 - y).cast("bigint").alias("n_neg")).withColumn(
        "pos_weight", F.col("n_neg") / F.col("n_pos"))


def class_weight(df: DataFrame, label: str = LABEL, out: str = "weight") -> DataFrame:
    """Weight column - pos_weight on positive rows, 1 on negative rows."""
    row = class_counts(df, label).first()
    pw = row["pos_weight"] if row["pos_weight"] is not None else 1.0
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(pw))).otherwise(F.lit(1.0)))
