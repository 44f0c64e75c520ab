"""Report tables: importance summaries, feature cuts, distinct values, shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcraft.functions.mathfn import strip_suffix

ENCODED_SUFFIX = "_encoded"


#: columns that a wide report may have
MAX_FOLDS = 1000


def mean_importance(imp: DataFrame, feature: str = "feature", value: str = "importance") -> DataFrame:
    """Mean importance per feature over folds."""
    return imp.groupBy(feature).agg(F.avg(value).alias("importance_mean"))


def top_features(imp: DataFrame, n: int = 20, feature: str = "feature",
                 value: str = "importance") -> DataFrame:
    """K2: the ``n`` features with the highest mean importance (ties by name)."""
    return (mean_importance(imp, feature, value)
            .orderBy(F.col("importance_mean").desc(), F.col(feature)).limit(n))


def wide_importance(imp: DataFrame, folds: list | None = None, feature: str = "feature",
                    value: str = "importance", fold: str = "fold") -> DataFrame:
    """A13 + P10: one column per fold, flattened to ``fold_<k>``, plus their mean
    (missing folds skipped).

    The fold list is small (k folds); pass it to skip the distinct-value scan.
    """
    if folds is None:  # k fold ids; many more would not be folds
        folds = sorted(r[0] for r in imp.select(fold).distinct().limit(MAX_FOLDS + 1).collect())
        if len(folds) > MAX_FOLDS:
            raise ValueError(f"more than {MAX_FOLDS} values in {fold}")
    per = imp.groupBy(feature, fold).agg(F.avg(value).alias("__v"))
    # one pass: a conditional column per fold (the pivot) and the mean over folds
    return per.groupBy(feature).agg(
        *[F.max(F.when(F.col(fold) == F.lit(k), F.col("__v"))).alias(f"fold_{k}") for k in folds],
        F.avg("__v").alias("mean"))


def importance_cut(imp: DataFrame, cut: float, feature: str = "feature",
                   value: str = "importance", numeric: list[str] | None = None) -> DataFrame:
    """K3 + F20: features whose (normalised) mean importance exceeds ``cut``, split into
    numeric features and categorical ones (``*_encoded`` -> base column name)."""
    m = mean_importance(imp, feature, value)
    total = m.agg(F.sum("importance_mean")).first()[0] or 1.0
    m = m.withColumn("share", F.col("importance_mean") / F.lit(float(total)))
    kept = m.where(F.col("share") > cut)
    is_cat = F.col(feature).endswith(ENCODED_SUFFIX)
    kind = F.when(is_cat, F.lit("categorical")).otherwise(F.lit("numeric"))
    if numeric is not None:
        kept = kept.where(is_cat | F.col(feature).isin(numeric))
    return kept.select(
        F.when(is_cat, strip_suffix(F.col(feature), ENCODED_SUFFIX)).otherwise(F.col(feature))
        .alias("column_name"), kind.alias("kind"), "share")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of a column."""
    return df.select(col).distinct()


def shape_report(df: DataFrame) -> DataFrame:
    """One row per column with its type, position, and the table's row count."""
    n = df.count()
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    sch = spark.createDataFrame(rows, "position int, column_name string, data_type string")
    return sch.withColumns({"n_rows": F.lit(n).cast("bigint"),
                            "n_columns": F.lit(len(rows)).cast("int")})
