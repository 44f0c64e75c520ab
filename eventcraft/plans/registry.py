"""Fitted state, model registry and resumable trial ledger.

State and ledgers are plain tables in a shared folder (the cluster's
storage), so any driver can resume or score from them.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventcraft.functions.mathfn import metric_from_name


def exists(spark: SparkSession, path: str) -> bool:
    """Is there anything under ``path`` in the cluster's storage; storage faults raise."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def save_state(spark: SparkSession, model: PipelineModel, config: dict, path: str) -> None:
    """Fitted pipeline plus a one-row config table (feature lists, threshold, ...)."""
    model.write().overwrite().save(f"{path}/model")
    cfg = spark.createDataFrame([(json.dumps(config, sort_keys=True),)], "config string")
    cfg.write.mode("overwrite").parquet(f"{path}/config")


def load_state(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    """Load fitted state; a missing folder raises (scoring must not go on without it)."""
    if not exists(spark, f"{path}/model") or not exists(spark, f"{path}/config"):
        raise FileNotFoundError(f"no fitted state under {path}")
    model = PipelineModel.load(f"{path}/model")
    cfg = spark.read.parquet(f"{path}/config").first()
    return model, json.loads(cfg["config"])


def saved_states(spark: SparkSession, folder: str) -> DataFrame:
    """What is saved in ``folder``: (path: name of the state, saved_at: last change, files, bytes).

    A listing alone: path, time and length are file metadata, contents are not read.
    """
    base = folder.rstrip("/").rpartition("/")[2]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_extract("path", rf"/\Q{base}\E/([^/]+)/", 1)
    return files.select(name.alias("path"), "modificationTime", "length").where("path <> ''").groupBy(
        "path").agg(F.max("modificationTime").alias("saved_at"), F.count(F.lit(1)).alias("files"),
                    F.sum("length").alias("bytes"))


def registry_best(reg: DataFrame, name_col: str = "path", metric: str = "f1") -> DataFrame:
    """S9 + F19: the entry whose name carries the highest ``<metric>_<x.xxxx>`` (ties by name)."""
    m = metric_from_name(F.col(name_col), metric)
    d = reg.withColumn("__m", m).where(F.col("__m").isNotNull())
    return d.agg(F.max_by(F.col(name_col), F.struct(F.col("__m"), F.col(name_col))).alias(name_col),
                 F.max("__m").alias(metric))


def registry_newest(reg: DataFrame, name_col: str = "path", time_col: str = "saved_at") -> DataFrame:
    """The most recently saved entry (ties by name)."""
    return reg.agg(F.max_by(F.col(name_col), F.struct(F.col(time_col), F.col(name_col)))
                   .alias(name_col), F.max(time_col).alias(time_col))


def trials_left(planned: DataFrame, done: DataFrame, key: str = "trial_id") -> DataFrame:
    """Planned trials that have no finished record yet (left anti join)."""
    return planned.join(done.select(key), key, "left_anti")


def read_ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The finished-trial ledger, empty when none exists yet."""
    if not exists(spark, path):  # first run: nothing recorded; any other fault raises
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def append_ledger(results: DataFrame, path: str) -> None:
    """Append finished trials; the ledger is the record of the search."""
    results.write.mode("append").parquet(path)
