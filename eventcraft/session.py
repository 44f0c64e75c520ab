"""Session helpers: UTC clock, AQE on, reliable checkpoint folder, package shipping.

On a cluster the checkpoint folder is whatever ``spark.checkpoint.dir`` names
(a shared file system). Only a ``local`` master, where driver and executors are
one machine, may go without: it gets the caller's folder or one below the
session's warehouse folder.
"""

from __future__ import annotations

import gc
import io
import os
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "eventcraft",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the reliable checkpoint folder, setting one only if none is set.

    The cluster's own ``spark.checkpoint.dir`` always wins. Without it, only a
    ``local`` master is given a folder (``fallback``, the environment's
    EVENTCRAFT_CHECKPOINT_DIR, or one in the warehouse folder); any other
    master raises, since a folder of one machine is not shared.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share")
        configured = (fallback or os.environ.get("EVENTCRAFT_CHECKPOINT_DIR")
                      or f"{spark.conf.get('spark.sql.warehouse.dir')}/eventcraft-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """The configured shared folder itself, the same in every session (for ledgers and state)."""
    return ensure_checkpoint_dir(spark).rstrip("/").rpartition("/")[0]


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside; a setting of the session itself comes back after."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: for small plans of a loop over rows that lie where joins need them: planned once, not stage by stage
#: (adaptive plans forget where stored rows lie), and without filters that the driver gathers
STORED_ROWS = {"spark.sql.adaptive.enabled": "false", "spark.sql.optimizer.runtime.bloomFilter.enabled": "false"}


def let_go(spark: SparkSession) -> None:
    """For loops of many plans: the driver collects its garbage now, so that its heap does not fill up
    first and that Spark's cleaner drops the broadcasts, shuffles and checkpoints of earlier rounds."""
    gc.collect()
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:  # noqa: BLE001 - Spark Connect: the server's own collections must do
        pass


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers (once per context)."""
    sc = spark.sparkContext
    if getattr(sc, "_eventcraft_shipped", False):
        return
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    # the driver's own temporary folder; Spark serves the file to the executors
    path = Path(sc._temp_dir) / "eventcraft.zip"
    path.write_bytes(data.getvalue())
    sc.addPyFile(str(path))
    sc._eventcraft_shipped = True


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a large run, derived from the input size and the cluster's cores.

    Scan splits and shuffle partitions aim at ``target_partition_bytes`` each
    (so a task's share fits executor memory with room to spare); the initial
    shuffle partition count is at least 2x the cores and AQE coalesces small
    ones and splits skewed join partitions at run time.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(
            2 * target_partition_bytes),
        # broadcasts only when measured small; everything else sort-merge joins
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
