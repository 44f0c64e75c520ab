"""CSV scans and sinks (S1, S2, S5, S6) and run names.

JSON cells inside CSV use doubled quotes; Spark's default escape character
would split them at the first comma, so both read and write use ``"`` as the
escape character.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventcraft.session import ensure_checkpoint_dir
from eventcraft.sources.schema import event_schema

CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"', "mode": "FAILFAST"}


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType,
                   optional: tuple[str, ...] = (), bad_cells: str = "raise",
                   multi_line: bool = True) -> DataFrame:
    """CSV scan with an explicit schema, columns bound by header name.

    The header line gives the file's column order; the wanted columns are
    selected by name and cast, others are left out. A missing column raises
    unless it is ``optional`` (then null). Files whose header differs from the
    first one's raise. A cell that is not of its type raises, or with
    ``bad_cells="count"`` becomes null and is counted in ``__bad_cells``.
    ``multi_line`` keeps quoted line ends inside a cell; such files are read by
    one task each, so write them in parts - or turn it off for files known to
    have none, which are then split.
    """
    options = CSV_OPTIONS | {"multiLine": str(multi_line).lower()}
    names = spark.read.options(**options).option("inferSchema", "false").csv(path).columns
    missing = [f.name for f in schema if f.name not in names and f.name not in optional]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    raw = spark.read.options(**options).option("enforceSchema", "false").schema(text).csv(path)
    cols, bad = [], F.lit(0)
    for f in schema:
        if f.name not in names:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        cell = F.col(f"`{f.name}`")
        typed = cell.try_cast(f.dataType)
        wrong = cell.isNotNull() & typed.isNull()
        if bad_cells == "raise" and not isinstance(f.dataType, T.StringType):
            typed = F.when(wrong, F.raise_error(F.concat(
                F.lit(f"bad cell in column {f.name}: "), cell)).cast(f.dataType)).otherwise(typed)
        bad = bad + wrong.cast("int")
        cols.append(typed.alias(f.name))
    return raw.select(*cols, *([bad.alias("__bad_cells")] if bad_cells == "count" else []))


def read_events_csv(spark: SparkSession, path: str, with_label: bool = True,
                    with_row_id: bool = False, **options) -> DataFrame:
    """Read an event file with the fixed event schema, by column name.

    Train and scoring files share one schema (the scoring file has no
    label), which removes the type drift an inferring reader would give.
    """
    st = event_schema(with_label)
    if with_row_id:  # files written by this library carry row_id
        st = T.StructType([T.StructField("row_id", T.LongType())] + st.fields)
    return read_csv_typed(spark, path, st, **options)


def add_row_id(df: DataFrame, col: str = "row_id") -> DataFrame:
    """Row identity at ingest: a unique BIGINT that increases in scan order.

    Must be taken straight after the scan, before any shuffle. Within one
    file it follows the line order (splits of a file stay in order); across
    several files it follows Spark's split order. Carry it everywhere and sort
    by it at the sink to restore input order.
    """
    return df.withColumn(col, F.monotonically_increasing_id())


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """S2 as an option: schema inference (an extra pass over the file)."""
    return spark.read.options(**CSV_OPTIONS).option("inferSchema", "true").csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              single_file: bool = False, partition_by: list[str] | None = None) -> None:
    """Header CSV sink, no index column.

    ``single_file`` is for small report tables only (importance, thresholds);
    event-sized outputs stay split across tasks.
    """
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode).options(header="true", escape='"', quote='"')
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def run_id(ts: Column | None = None) -> Column:
    """Timestamped run name ``yyyyMMdd_HHmmss``."""
    return F.date_format(ts if ts is not None else F.current_timestamp(), "yyyyMMdd_HHmmss")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/eventcraft-{name}-{uuid.uuid4().hex[:12]}"
