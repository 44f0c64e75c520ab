"""First-N-rows scan (S3) and contiguous N-way row-range split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcraft.operators.rank import row_index
from eventcraft.sources.csv_io import write_csv
from eventcraft.sources.schema import ROW_ID


def first_rows(df: DataFrame, n: int, id_col: str = ROW_ID) -> DataFrame:
    """S3: the first ``n`` rows in input order (top-n by row_id, not a full sort)."""
    return df.orderBy(id_col).limit(n)


def assign_row_ranges(df: DataFrame, num_splits: int = 10, prefix: str = "part",
                      id_col: str = ROW_ID) -> DataFrame:
    """Part k holds input rows [k*size, (k+1)*size) with size = ceil(n / num_splits);
    parts past the last row are not created. Names are ``{prefix}_{k+1:02d}``.

    The row position comes from the distributed prefix count (no one-task window).
    """
    d = row_index(df, id_col, "__idx", total_col="__n")
    # size = ceil(n / num_splits), from the total the prefix count already has
    size = F.greatest(F.ceil(F.col("__n") / num_splits), F.lit(1))
    part = (F.floor(F.col("__idx") / size) + 1).cast("int")
    return d.withColumns({"part": part,
                          "part_name": F.concat(F.lit(f"{prefix}_"),
                                                F.lpad(part.cast("string"), 2, "0"))}).drop(
        "__idx", "__n")


def write_row_ranges(df: DataFrame, out_dir: str, num_splits: int = 10, prefix: str = "part",
                     id_col: str = ROW_ID) -> None:
    """S4 + S5: one CSV folder per part (``part_name=train_01/...``), rows in input order."""
    d = assign_row_ranges(df, num_splits, prefix, id_col).drop("part")
    write_csv(d.repartition("part_name").sortWithinPartitions(id_col), out_dir,
              partition_by=["part_name"])
