"""Distributed ranks and running totals without a one-task global window.

A window with ``orderBy`` and no ``partitionBy`` pulls the whole table into
one task; partitioning by a two-valued label gives two tasks. Both break at
scale. The helpers here use the two-level form instead:

1. give each row an ordered bucket (monotone in the sort order),
2. count / sum per (group, bucket) - a small table,
3. running total over buckets on that small table,
4. join the offsets back and finish with a window inside (group, bucket).

Tasks are then bounded by the bucket size, not the group size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventcraft.session import ensure_checkpoint_dir

HASH_HEX_DIGITS = 4  # 16**4 = 65,536 hash buckets per group


def md5_key(seed: int | str, id_col: str) -> Column:
    """Reproducible shuffle key: md5 of ``seed|id`` as lower-case hex text.

    The same text comes out of DuckDB's ``md5``, so ranks built on it can be
    checked against an SQL oracle.
    """
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))


def hex_bucket(hex_text: Column, digits: int = HASH_HEX_DIGITS) -> Column:
    """Leading hex digits as an int: monotone in the text order of the hash."""
    return F.conv(F.substring(hex_text, 1, digits), 16, 10).cast("int")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str],
                    how: str = "inner", broadcast_right: bool = False) -> DataFrame:
    r = right
    for k in keys:
        r = r.withColumnRenamed(k, f"__r_{k}")
    r = F.broadcast(r) if broadcast_right else r
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    out = left.join(r, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])


def _group_keys(df: DataFrame, group_cols: list[str]) -> tuple[DataFrame, list[str]]:
    """Non-null surrogate keys (is-null flag, value as text) for each group column, so
    joins can use plain equality - which keeps the hash partitioning of the big side -
    while null still forms a group of its own."""
    keys, cols = [], {}
    for i, c in enumerate(group_cols):
        cols[f"__gn{i}"] = F.col(c).isNull()
        cols[f"__gv{i}"] = F.coalesce(F.col(c).cast("string"), F.lit(""))
        keys += [f"__gn{i}", f"__gv{i}"]
    return (df.withColumns(cols) if cols else df), keys


def bucketed_rank(df: DataFrame, group_cols: list[str], bucket: Column,
                  order: list[Column], rank_col: str = "rank",
                  offsets_broadcast: bool = False, with_total: bool = False) -> DataFrame:
    """1-based rank of each row within ``group_cols`` by ``order``.

    ``bucket`` must be monotone in ``order`` within a group and ``order``
    must be a total order (end it with a unique id). The rows are shuffled
    once, by (group, bucket), for the row number inside the bucket. Counts per
    (group, bucket) come from a partial aggregation (only count rows cross
    the network); their running offsets are a window over that small table.
    The join back uses plain equality on the same keys, so the big side keeps
    its partitioning. ``offsets_broadcast`` may be set only when
    #groups x #buckets is known to be small. ``with_total`` adds
    ``{rank_col}_total``, the group's row count, read off the same count table.
    """
    b = "__bkt"
    d, gk = _group_keys(df.withColumn(b, bucket), group_cols)
    within = Window.partitionBy(*gk, b).orderBy(*order)
    ranked = d.withColumn("__r", F.row_number().over(within))
    counts = d.groupBy(*gk, b).agg(F.count(F.lit(1)).alias("__n"))
    w_prev = (Window.partitionBy(*gk).orderBy(b)
              .rowsBetween(Window.unboundedPreceding, -1))
    extra = [F.sum("__n").over(Window.partitionBy(*gk)).alias(f"{rank_col}_total")] \
        if with_total else []
    offsets = counts.select(*gk, b, F.coalesce(F.sum("__n").over(w_prev), F.lit(0)).alias("__off"),
                            *extra)
    if offsets_broadcast:
        offsets = F.broadcast(offsets)
    out = ranked.join(offsets, [*gk, b])
    return out.withColumn(rank_col, (F.col("__off") + F.col("__r")).cast("bigint")).drop(
        b, "__off", "__r", *gk)


def hash_rank(df: DataFrame, group_cols: list[str], id_col: str, seed: int | str = 42,
              rank_col: str = "rank", digits: int = HASH_HEX_DIGITS,
              with_total: bool = False) -> DataFrame:
    """Rank within group by ``md5(seed|id)`` (ties broken by id): a seeded shuffle.

    The offsets table has #groups x 16**digits rows at most; it is joined with
    plain equality, and AQE broadcasts it when its measured size is small.
    """
    h = md5_key(seed, id_col)
    d = df.withColumn("__h", h)
    out = bucketed_rank(d, group_cols, hex_bucket(F.col("__h"), digits),
                        [F.col("__h"), F.col(id_col)], rank_col, with_total=with_total)
    return out.drop("__h")


#: rows of a bucket that one window task sorts, at most about
TARGET_ROWS = 2_000_000


def range_buckets(df: DataFrame, order: list[str | Column], target_rows: int = TARGET_ROWS,
                  name: str = "__bkt", rows: int | None = None) -> DataFrame:
    """Add an ordered bucket per row by a global range partitioning on ``order``.

    The number of buckets follows from the counted rows (twice rows / target,
    at least the session's shuffle partitions), so there is no cap and a bucket
    stays within twice ``target_rows`` as long as ``order`` has no tie that
    large. Nulls come first. The result is checkpointed (reliable), so every
    later pass sees the same buckets.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = df.count() if rows is None else rows
    parts = max(2 * -(-n // target_rows), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartitionByRange(parts, *order).withColumn(
        name, F.spark_partition_id()).checkpoint(eager=True)


def running_totals(df: DataFrame, key: str, value_cols: list[str], unique: bool = False,
                   group_cols: list[str] | None = None, target_rows: int = TARGET_ROWS,
                   carry: list[str] | None = None) -> DataFrame:
    """Per distinct ``key`` (within ``group_cols``): sums of ``value_cols``
    over keys < and <= it, and the group total.

    Output columns: groups, key, each value col (sum at that key), ``{c}_lt``,
    ``{c}_le`` and ``{c}_total``, plus ``carry`` columns (unique keys only).
    Rows are first aggregated by (groups, key) unless ``unique``, so a hot
    key is one row. The table is then dealt into ordered ranges of bounded size
    (``range_buckets``); its checkpoint is read twice (range sums, windows) and
    the source once or, for the count that sizes the ranges, twice. A null key
    is kept as the smallest one. The offset table has one row per group and
    range; it is broadcast only when there are no groups (one row per range).
    """
    g = list(group_cols or [])
    carry = [c for c in (carry or []) if c not in (*g, key, *value_cols)]
    if carry and not unique:
        raise ValueError("carry needs unique keys")
    base = df.select(*g, key, *value_cols, *carry)
    if not unique:
        base = base.groupBy(*g, key).agg(*[F.sum(c).alias(c) for c in value_cols])
    d = range_buckets(base, [*g, key], target_rows)
    per_b = d.groupBy(*g, "__bkt").agg(*[F.sum(c).alias(f"__bt_{c}") for c in value_cols])
    w_prev = (Window.partitionBy(*[F.col(c) for c in g]).orderBy("__bkt")
              .rowsBetween(Window.unboundedPreceding, -1))
    w_all = Window.partitionBy(*[F.col(c) for c in g])
    offs = per_b.select(*g, "__bkt",
                        *[F.coalesce(F.sum(f"__bt_{c}").over(w_prev), F.lit(0))
                          .alias(f"__off_{c}") for c in value_cols],
                        *[F.sum(f"__bt_{c}").over(w_all).alias(f"{c}_total") for c in value_cols])
    w_in = (Window.partitionBy(*[F.col(c) for c in g], F.col("__bkt")).orderBy(key)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumns({f"__in_{c}": F.sum(c).over(w_in) for c in value_cols})
    d = _null_safe_join(d, offs, [*g, "__bkt"], broadcast_right=not g)
    cols = {}
    for c in value_cols:
        cols[f"{c}_le"] = F.col(f"__off_{c}") + F.col(f"__in_{c}")
        cols[f"{c}_lt"] = F.col(f"__off_{c}") + F.col(f"__in_{c}") - F.col(c)
    d = d.withColumns(cols)
    return d.drop("__bkt", *[f"__in_{c}" for c in value_cols],
                  *[f"__off_{c}" for c in value_cols])


def row_index(df: DataFrame, id_col: str, index_col: str = "row_index",
              total_col: str | None = None) -> DataFrame:
    """0-based position of each row in ``id_col`` order (``id_col`` unique; a null comes first).

    One shuffle into ordered ranges; all other columns ride along, so there is
    no join back.
    """
    others = [c for c in df.columns if c != id_col]
    d = df.withColumn("__one", F.lit(1))
    t = running_totals(d, id_col, ["__one"], unique=True, carry=others)
    t = t.withColumn(index_col, F.col("__one_lt").cast("bigint"))
    if total_col:
        t = t.withColumn(total_col, F.col("__one_total").cast("bigint"))
    return t.drop("__one", "__one_lt", "__one_le", "__one_total")


def dense_codes(values: DataFrame, group_col: str, value_col: str,
                code_col: str = "code") -> DataFrame:
    """0-based code of each distinct ``value_col`` in sorted order within ``group_col``.

    ``values`` must be distinct on (group, value). Strings have no numeric
    quantiles, so the order is fixed by a global range sort; each row's
    position inside its sort partition plus the partition's offset gives the
    code. The sorted table is checkpointed (reliable) so both passes see the
    same partitioning.
    """
    ensure_checkpoint_dir(values.sparkSession)
    s = (values.select(group_col, value_col).orderBy(group_col, value_col)
         .withColumn("__mid", F.monotonically_increasing_id()))
    s = s.checkpoint(eager=True)
    s = s.withColumns({"__pid": F.shiftright("__mid", 33),
                       "__pos": F.col("__mid").bitwiseAND((1 << 33) - 1)})
    # rows per (sort partition, group): bounded by #partitions x #groups
    per = s.groupBy("__pid", group_col).agg(F.count(F.lit(1)).alias("__n"),
                                            F.min("__pos").alias("__p0"))
    w_prev = (Window.partitionBy(group_col).orderBy("__pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    offs = per.select(
        "__pid", group_col, "__p0",
        F.coalesce(F.sum("__n").over(w_prev), F.lit(0)).alias("__off"))
    out = _null_safe_join(s, offs, ["__pid", group_col], broadcast_right=True)
    return out.select(group_col, value_col,
                      (F.col("__off") + F.col("__pos") - F.col("__p0")).cast("int").alias(code_col))
