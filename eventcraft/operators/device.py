"""Per-device aggregates and their join back onto events.

Every statistic is a ``groupBy(did).agg`` - partial aggregation on the map
side, so a device holding a third of all rows is combined locally before the
shuffle. Distinct counts over several columns use Spark's Expand rewrite,
which groups by (did, value) first and so also splits a hot device.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcraft.functions.calendar import hours_between, seconds_between
from eventcraft.functions.mathfn import to_number
from eventcraft.operators.sequence import with_first_token
from eventcraft.sources.schema import DEVICE, LABEL, ROW_ID, TS


def device_stats(df: DataFrame, key: str = DEVICE) -> DataFrame:
    """A1: count + distinct count of mid and eid, distinct brands, min/max ts, span seconds."""
    return df.groupBy(key).agg(
        F.count("mid").alias("mid_count"),
        F.count_distinct("mid").alias("mid_nunique"),
        F.count("eid").alias("eid_count"),
        F.count_distinct("eid").alias("eid_nunique"),
        F.count_distinct("device_brand").alias("device_brand_nunique"),
        F.min(TS).alias("common_ts_min"),
        F.max(TS).alias("common_ts_max"),
    ).withColumn("ts_span", seconds_between(F.col("common_ts_max"), F.col("common_ts_min")))


def union_events(train: DataFrame, test: DataFrame, label: str = LABEL) -> DataFrame:
    """Train (label dropped) union all test, matched by column name."""
    return train.drop(label).unionByName(test.drop(label), allowMissingColumns=True)


def device_stats_union(train: DataFrame, test: DataFrame, key: str = DEVICE) -> DataFrame:
    """A2: device stats over train and test together: count mid, distinct eid, span."""
    full = union_events(train, test)
    return full.groupBy(key).agg(
        F.count("mid").alias("mid_count"),
        F.count_distinct("eid").alias("eid_nunique"),
        seconds_between(F.max(TS), F.min(TS)).alias("ts_span"),
    )


def device_first_last(df: DataFrame, key: str = DEVICE) -> DataFrame:
    """A3: time-ordered first/last timestamp and first eid per device.

    ``first`` skips nulls, as the scripts' grouped ``first`` does; order ties
    fall to row_id.
    """
    per = df.groupBy(key).agg(
        F.count("mid").alias("mid_count"),
        F.count_distinct("eid").alias("eid_nunique"),
        F.min(TS).alias("common_ts_min"),   # first / last non-null time in time order
        F.max(TS).alias("common_ts_max"))
    return with_first_token(per, df, key).withColumn(
        "ts_span", seconds_between(F.col("common_ts_max"), F.col("common_ts_min")))


def user_stats(df: DataFrame, key: str = DEVICE, with_span: bool = False) -> DataFrame:
    """A4 (A5 with ``with_span``): size, distinct mid/eid/brand, avg/max/min numeric appver."""
    appver = to_number(F.col("appver"))
    aggs = [
        F.count(F.lit(1)).alias("user_total_events"),
        F.count_distinct("mid").alias("user_unique_mids"),
        F.count_distinct("eid").alias("user_unique_eids"),
        F.count_distinct("device_brand").alias("user_unique_device_brands"),
        F.avg(appver).alias("user_avg_appver"),
        F.max(appver).alias("user_max_appver"),
        F.min(appver).alias("user_min_appver"),
    ]
    if with_span:
        aggs.append(seconds_between(F.max(TS), F.min(TS)).alias("ts_span"))
    return df.groupBy(key).agg(*aggs)


def group_mode(df: DataFrame, key: str, col: str, out: str | None = None,
               default=None) -> DataFrame:
    """Most frequent non-null value per group, smallest on ties.

    Two aggregations instead of one per-group value map: counts per
    (group, value) first (splits a hot group), then ``min_by`` over
    (-count, value). Groups with no non-null value get ``default``.
    """
    out = out or f"most_common_{col}"
    # null values are counted too, so every group survives the first aggregation;
    # the filter keeps them out of the choice (all-null groups get ``default``)
    vc = df.groupBy(key, col).agg(F.count(F.lit(1)).alias("__n"))
    pick = F.expr(f"min_by(`{col}`, struct(-__n, `{col}`)) FILTER (WHERE `{col}` IS NOT NULL)")
    m = vc.groupBy(key).agg(pick.alias(out))
    if default is None:
        return m
    return m.withColumn(out, F.coalesce(F.col(out), F.lit(default).cast(df.schema[col].dataType)))


def group_modes(df: DataFrame, key: str, cols: list[str], prefix: str = "most_common_") -> DataFrame:
    """A7 for several columns in one pass: each row is exploded into (column, value)
    pairs, counted per (group, column, value), then one filtered ``min_by`` per
    column over (-count, value) - smallest value on ties, typed order kept."""
    from pyspark.sql import types as T
    numeric = {c: isinstance(df.schema[c].dataType, T.NumericType) for c in cols}
    items = F.array(*[F.struct(F.lit(i).alias("i"),
                               (F.col(c).cast("double") if numeric[c] else F.lit(None).cast("double"))
                               .alias("num"), F.col(c).cast("string").alias("s"))
                      for i, c in enumerate(cols)])
    ex = df.select(key, F.explode(items).alias("e")).select(key, "e.*").where(F.col("s").isNotNull())
    vc = ex.groupBy(key, "i", "num", "s").agg(F.count(F.lit(1)).alias("n"))
    aggs = [F.expr(f"min_by(s, struct(-n, num, s)) FILTER (WHERE i = {i})").alias(f"__m{i}")
            for i in range(len(cols))]
    m = vc.groupBy(key).agg(*aggs)
    return m.select(key, *[F.col(f"__m{i}").cast(df.schema[c].dataType).alias(f"{prefix}{c}")
                           for i, c in enumerate(cols)])


def _bit(small: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), small.cast("int"))


def device_profile(df: DataFrame, key: str = DEVICE) -> DataFrame:
    """A6 + A7: events, distinct counts, span hours, events per hour, modal mid/eid."""
    from eventcraft.functions.calendar import utc_date, utc_hour, weekday
    ms = F.col(TS)
    base = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("mid").alias("unique_mids"),
        F.count_distinct("eid").alias("unique_eids"),
        hours_between(F.max(TS), F.min(TS)).alias("ts_span_hours"),
        F.count_distinct("channel").alias("unique_channels"),
        F.count_distinct("device_brand").alias("unique_brands"),
        # hours and weekdays fit a bit mask: no further Expand branch
        F.bit_count(F.coalesce(F.bit_or(_bit(utc_hour(ms))), F.lit(0)))
        .cast("bigint").alias("hour_diversity"),
        F.bit_count(F.coalesce(F.bit_or(_bit(weekday(utc_date(ms)))), F.lit(0)))
        .cast("bigint").alias("day_diversity"),
    ).withColumn("avg_events_per_hour",
                 F.col("total_events") / F.greatest(F.col("ts_span_hours"), F.lit(1.0)))
    modes = group_modes(df, key, ["mid", "eid"])
    return (base.join(modes, key, "left")
            .withColumns({"most_common_mid": F.coalesce("most_common_mid", F.lit(0)),
                          "most_common_eid": F.coalesce("most_common_eid", F.lit("0"))}))


def join_device_stats(events: DataFrame, stats: DataFrame, key: str = DEVICE) -> DataFrame:
    """Left join of per-device statistics back onto every event.

    The stats side is an aggregate; AQE turns the join into a broadcast at
    run time when its measured size is under the broadcast threshold and
    otherwise keeps a sort-merge join whose skewed partitions it splits.
    """
    return events.join(stats, key, "left")


def join_on_time(events: DataFrame, feats: DataFrame, key: str = DEVICE, ts: str = TS,
                 fanout: bool = False, row_keys: tuple[str, ...] = (ROW_ID,)) -> DataFrame:
    """Join features keyed by (did, ts).

    Default joins on the device, the time and ``row_keys``, so each event keeps
    exactly one feature row; where rows of several files meet, name the file's
    column in ``row_keys`` too, as row ids are unique in one file only.
    ``fanout=True`` keeps the two-key form, where repeated (did, ts) pairs
    multiply rows as the original merge does: n events of a device in one
    millisecond give n * n rows.
    """
    if fanout:
        return events.join(feats.drop(*row_keys), [key, ts], "left")
    keys = [c for c in (key, ts, *row_keys) if c in feats.columns]
    own = feats.withColumnsRenamed({c: f"__f_{c}" for c in keys})
    same = [F.col(c).eqNullSafe(F.col(f"__f_{c}")) if c in (key, ts)
            else F.col(c) == F.col(f"__f_{c}") for c in keys]
    return events.join(own, same, "left").drop(*[f"__f_{c}" for c in keys])
