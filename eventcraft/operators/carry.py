"""Ordering features carried over to new events (W1-W4): old events are not read again.

A device's history is one row: how many events there were, the first time and token, the
place of the last event, and the last 49 tokens. Histories of two sets of events merge into
the history of both, whatever their order in time; events that come after a history get the
ranks, first values and trailing sequences that a run over everything would give them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventcraft.functions.calendar import seconds_between
from eventcraft.operators.sequence import (SEQ_LEN, event_rank, order_number, trailing_sequence)
from eventcraft.sources.schema import DEVICE, ROW_ID, TS


def history_state(df: DataFrame, key: str = DEVICE, ts: str = TS, row_id: str = ROW_ID,
                  token: str = "eid", length: int = SEQ_LEN) -> DataFrame:
    """One row per device (null included): n_events, first_ts, first_token (and its place
    first_order), last_order, tail: the last ``length - 1`` (place, token) in order.

    The counts are two hash aggregations. The tail is a row number with a limit, so each
    task passes on at most ``length - 1`` rows of a device, however many it has.
    """
    d = df.select(F.col(key), F.col(ts).alias("__ts"), F.col(token).alias("__token"),
                  order_number(ts, row_id).alias("__o"))
    per = d.groupBy(key, "__token").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__ts").alias("__ts"), F.min("__o").alias("__o"),
        F.max("__o").alias("__last"))
    named = F.when(F.col("__token").isNotNull(), F.col("__o"))
    per = per.groupBy(key).agg(
        F.sum("__n").alias("n_events"), F.min("__ts").alias("first_ts"),
        F.min_by("__token", named).alias("first_token"), F.min(named).alias("first_order"),
        F.max("__last").alias("last_order"))
    last = d.withColumn("__r", F.row_number().over(
        Window.partitionBy(key).orderBy(F.col("__o").desc()))).where(F.col("__r") <= length - 1)
    tail = last.groupBy(F.col(key).alias("__k")).agg(F.array_sort(F.collect_list(F.struct(
        F.col("__o").alias("place"), F.col("__token").alias("token")))).alias("tail"))
    return per.join(tail, F.col(key).eqNullSafe(F.col("__k")), "left").drop("__k")


def merge_histories(old: DataFrame, new: DataFrame, key: str = DEVICE,
                    length: int = SEQ_LEN) -> DataFrame:
    """The history of both sets of events; they may overlap in time but share no event."""
    both = old.unionByName(new).groupBy(key).agg(
        F.sum("n_events").alias("n_events"), F.min("first_ts").alias("first_ts"),
        F.min_by("first_token", "first_order").alias("first_token"),
        F.min("first_order").alias("first_order"), F.max("last_order").alias("last_order"),
        F.array_sort(F.flatten(F.collect_list("tail"))).alias("tail"))
    keep = F.lit(length - 1)
    return both.withColumn("tail", F.slice(
        "tail", F.greatest(F.lit(1), F.size("tail") - keep + 1), keep))


def late_events(history: DataFrame, new: DataFrame, key: str = DEVICE, ts: str = TS,
                row_id: str = ROW_ID) -> DataFrame:
    """Events of ``new`` that lie before the last one of their device's history.

    An untimed event counts as after every timed one, as a sort by time puts it.
    """
    last = history.select(F.col(key).alias("__k"), "last_order")
    return new.join(last, F.col(key).eqNullSafe(F.col("__k"))
                    & (order_number(ts, row_id) < F.col("last_order")), "left_semi")


def continue_events(history: DataFrame, new: DataFrame, key: str = DEVICE, ts: str = TS,
                    row_id: str = ROW_ID, token: str = "eid", length: int = SEQ_LEN, pad="0",
                    out: str = "seq") -> tuple[DataFrame, DataFrame]:
    """``new`` with event_rank, first_ts, first_token, time_since_first and the trailing
    sequence ``out``, as a run over old and new events gives them; and the history after it.

    Late events would change rows that were given out already: they raise ValueError
    (``late_events`` names them; a run over everything takes them). Histories and new
    events are shuffled, old events are not.
    """
    if not late_events(history, new, key, ts, row_id).isEmpty():
        raise ValueError("events before the end of their device's history: see late_events")
    merged = merge_histories(history, history_state(new, key, ts, row_id, token, length), key, length)
    before = history.select(F.col(key).alias("__k"), F.col("n_events").alias("__n"),
                            F.size("tail").alias("__t"))
    info = merged.select(key, "first_ts", "first_token").join(
        before, F.col(key).eqNullSafe(F.col("__k")), "left").drop("__k").withColumnRenamed(key, "__k")
    ranked = event_rank(new, key, ts, row_id).join(
        info, F.col(key).eqNullSafe(F.col("__k")), "left").drop("__k")
    ranked = ranked.withColumn("__place", F.col("event_rank") + F.coalesce("__t", F.lit(0))).withColumn(
        "event_rank", F.col("event_rank") + F.coalesce("__n", F.lit(0))).drop("__n", "__t").withColumn(
        "time_since_first", F.coalesce(seconds_between(F.col(ts), F.col("first_ts")), F.lit(0.0)))
    # the tail takes the places before the new events, and is dropped once it has been seen
    seen = history.join(new.select(F.col(key).alias("__k")), F.col(key).eqNullSafe(F.col("__k")),
                        "left_semi").select(key, F.posexplode("tail").alias("__place", "__e"))
    seen = seen.select(key, (F.col("__place") + 1).cast("bigint").alias("__place"),
                       F.col("__e.token").alias(token), F.lit(True).alias("__old"))
    rows = ranked.withColumn("__old", F.lit(False)).unionByName(seen, allowMissingColumns=True)
    rows = trailing_sequence(rows, token, key, "__place", length, pad, out)
    return rows.where(~F.col("__old")).drop("__old", "__place"), merged
