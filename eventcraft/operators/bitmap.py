"""Exact distinct counts by bitmaps over dictionary codes, and device states that merge.

Each value of a column gets a dense code; a group's values are then a few 63-bit words
joined by ``bit_or``: rows are never expanded once per distinct column, partial results are
a handful of longs whatever a device's size, and the aggregate needs no exchange where
rows are already laid out by device. States of two sets of events, made with the same
dictionaries, merge into the state of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcraft.functions.calendar import seconds_between
from eventcraft.operators.rank import dense_codes
from eventcraft.sources.schema import DEVICE, TS

#: values of a column up to which it is counted by words (16 of them); more use count_distinct
MAX_VALUES = 1008
BITS = 63


def dictionaries(df: DataFrame, cols: list[str], max_values: int = MAX_VALUES) -> dict[str, tuple]:
    """For each column (codes, number of values); codes are None beyond ``max_values``.

    ``codes`` is a checkpointed table (value, code) of at most ``max_values`` rows.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in cols])).alias("e")).select("e.*").where("value is not null").distinct()
    coded = dense_codes(pairs, "column", "value").checkpoint(eager=True)
    sizes = {r["column"]: r["n"] for r in coded.groupBy("column").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # a row for each column
    out = {}
    for c in cols:
        n = sizes.get(c, 0)
        fits = n <= max_values
        out[c] = (coded.where(F.col("column") == c).select("value", "code") if fits else None, n)
    return out


def with_codes(df: DataFrame, dicts: dict[str, tuple]) -> DataFrame:
    """Add ``__code_<column>`` for every column with codes: a broadcast of a bounded table each."""
    for c, (codes, _) in dicts.items():
        if codes is not None:
            d = codes.select(F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"__code_{c}"))
            df = df.join(F.broadcast(d), F.col(c).cast("string") == F.col(f"__v_{c}"), "left").drop(
                f"__v_{c}")
    return df


def word_aggregates(column: str, values: int) -> list[Column]:
    """One ``bit_or`` for each word of a column's codes."""
    code = F.col(f"__code_{column}")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(code, F.lit(BITS)).cast("int"))
    return [F.coalesce(F.bit_or(F.when(F.floor(code / BITS) == w, bit)), F.lit(0).cast("bigint")).alias(
        f"{column}_bits_{w}") for w in range(max(1, -(-values // BITS)))]


def bit_total(columns: list[str]) -> Column:
    return sum((F.bit_count(c).cast("bigint") for c in columns[1:]),
               F.bit_count(columns[0]).cast("bigint"))


#: columns whose values a device's statistics count
COUNTED = ["mid", "eid", "device_brand"]


def device_state(df: DataFrame, dicts: dict[str, tuple], key: str = DEVICE) -> DataFrame:
    """The mergeable form of A1: counts, words of the counted columns, first and last time."""
    if missing := [c for c in COUNTED if dicts[c][0] is None]:
        raise ValueError(f"too many values for words: {missing}")
    aggs = [F.count("mid").alias("mid_count"), F.count("eid").alias("eid_count"),
            F.min(TS).alias("common_ts_min"), F.max(TS).alias("common_ts_max")]
    for c in COUNTED:
        aggs += word_aggregates(c, dicts[c][1])
    return with_codes(df, dicts).groupBy(key).agg(*aggs)


def merge_states(old: DataFrame, new: DataFrame, key: str = DEVICE) -> DataFrame:
    """The state of both sets of events; only state rows are shuffled, events are not read again."""
    how = {"mid_count": F.sum, "eid_count": F.sum, "common_ts_min": F.min, "common_ts_max": F.max}
    return old.unionByName(new).groupBy(key).agg(*[
        how.get(c, F.bit_or)(c).alias(c) for c in old.columns if c != key])


def state_stats(state: DataFrame, key: str = DEVICE) -> DataFrame:
    """A1's columns from a state."""
    words = {c: [x for x in state.columns if x.startswith(f"{c}_bits_")] for c in COUNTED}
    return state.select(
        key, "mid_count", bit_total(words["mid"]).alias("mid_nunique"), "eid_count",
        bit_total(words["eid"]).alias("eid_nunique"),
        bit_total(words["device_brand"]).alias("device_brand_nunique"),
        "common_ts_min", "common_ts_max",
        seconds_between(F.col("common_ts_max"), F.col("common_ts_min")).alias("ts_span"))


def device_stats(df: DataFrame, key: str = DEVICE, max_values: int = MAX_VALUES) -> DataFrame:
    """A1 by words; tables with a column of more values than that use ``count_distinct``."""
    from eventcraft.operators import device
    dicts = dictionaries(df, COUNTED, max_values)
    if any(codes is None for codes, _ in dicts.values()):
        return device.device_stats(df, key)
    return state_stats(device_state(df, dicts, key), key)
