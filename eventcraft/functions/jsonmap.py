"""Lenient JSON attribute parsing (F9-F14), native expressions only.

A cell counts as valid when it parses as a JSON *object*; null, empty,
malformed text, arrays and scalars are invalid and give null keys. Missing
keys and explicit JSON nulls both give null values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two attribute keys and the text stand-ins for a missing value.
BOT_KEY = "botId"
PLUGIN_KEY = "pluginId"
UNKNOWN_BOT = "unknown_bot"
UNKNOWN_PLUGIN = "unknown_plugin"


def object_keys(j: Column) -> Column:
    """Keys of a JSON object, null when the cell is not a JSON object."""
    return F.json_object_keys(j)


def is_object(j: Column) -> Column:
    return object_keys(j).isNotNull()


def json_value(j: Column, key: str) -> Column:
    """Text of ``key`` in a JSON object; null if absent, JSON null or not an object."""
    return F.when(is_object(j), F.get_json_object(j, f"$.{key}"))


def extract_keys(df: DataFrame, col: str = "udmap", keys: tuple[str, ...] = (BOT_KEY, PLUGIN_KEY),
                 valid_col: str | None = "udmap_is_valid") -> DataFrame:
    """F9 (with ``valid_col``) / F10 (``valid_col=None``): values as text + valid flag."""
    j = F.col(col)
    cols = {k: json_value(j, k) for k in keys}
    if valid_col:
        cols[valid_col] = is_object(j).cast("int")
    return df.withColumns(cols)


def extract_keys_default(df: DataFrame, col: str = "udmap",
                         defaults: dict[str, str] | None = None) -> DataFrame:
    """values as text, a per-key default when missing or unparsable."""
    defaults = defaults or {BOT_KEY: UNKNOWN_BOT, PLUGIN_KEY: UNKNOWN_PLUGIN}
    j = F.col(col)
    return df.withColumns({k: F.coalesce(json_value(j, k), F.lit(d)) for k, d in defaults.items()})


def extract_keys_int(df: DataFrame, col: str = "udmap", keys: tuple[str, ...] = (BOT_KEY, PLUGIN_KEY),
                     fill: int = -1) -> DataFrame:
    """F9 + M4 as the boosted-tree scripts use it: numeric id, -1 when absent."""
    j = F.col(col)
    return df.withColumns({k: F.coalesce((json_value(j, k)).try_cast("int"), F.lit(fill))
                           for k in keys})


def sorted_keys_text(j: Column) -> Column:
    """the object's keys, sorted, joined by one space; '' when none."""
    return F.coalesce(F.array_join(F.array_sort(object_keys(j)), " "), F.lit(""))


def flatten(df: DataFrame, col: str = "udmap", keys: tuple[str, ...] = (BOT_KEY, PLUGIN_KEY),
            prefix: str = "") -> DataFrame:
    """chosen keys of the object become columns (struct, then ``s.*``)."""
    j = F.col(col)
    s = F.struct(*[json_value(j, k).alias(f"{prefix}{k}") for k in keys])
    return df.withColumn("_flat", s).select("*", "_flat.*").drop("_flat")
