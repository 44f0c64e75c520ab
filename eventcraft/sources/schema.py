"""Fixed schema of the event log (one row per event, many per device)."""

from __future__ import annotations

from pyspark.sql import types as T

# The narrow integer widths the event files are read with.
EVENT_FIELDS = [
    ("did", T.StringType()),
    ("mid", T.IntegerType()),
    ("eid", T.StringType()),
    ("device_brand", T.ShortType()),
    ("ntt", T.ByteType()),
    ("operator", T.ByteType()),
    ("common_country", T.ShortType()),
    ("common_province", T.ShortType()),
    ("common_city", T.ShortType()),
    ("appver", T.StringType()),
    ("channel", T.ShortType()),
    ("os_type", T.ByteType()),
    ("common_ts", T.LongType()),
    ("udmap", T.StringType()),
    ("is_new_did", T.ByteType()),
]

LABEL = "is_new_did"
DEVICE = "did"
TS = "common_ts"
ROW_ID = "row_id"

# The id-like columns the scripts treat as categories.
CATEGORY_ID_COLUMNS = [
    "mid", "eid", "device_brand", "ntt", "operator", "common_country",
    "common_province", "common_city", "appver", "channel", "os_type",
]


def event_schema(with_label: bool = True) -> T.StructType:
    """StructType of an event file; the scoring file has no label column."""
    fields = [T.StructField(n, t, True) for n, t in EVENT_FIELDS
              if with_label or n != LABEL]
    return T.StructType(fields)
