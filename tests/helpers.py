"""Builders shared by the tests."""


def events_df(spark, rows, with_label=True):
    """Build an event-log frame from tuples (row_id, did, eid, common_ts, extra dict)."""
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("row_id", T.LongType()), T.StructField("did", T.StringType()),
        T.StructField("mid", T.IntegerType()), T.StructField("eid", T.StringType()),
        T.StructField("device_brand", T.ShortType()), T.StructField("channel", T.ShortType()),
        T.StructField("appver", T.StringType()), T.StructField("common_ts", T.LongType()),
        T.StructField("udmap", T.StringType()), T.StructField("is_new_did", T.ByteType()),
    ])
    full = []
    for r in rows:
        rid, did, eid, ts = r[:4]
        x = r[4] if len(r) > 4 else {}
        full.append((rid, did, x.get("mid", 1), eid, x.get("device_brand", 1),
                     x.get("channel", 1), x.get("appver", "1"), ts, x.get("udmap"),
                     x.get("is_new_did", 0)))
    return spark.createDataFrame(full, schema)
