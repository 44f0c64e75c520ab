"""Scalar feature functions: time-zone independence, JSON edge cells, key bags."""
from pyspark.sql import functions as F

from eventcraft.functions import jsonmap
from eventcraft.functions.calendar import add_calendar
from eventcraft.operators.encode import bag_columns, fit_bag
from eventcraft.sources.event_log import event_log

SF = "/root/testdata/sf0.001"


def test_calendar_and_adapter_ignore_session_time_zone(spark):
    def snap():
        d = add_calendar(event_log(spark, SF))
        return sorted(tuple(r) for r in d.select("row_id", "common_ts", "hour", "day_of_week",
                                                  "day_of_month", "month", "year").collect())
    base = snap()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        assert snap() == base
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_known_weekday_and_hour(spark):
    # 1970-01-01 was a Thursday (Mon=0 -> 3); 2024-01-01 00:00:07 UTC a Monday
    df = spark.createDataFrame([(1, 0), (2, 1704067207179)], "row_id long, common_ts long")
    got = {r["row_id"]: (r["day_of_week"], r["hour"], r["is_weekend"])
           for r in add_calendar(df).collect()}
    assert got == {1: (3, 0, 0), 2: (0, 0, 0)}


def test_json_edge_cells(spark):
    cells = [None, "", "{}", "bad", "[1]", '{"botId":12,"pluginId":"p","z":1}',
             '{"botId":null,"a":2}', '{"k": 5}', "5", '{"botId": 1} trailing']
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "row_id long, udmap string")
    out = {r["row_id"]: (r["botId"], r["udmap_is_valid"])
           for r in jsonmap.extract_keys(df, "udmap").collect()}
    assert out[0] == (None, 0) and out[1] == (None, 0) and out[3] == (None, 0)
    assert out[2] == (None, 1) and out[4] == (None, 0) and out[8] == (None, 0)
    assert out[5] == ("12", 1) and out[6] == (None, 1) and out[7] == (None, 1)
    keys = {r["row_id"]: r["k"] for r in
            df.select("row_id", jsonmap.sorted_keys_text(F.col("udmap")).alias("k")).collect()}
    assert keys[5] == "botId pluginId z" and keys[2] == "" and keys[4] == ""


def test_bag_columns_wide(spark):
    df = spark.createDataFrame([(1, "botId pluginId z"), (2, "a botId"), (3, None)],
                               "row_id long, k string")
    bag = fit_bag(df, "k")
    assert [(r["term"], r["term_index"]) for r in bag.orderBy("term_index").collect()] == [
        ("botid", 0), ("pluginid", 1)]
    wide = {r["row_id"]: (r["k_text_0"], r["k_text_1"]) for r in bag_columns(df, "k", bag).collect()}
    assert wide == {1: (1, 1), 2: (1, 0), 3: (0, 0)}
