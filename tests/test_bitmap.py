import time

from helpers import events_df

from eventcraft.operators import bitmap, device
from eventcraft.plans.registry import saved_states
from eventcraft.sources.event_log import bucketed_events


def events(spark, n=600):
    return events_df(spark, [
        (i, None if i % 97 == 0 else f"d{(i * i) % 41}", None if i % 13 == 0 else f"e{i % 150}",
         None if i % 31 == 0 else 1000 * i, {"mid": None if i % 7 == 0 else i % 70,
                                             "device_brand": None if i % 3 == 0 else i % 5})
        for i in range(n)])


def same(a, b):
    return sorted(map(str, a.select(b.columns).collect())) == sorted(map(str, b.collect()))


def test_words_equal_count_distinct(spark):
    df = events(spark)
    want = device.device_stats(df)
    got = bitmap.device_stats(df)
    assert same(got, want)
    assert same(bitmap.device_stats(df, max_values=10), want)  # too many values: counted the other way
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Expand" in want._jdf.queryExecution().executedPlan().toString()
    assert bitmap.device_stats(df.where("false")).count() == 0


def test_states_of_two_halves_merge_into_the_whole(spark):
    df = events(spark)
    dicts = bitmap.dictionaries(df, bitmap.COUNTED)
    parts = [bitmap.device_state(df.where(f"row_id % 3 = {k}"), dicts) for k in range(3)]
    merged = bitmap.merge_states(bitmap.merge_states(parts[0], parts[1]), parts[2])
    assert same(bitmap.state_stats(merged), device.device_stats(df))


def test_buckets_need_no_exchange_of_events(spark):
    df = events(spark)
    el = bucketed_events(df, 8)
    stats = bitmap.state_stats(bitmap.device_state(el, bitmap.dictionaries(el, bitmap.COUNTED)))
    joined = device.join_device_stats(el, stats)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = device.join_device_stats(el, stats).select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" in plan
    assert same(joined, device.join_device_stats(df, device.device_stats(df)).select(joined.columns))


def test_saved_states_are_listed_not_read(spark, tmp_path):
    for k, name in enumerate(["a_f1_0.5", "b_f1_0.7"]):
        for part in ("model", "config"):
            (tmp_path / "runs" / name / part).mkdir(parents=True)
            (tmp_path / "runs" / name / part / "part-0").write_text("x" * (k + 1))
        time.sleep(1.1)
    out = saved_states(spark, str(tmp_path / "runs"))
    got = {r.path: (r.files, r.bytes) for r in out.collect()}
    assert got == {"a_f1_0.5": (2, 2), "b_f1_0.7": (2, 4)}
    assert out.orderBy("saved_at").collect()[-1].path == "b_f1_0.7"
    assert "content" not in out._jdf.queryExecution().executedPlan().toString()
