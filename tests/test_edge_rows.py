"""Hand-made edge rows (FIXTURES section 4)."""
import os

from pyspark.sql import functions as F

from helpers import events_df
from eventcraft.operators import device, evaluate, missing, sequence
from eventcraft.operators.encode import UNSEEN, encode, fit_scaler, fit_vocab, scale
from eventcraft.plans.features import sequential_features
from eventcraft.sources.csv_io import read_events_csv, write_csv
from eventcraft.sources.slicing import assign_row_ranges


def test_single_event_device(spark):
    df = events_df(spark, [(1, "a", "view", 1000)])
    f = sequential_features(df).first()
    assert f["event_rank"] == 1 and f["ts_span"] == 0 and f["time_since_first"] == 0
    seq = sequence.trailing_sequence(sequence.event_rank(df), "eid", pad="0").first()["seq"]
    assert len(seq) == 50 and seq[:49] == ["0"] * 49 and seq[49] == "view"


def test_long_device_keeps_last_50(spark):
    rows = [(i, "a", f"e{i}", 1000 + i) for i in range(60)]
    r = sequence.event_rank(events_df(spark, rows))
    s = sequence.trailing_sequence(r, "eid", pad="0")
    last = s.where(F.col("row_id") == 59).first()["seq"]
    assert last == [f"e{i}" for i in range(10, 60)]


def test_same_millisecond_falls_to_row_id(spark):
    df = events_df(spark, [(7, "a", "x", 5000), (3, "a", "y", 5000), (9, "a", "z", 4000)])
    got = {r["row_id"]: r["event_rank"] for r in sequence.event_rank(df).collect()}
    assert got == {9: 1, 3: 2, 7: 3}
    first = sequence.add_first_and_elapsed(df).select("first_eid").distinct().collect()
    assert [r[0] for r in first] == ["z"]


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (1,)], "x int")
    assert missing.fit_modes(df, ["x"]) == {"x": "1"}
    g = device.group_mode(df.withColumn("k", F.lit("a")), "k", "x").first()
    assert g["most_common_x"] == 1


def test_even_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert missing.exact_median(df, "x") == 2.5
    odd = spark.createDataFrame([(5.0,), (1.0,), (3.0,)], "x double")
    assert missing.exact_median(odd, "x") == 3.0


def test_unseen_and_null_category(spark):
    tr = spark.createDataFrame([("b",), ("a",), ("c",)], "v string")
    te = spark.createDataFrame([("a",), ("zz",), (None,)], "v string")
    vocab = fit_vocab(tr, ["v"])
    codes = {r["value"]: r["code"] for r in vocab.collect()}
    # sorted: ___UNSEEN___ sorts before lower-case letters
    assert codes == {UNSEEN: 0, "a": 1, "b": 2, "c": 3}
    got = sorted((r["v"] or "", r["v_encoded"]) for r in encode(te, vocab, ["v"]).collect())
    assert got == [("", 0), ("a", 1), ("zz", 0)]


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    st = fit_scaler(df, ["x"])
    assert st["x"][1] == 1.0
    assert {r[0] for r in scale(df, st).collect()} == {0.0}


def test_auc_ties_and_one_class(spark):
    eq = spark.createDataFrame([(1, 0.3), (0, 0.3), (1, 0.3), (0, 0.3)], "y int, s double")
    assert evaluate.auc(eq, "y", "s").first()["auc"] == 0.5
    one = spark.createDataFrame([(1, 0.3), (1, 0.5)], "y int, s double")
    assert evaluate.auc(one, "y", "s").first()["auc"] is None


def test_eleven_rows_into_ten_parts(spark):
    df = spark.createDataFrame([(i,) for i in range(11)], "row_id long")
    parts = assign_row_ranges(df, 10, "part").groupBy("part_name").count().collect()
    sizes = sorted(r["count"] for r in parts)
    assert len(parts) == 6 and sizes == [1, 2, 2, 2, 2, 2]
    names = {r["part_name"] for r in parts}
    assert names == {f"part_0{i}" for i in range(1, 7)}


def test_csv_doubled_quotes_and_commas(spark, tmp_path):
    df = events_df(spark, [(1, "a", "x", 1, {"udmap": '{"botId":12,"pluginId":"p","z":1}'}),
                           (2, "b", "y", 2, {"udmap": '{"a": "q\\"uote, comma"}'})])
    path = os.path.join(str(tmp_path), "ev")
    from eventcraft.sources.schema import event_schema
    out = df.select("row_id", *[F.col(c) if c in df.columns else F.lit(None).alias(c)
                                for c in event_schema().fieldNames()])
    out = out.select("row_id", *[F.col(f.name).cast(f.dataType) for f in event_schema().fields])
    write_csv(out, path)
    raw = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path)
                  if f.endswith(".csv"))
    assert '""botId""' in raw
    back = {r["row_id"]: r["udmap"] for r in read_events_csv(spark, path, with_row_id=True).collect()}
    assert back[1] == '{"botId":12,"pluginId":"p","z":1}'
    assert back[2] == '{"a": "q\\"uote, comma"}'


def test_hot_devices_get_narrow_buckets_same_ranks(spark):
    from eventcraft.sources.event_log import event_log
    el = event_log(spark, "/root/testdata/sf0.001")
    got = {r["row_id"]: r["event_rank"] for r in
           sequence.event_rank(el, target_rows=5).select("row_id", "event_rank").collect()}
    rows = el.select("row_id", "did", "common_ts").collect()
    by_dev = {}
    for r in rows:
        by_dev.setdefault(r["did"], []).append((r["common_ts"], r["row_id"]))
    for evs in by_dev.values():
        for pos, (_, rid) in enumerate(sorted(evs)):
            assert got[rid] == pos + 1
