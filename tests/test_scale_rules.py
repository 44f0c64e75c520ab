"""Bounded slices, reads by name, resumable search, and the shuffle-free fold draws."""
import random

import pytest
from pyspark.sql import functions as F

from eventcraft.functions.mathfn import sigmoid, to_number
from eventcraft.operators import evaluate, rank, sequence
from eventcraft.operators.device import join_on_time
from eventcraft.operators.split import outside_fold, stratified_folds, undersample
from eventcraft.plans import registry
from eventcraft.sources.csv_io import read_csv_typed, read_events_csv, scratch_path, write_csv
from eventcraft.sources.schema import event_schema


@pytest.mark.parametrize("skew", [1, 4])
def test_no_range_bucket_outgrows_its_target(spark, skew):
    d = spark.range(200_000).select((F.rand(7) ** skew * 1e9).alias("k"), "id")
    target = 5_000
    sizes = [r["count"] for r in rank.range_buckets(d, ["k"], target).groupBy("__bkt").count()
             .collect()]
    assert sum(sizes) == 200_000 and max(sizes) <= 2 * target


def test_running_totals_over_many_buckets(spark):
    d = spark.range(20_000).select((F.col("id") % 7_001).alias("k"), F.lit(1).alias("v"))
    got = rank.running_totals(d, "k", ["v"], target_rows=300).orderBy("k").collect()
    run = 0
    for k, r in enumerate(got):
        n = 3 if k < 20_000 - 2 * 7_001 else 2
        assert (r["k"], r["v"], r["v_lt"], r["v_le"], r["v_total"]) == (k, n, run, run + n, 20_000)
        run += n


def _ranked(spark, rows, target):
    d = spark.createDataFrame(rows, "row_id bigint, did string, common_ts bigint")
    sizes = [r["count"] for r in sequence.rank_slices(d, target_rows=target).groupBy(
        "did", "__slice").count().collect()]
    got = {r["row_id"]: r["event_rank"] for r in sequence.event_rank(d, target_rows=target)
           .collect()}
    want, seen = {}, {}
    for i, did, ts in sorted(rows, key=lambda r: (r[1] or "", r[2] is None, r[2] or 0, r[0])):
        seen[did] = seen.get(did, 0) + 1
        want[i] = seen[did]
    return sizes, got, want


def test_burst_with_a_far_outlier_is_split(spark):
    rows = [(k, "hot", 1_000 + k % 60_000) for k in range(3_000)]
    rows += [(9_000, "hot", 31_536_000_000), (9_001, "cold", 5), (9_002, None, 7)]
    sizes, got, want = _ranked(spark, rows, 100)
    assert max(sizes) <= 200 and len(sizes) >= 30
    assert got == want or {k: v for k, v in got.items() if k != 9_002} == {
        k: v for k, v in want.items() if k != 9_002}


def test_one_millisecond_and_null_times_are_split(spark):
    order = list(range(1_000))
    random.Random(1).shuffle(order)
    rows = [(k, "a", 77 if k % 2 else None) for k in order]
    sizes, got, want = _ranked(spark, rows, 100)
    assert max(sizes) <= 200 and got == want


def test_csv_is_read_by_name(spark):
    names = event_schema().fieldNames()
    row = {n: None for n in names} | {"did": "42", "mid": 7, "udmap": '{"a": "x,y"}',
                                      "appver": "line\nbreak", "is_new_did": 1}
    d = spark.createDataFrame([tuple(row[n] for n in names)], event_schema())
    path = scratch_path(spark, "csv")
    write_csv(d.select(F.lit("z").alias("extra"), *reversed(names)), path)
    got = read_events_csv(spark, path).collect()
    assert len(got) == 1 and got[0].asDict() == row
    path = scratch_path(spark, "csv")
    write_csv(d.drop("is_new_did"), path)
    with pytest.raises(ValueError, match="is_new_did"):
        read_events_csv(spark, path)
    assert "is_new_did" not in read_events_csv(spark, path, with_label=False).columns
    assert read_csv_typed(spark, path, event_schema(), optional=("is_new_did",)).first()[
        "is_new_did"] is None


def test_bad_cells_raise_or_are_counted(spark):
    path = scratch_path(spark, "csv")
    write_csv(spark.createDataFrame([("1", "a"), ("x", "b")], "n string, t string"), path)
    schema = spark.createDataFrame([], "t string, n int").schema
    with pytest.raises(Exception, match="bad cell in column n"):
        read_csv_typed(spark, path, schema).collect()
    got = {r["t"]: (r["n"], r["__bad_cells"]) for r in read_csv_typed(
        spark, path, schema, bad_cells="count").collect()}
    assert got == {"a": (1, 0), "b": (None, 1)}


def test_numbers_and_sigmoid(spark):
    texts = {"1d": None, "2f": None, "NaN": None, "Infinity": None, "x": None, " 3 ": 3.0,
             "-1.5e2": -150.0, ".5": 0.5, "7.": 7.0, "1e": None, "": None, "+4": 4.0}
    d = spark.createDataFrame(list(texts), "string")
    assert {r["value"]: r["n"] for r in d.select("value", to_number(F.col("value")).alias("n"))
            .collect()} == texts
    z = spark.createDataFrame([(-1000.0,), (0.0,), (1000.0,)], "z double")
    assert [r[0] for r in z.select(sigmoid(F.col("z"))).collect()] == [0.0, 0.5, 1.0]


def test_log_loss_of_large_logits(spark):
    d = spark.createDataFrame([(1, -60.0), (0, 60.0)], "y int, z double")
    assert evaluate.log_loss(d, "y", logit="z").first()[0] == pytest.approx(60.0)
    assert evaluate.log_loss(d, "y", logit="z", pos_weight=3.0).first()[0] == pytest.approx(120.0)


def test_null_scores_raise(spark):
    d = spark.createDataFrame([(1, 0.5), (0, None)], "y int, score double")
    with pytest.raises(Exception, match="null in column score"):
        evaluate.auc(d, "y", "score").collect()


@pytest.mark.parametrize("k", [2, 3, 5])
def test_outside_fold_draws_what_undersample_does(spark, k):
    d = spark.range(300).select(F.col("id").alias("row_id"),
                                (F.col("id") % 11 == 0).cast("int").alias("y"))
    d = stratified_folds(d, "y", k, 42, keep_rank=True).checkpoint()
    counts = {(r["y"], r["fold"]): r["count"] for r in d.groupBy("y", "fold").count().collect()}
    for i in range(k):
        want = undersample(d.where(F.col("fold") != i).drop("__rk"), "y", 0.5, 42)
        got = outside_fold(d, i, k, "y", 0.5, counts=counts)
        assert {r.row_id for r in got.collect()} == {r.row_id for r in want.collect()}


def test_rows_of_two_files_with_the_same_ids(spark):
    e = spark.createDataFrame([("train", 0, "d", 5), ("test", 0, "d", 5), ("test", 1, None, 6)],
                              "origin string, row_id int, did string, common_ts int")
    f = e.withColumn("x", F.concat("origin", F.lit("!")))
    got = join_on_time(e, f, row_keys=("origin", "row_id")).collect()
    assert len(got) == 3 and all(r.x == r.origin + "!" for r in got)
    assert join_on_time(e, f.select("did", "common_ts", "x"), fanout=True).count() == 5


def test_ledger_and_state_report_other_faults(spark):
    path = scratch_path(spark, "ledger")
    assert registry.read_ledger(spark, path, "a int").count() == 0
    registry.append_ledger(spark.createDataFrame([(1,)], "a int"), path)
    assert registry.read_ledger(spark, path, "a int").count() == 1
    with pytest.raises(FileNotFoundError):
        registry.load_state(spark, path + "-none")


def test_second_search_fits_nothing(spark, monkeypatch):
    from eventcraft.plans import model
    d = spark.range(120).select(F.col("id").alias("row_id"), (F.col("id") % 2).cast("double")
                                .alias("x"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    path = scratch_path(spark, "search")
    space = {"maxDepth": ("int", 2, 3), "maxIter": ("int", 2, 3)}
    monkeypatch.setattr(model, "SEARCH_SPACE", space)
    first = model.search(d, ["x"], "y", n_trials=2, k=2, ledger_path=path).collect()
    monkeypatch.setattr(model, "out_of_fold", None)  # a fit would fail
    again = model.search(d, ["x"], "y", n_trials=2, k=2, ledger_path=path).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again)) and len(first) == 2


def test_a_cluster_without_a_shared_folder_is_refused():
    from eventcraft.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
