"""Registry helpers, CSV variants, sizing and config tables."""
import os

from pyspark.sql import functions as F

from eventcraft.plans.model import feature_groups
from eventcraft.plans.registry import registry_best, registry_newest, trials_left
from eventcraft.session import scale_conf
from eventcraft.sources.csv_io import read_csv_inferred, write_csv
from eventcraft.sources.slicing import write_row_ranges


def test_registry_best_and_newest(spark):
    reg = spark.createDataFrame([
        ("best_model_f1_0.7394_epoch_3.pth", 30), ("best_model_f1_0.8100_epoch_9.pth", 10),
        ("best_model_f1_0.8100_epoch_2.pth", 20), ("scaler_final.joblib", 99)],
        "path string, saved_at long")
    b = registry_best(reg).first()
    assert b["path"] == "best_model_f1_0.8100_epoch_9.pth" and abs(b["f1"] - 0.81) < 1e-12
    n = registry_newest(reg).first()
    assert n["path"] == "scaler_final.joblib" and n["saved_at"] == 99


def test_trials_left_is_anti_join(spark):
    planned = spark.createDataFrame([(i,) for i in range(5)], "trial_id int")
    done = spark.createDataFrame([(1,), (3,), (3,)], "trial_id int")
    assert sorted(r[0] for r in trials_left(planned, done).collect()) == [0, 2, 4]


def test_inferred_csv_and_row_range_files(spark, tmp_path):
    df = spark.createDataFrame([(i, f"d{i % 3}", i * 10) for i in range(11)],
                               "row_id long, did string, common_ts long")
    p = os.path.join(str(tmp_path), "csv")
    write_csv(df, p)
    back = read_csv_inferred(spark, p)
    assert dict(back.dtypes)["common_ts"] in ("int", "bigint") and back.count() == 11
    out = os.path.join(str(tmp_path), "parts")
    write_row_ranges(df, out, 10, "train")
    parts = sorted(x for x in os.listdir(out) if x.startswith("part_name="))
    assert parts == [f"part_name=train_0{i}" for i in range(1, 7)]
    assert spark.read.option("header", True).csv(out).count() == 11


def test_scale_conf_and_feature_groups(spark):
    c = scale_conf(100 * 2**40, total_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
    assert scale_conf(1, total_cores=8)["spark.sql.shuffle.partitions"] == "16"
    g = feature_groups(spark, {"number": ["a", "b"], "category": ["c"]})
    assert sorted(tuple(r) for r in g.collect()) == [("a", "number"), ("b", "number"),
                                                     ("c", "category")]


def test_add_row_id_follows_line_order(spark, tmp_path):
    from eventcraft.sources.csv_io import add_row_id
    p = str(tmp_path / "one.csv")
    with open(p, "w") as fh:
        fh.write("v\n" + "".join(f"{i}\n" for i in range(500)))
    df = add_row_id(spark.read.option("header", True).schema("v int").csv(p))
    got = [r["v"] for r in df.orderBy("row_id").collect()]
    assert got == list(range(500)) and df.select("row_id").distinct().count() == 500
