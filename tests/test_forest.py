import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from eventcraft.operators import forest
from eventcraft.plans.model import assembler, fit_pipeline, forest_select

COLS = ["a", "b", "c", "d"]


def rows(spark, n=3000):
    """A label of two columns, one of them of many values, with noise; two columns have no part in it."""
    r = np.random.default_rng(3)
    a, b, c, d = r.integers(0, 12, n), r.normal(size=n), r.normal(size=n), r.integers(0, 5, n)
    y = ((a % 3 == 0) != (b > 0.3)) ^ (r.random(n) < 0.05)
    return spark.createDataFrame([(int(k), float(v), float(w), int(z), int(u)) for k, v, w, z, u in zip(
        a, b, c, d, y, strict=True)], "a int, b double, c double, d int, y int").repartition(3)


def test_importances_are_near_spark_ml(spark):
    df = rows(spark).checkpoint()
    own = fit_pipeline(df, COLS, forest.Forest("y", 30, 8, 20)).stages[-1].featureImportances.toArray()
    ml = fit_pipeline(df, COLS, RandomForestClassifier(labelCol="y", numTrees=30, maxDepth=8, seed=1,
                                                       minInstancesPerNode=20)).stages[-1]
    assert own.sum() == pytest.approx(1) and np.abs(own - ml.featureImportances.toArray()).max() < 0.1


def test_counts_and_stored_nodes_follow_from_the_rows(spark, monkeypatch):
    """Every level's counts are those of plain rows walked from the root, over stored nodes too; and the
    trees are the same whatever the number of passes a level."""
    monkeypatch.setattr(forest, "BLOCK_ROWS", 500)
    monkeypatch.setattr(forest, "STATE_EVERY", 2)
    df = assembler(COLS).transform(rows(spark)).checkpoint()
    seen, count = [], forest._counted

    def counted(blocks, trees, some, *a):
        out = count(blocks, trees, some, *a)
        for r in blocks.collect():
            assert r["n"] <= 500
        for t in some:  # rows of the bags at every node, from the root
            want = np.zeros(len(trees[t].draws))
            for r in blocks.collect():
                n, x = r["n"], np.frombuffer(bytes(r["x"]), np.uint8)
                at = np.zeros(n, np.int64)
                for _ in range(12):
                    at = trees[t].left[at] + (x[trees[t].feature[at] * n + np.arange(n)] > trees[t].cut[at])
                place = trees[t].place[at]
                np.add.at(want, place[place >= 0], forest.bag(7, r["block"], t, n)[place >= 0])
            assert out[t]["rows"].tolist() == want.tolist()
        seen.append(len(some))
        return out
    monkeypatch.setattr(forest, "_counted", counted)
    whole = forest.Forest("y", 3, 6, 10, seed=7).fit(df)
    assert len(seen) == 6 and any(len(t.left) > 10 for t in whole.trees)
    monkeypatch.setattr(forest, "COUNT_BYTES", 1)
    parts = forest.Forest("y", 3, 6, 10, seed=7).fit(df)
    assert set(seen[6:]) == {1}
    for a, b in zip(whole.trees, parts.trees, strict=True):
        assert a.left.tolist() == b.left.tolist() and np.allclose(a.gain, b.gain)


def test_few_tasks_send_counts(spark, monkeypatch):
    """Before, every partition of 65,536 rows sent the counts of every node."""
    from eventcraft.plans import model
    monkeypatch.setattr(model, "FOREST_ROWS", 50)
    seen, count = [], forest._counted

    def counted(blocks, *a):
        seen.append(blocks.rdd.getNumPartitions())
        return count(blocks, *a)
    monkeypatch.setattr(forest, "_counted", counted)
    got = {r["column_name"] for r in forest_select(rows(spark), COLS, "y", 0.2, num_trees=5, max_depth=4).collect()}
    assert max(seen) <= spark.sparkContext.defaultParallelism < 3000 / 50 and got == {"a", "b"}


def test_bad_rows_raise_as_in_spark_ml(spark):
    df = rows(spark, 50)
    for bad in (df.withColumn("y", F.lit(None).cast("int")), df.withColumn("y", F.lit(0.5)),
                df.withColumn("a", F.lit(None).cast("int"))):
        with pytest.raises(Exception, match="must"):
            forest_select(bad, COLS, "y", num_trees=2)
