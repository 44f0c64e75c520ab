"""Embedding net over a keyed parameter table."""
import numpy as np
from pyspark.sql import functions as F

from eventcraft.operators import embednet as en
from eventcraft.operators.evaluate import auc


def rows(spark, n=700):
    """Half the rows share a value; nulls in every input column."""
    return spark.range(n).selectExpr(
        "id as row_id", "case when id % 2 = 0 then 'hot' when id % 19 = 0 then null "
        "else concat('v', id % 23) end as a", "cast(pmod(xxhash64(id), 6) as int) as b",
        "case when id % 17 <> 0 then double(id % 5 - 2) end as x").withColumn(
        "y", ((F.coalesce("a", F.lit("")) == "hot") != (F.col("b") < 3)).cast("int"))


def loss(df, s, emb, dense):
    """Log loss of the net, row by row, without blocks or Spark."""
    w1, b1, w2, b2 = en.parts(s, dense)
    out = 0.0
    for r in df.collect():
        x = np.concatenate([*(emb[f"{i}:" + ("" if r[c] is None else f"={r[c]}")]
                              for i, c in enumerate(s.categories)), [r["x"] or 0.0]])
        z = float(np.maximum(x @ w1 + b1, 0) @ w2 + b2[0])
        out += np.log1p(np.exp(-z)) if r["y"] else np.log1p(np.exp(z))
    return out


def test_gradients_equal_differences(spark, monkeypatch):
    monkeypatch.setattr(en, "BLOCK_ROWS", 64)
    df, s = rows(spark, 300).checkpoint(), en.Settings(("a", "b"), ("x",), width=3, hidden=4)
    blocks = en.to_blocks(df, s, "row_id", "y").checkpoint()
    assert blocks.count() > 2
    table, dense = en.start_table(blocks, s).checkpoint(), en.start_dense(s)
    got = {r.key: r for r in en.gradients(blocks, table, dense, s).collect()}
    emb = {r.key: np.array(r.w) for r in table.collect()}
    assert set(got) == {en.DENSE, *emb} and got[en.DENSE].n == 300
    assert abs(got[en.DENSE].loss - loss(df, s, emb, dense)) < 1e-8
    eps = 1e-6
    for key in ("0:=hot", "0:", "1:=4"):
        for j in range(3):
            up, down = ({**emb, key: emb[key] + d * np.eye(3)[j]} for d in (eps, -eps))
            want = (loss(df, s, up, dense) - loss(df, s, down, dense)) / (2 * eps)
            assert abs(got[key].g[j] - want) < 1e-4
    for j in (0, 5, len(dense) - 6, len(dense) - 1):
        e = eps * np.eye(len(dense))[j]
        want = (loss(df, s, emb, dense + e) - loss(df, s, emb, dense - e)) / (2 * eps)
        assert abs(got[en.DENSE].g[j] - want) < 1e-4


def test_update_equals_numpy(spark):
    df, s = rows(spark, 200), en.Settings(("a", "b"), ("x",), width=2, hidden=3)
    blocks = en.to_blocks(df, s, "row_id", "y").checkpoint()
    table, dense = en.start_table(blocks, s).checkpoint(), en.start_dense(s)
    old = {r.key: r for r in table.collect()}
    for step in (1, 2):
        grads = en.gradients(blocks.where("true"), table, dense, s).where("key <> '1:=4'").checkpoint()
        g = {r.key: r.g for r in grads.collect()}
        table = en.update(table, grads, 200, 0.1).checkpoint()
        new = {r.key: r for r in table.collect()}
        assert set(new) == set(old) and new["1:=4"] == old["1:=4"]
        for k in ("0:=hot", "1:=2"):
            w, m, v = en.adam(np.array(old[k].w), np.array(old[k].m), np.array(old[k].v),
                              np.array(g[k]) / 200, step, 0.1)
            assert np.allclose(new[k].w, w) and np.allclose(new[k].m, m) and np.allclose(new[k].v, v)
        old = new


def test_learns_a_joint_rule_and_stops_by_patience(spark):
    df = rows(spark)
    s = en.Settings(("a", "b"), ("x",), epochs=40, patience=2, rate=0.1)
    net = en.fit(df.where("row_id % 5 > 0"), df.where("row_id % 5 = 0"), s, "y", "row_id")
    assert max(net.aucs) > 0.95 and net.ended == "patience" and len(net.aucs) < 40
    got = en.score(df.where("row_id % 5 = 0"), net, "row_id").join(df, "row_id")
    assert abs(auc(got, "y", "score").first()["auc"] - max(net.aucs)) < 1e-3


def test_unseen_values_and_empty_tables(spark):
    df, s = rows(spark, 60), en.Settings(("a", "b"), ("x",), epochs=1)
    net = en.fit(df, df, s, "y", "row_id")
    new = df.withColumn("a", F.lit("never seen")).withColumn("b", F.lit(None).cast("int"))
    assert en.score(new, net, "row_id").where("score between 0 and 1").count() == 60
    assert en.score(df.where("false"), net, "row_id").count() == 0
    empty = en.fit(df.where("false"), df, s, "y", "row_id")
    assert empty.aucs == [] and en.score(df, empty, "row_id").count() == 60


def test_no_join_gathers_weights_on_the_driver(spark):
    """Lists count as one element in Spark's estimates: these tables look small enough to broadcast."""
    df, s = rows(spark, 200), en.Settings(("a", "b"), ("x",), width=2, hidden=3)
    blocks = en.to_blocks(df, s, "row_id", "y").checkpoint()
    table, dense = en.start_table(blocks, s).checkpoint(), en.start_dense(s)
    grads = en.gradients(blocks, table, dense, s).checkpoint()
    for step in (en.gradients(blocks, table, dense, s), en.update(table, grads, 200, 0.1),
                 en._scored(blocks, table, dense, s)):
        plan = step._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_a_step_is_one_small_plan(spark, monkeypatch):
    """The driver plans every step of a long fit: rows lie where joins need them, so weights go to
    the blocks, gradients to the keys, and nothing else moves; the session keeps its own settings."""
    monkeypatch.setattr(en, "BLOCK_ROWS", 64)
    plans, moved = [], en._moved

    def seen(*a):
        out = moved(*a)
        plans.append((out._jdf.queryExecution().executedPlan().toString(), out.count()))
        return out
    monkeypatch.setattr(en, "_moved", seen)
    df, s = rows(spark, 300), en.Settings(("a", "b"), ("x",), width=3, hidden=4, epochs=2, batch_rows=150)
    net = en.fit(df, df, s, "y", "row_id")
    assert len(plans) == 4 and len(net.aucs) == 2
    keys = net.table.count()
    for plan, n in plans:
        assert plan.count("Exchange") == 2 and plan.count("SortMergeJoin") == 3 and n == keys + 1
        assert "Adaptive" not in plan and "bloom_filter" not in plan
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_a_million_categories(spark):
    df = spark.range(1_000_000).selectExpr("id as row_id", "concat('u', id) as a", "cast(id % 2 as int) as y")
    s = en.Settings(("a",), width=4, hidden=4)
    blocks = en.to_blocks(df, s, "row_id", "y").checkpoint()
    table, dense = en.start_table(blocks, s), en.start_dense(s)
    grads = en.gradients(blocks, table, dense, s).checkpoint()
    assert en.update(table, grads, 1_000_000, 0.1).where("t = 1").count() == 1_000_000
    assert len(dense) == 4 * 4 + 4 + 4 + 1  # what the driver holds
