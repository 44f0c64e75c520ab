import numpy as np
from pyspark.sql import functions as F

from eventcraft.llm import langid
from eventcraft.llm.common import fold, table
from eventcraft.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_forward_sums_all_segmentations():
    own = langid.pieces()
    r = np.random.default_rng(0)
    p = r.random((len(own.pieces) + 1, 2))
    p[-1] = 0
    p /= p.sum(axis=0)
    at = {x: i for i, x in enumerate(own.pieces)}

    def total(word, g):
        if not word:
            return 1.0
        return sum(p[at[word[:n]], g] * total(word[n:], g)
                   for n in range(1, min(len(word), langid.PIECE_BYTES) + 1) if word[:n] in at)

    words = [b" the", b" a", " été".encode(), b" thing"]
    got = langid.forward(own, p, words)
    assert np.allclose(got, np.log([[total(w, g) for g in (0, 1)] for w in words]))
    counts = langid.expected(own, p, words, np.array([0, 1, 0, 1]), np.array([1.0, 2, 3, 4]))
    sizes = np.array([len(x) for x in own.pieces] + [0])
    assert np.isclose((counts * sizes[:, None]).sum(), 1 * 4 + 2 * 2 + 3 * 6 + 4 * 6)


def test_held_out_accuracy(spark):
    out = QUERIES["op5_language"](spark, SF).join(table(spark, SF, "documents").select(
        "doc_id", "lang"), "doc_id")
    got = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")),
                                    F.min("score"), F.max("score")).first()
    assert got[0] >= 0.97 and 0 <= got[1] <= got[2] <= 1
    want = {r.doc_id for r in table(spark, SF, "documents").where(fold("doc_id", 4) == 2).collect()}
    assert {r.doc_id for r in out.where("held_out").collect()} == want


def test_edges(spark, ugly, empty):
    model = langid.train(ugly)
    assert model.langs == ["de", "en", "fr"]
    rows = ugly.select("doc_id", "text", langid.predict(model, spark, F.col("text")).alias(
        "p")).collect()
    assert len(rows) == 13
    for r in rows:
        if not r.text or not any(c.isalpha() for c in r.text):
            assert tuple(r.p) == ("und", 0.0)
        else:
            assert r.p.lang in model.langs and 0 < r.p.score <= 1
    none = langid.train(empty)
    assert none.langs == [] and {r.p.lang for r in ugly.select(langid.predict(
        none, spark, F.col("text")).alias("p")).collect()} == {"und"}
    assert empty.select(langid.predict(model, spark, F.col("text"))).count() == 0


def test_fit_and_threshold_read_all_labelled_rows(spark):
    """7,000 documents a language: a sample's threshold and table would differ."""
    docs = spark.range(7000).selectExpr(
        "id as doc_id", "case when id % 100 = 7 then translate(sha2(string(id), 256), "
        "'0123456789abcdef', '人生而自由在尊严和权利上一律平') else "
        "concat('the house of number ', sha1(string(id div 50)), ' is open today') end as text",
        "'en' as lang").checkpoint()
    model = langid.train(docs)
    whole = langid.train(docs, docs_per_lang=10**9)
    assert np.array_equal(model.table, whole.table)
    assert not np.allclose(model.table, langid.train(docs, docs_per_lang=3000).table)
    model = langid.train(docs.where("doc_id % 100 <> 7 and doc_id < 500"))
    fits = [r.p.fit for r in docs.select(langid.predict(
        model, spark, F.col("text"), with_fit=True).alias("p")).collect()]
    for lost in (0.001, 0.0, 0.004):
        want = min(0.0, float(np.percentile(fits, 100 * lost)))
        assert want < 0 and np.isclose(langid.least_fit(model, docs, lost=lost), want, rtol=1e-12)
    assert langid.least_fit(model, docs.where("doc_id % 100 <> 7")) == min(
        0.0, float(np.percentile([f for k, f in enumerate(fits) if k % 100 != 7], 0.1)))
    assert langid.least_fit(model, docs.where("false")) == 0.0
