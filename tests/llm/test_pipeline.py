import random
import re
import string

from pyspark.sql import functions as F

import corpus_pipeline as cp
from eventcraft.llm import common, langid, tokens
from eventcraft.llm.common import table
from eventcraft.llm.queries import SQL
from tests.llm.test_pairs import brute
from tests.llm.test_text_models import base
from tests.llm.test_tokens import ids_of

SF = "/root/testdata/sf0.001"


def redacted(text):
    spans = [s.split(":") for s in base(text).split(",") if s]
    out, at = "", 0
    for kind, s, e in ((k, int(s), int(e)) for k, s, e in spans):
        if s >= at:
            out += text[at:s] + f"<{kind.upper()}>"
        at = max(at, e)
    return out + text[at:]


def test_run_equals_brute_force(spark):
    docs = table(spark, SF, "documents").collect()
    named = [(r.doc_id, r.text) for r in docs if re.search(r"[^\W\d_]", r.text or "")]
    comp = brute(named, 80)
    kept = {i: redacted(t) for i, t in named if comp[i][2]}
    got = {}
    for r in cp.run(spark, SF).select("doc_id", "start", "ids").orderBy("doc_id", "start").collect():
        ids = got.setdefault(r.doc_id, [])
        assert r.start == len(ids)
        ids += [int.from_bytes(r.ids[k:k + 4], "little") for k in range(0, len(r.ids), 4)]
    assert got == {i: ids_of(t) for i, t in kept.items()}


def test_stages_keep_columns_and_clean_rows(spark, ugly, empty):
    docs = ugly
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    left = docs.collect()
    assert sorted((r.doc_id or 0) for r in left) == [0, 1, 7, 8, 9]
    nine = next(r for r in left if r.doc_id == 9)
    assert "<EMAIL>" in nine.text and "<CARD>" in nine.text and nine.n_chars == len(nine.text)
    assert next(r for r in left if r.doc_id == 1).n_chars == 1
    for _, stage in cp.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_sql_twins_are_registered():
    assert {"op2_embedding_dedup", "op6_minhash", "op9_top_k", "op11_exact_dedup"} == set(SQL)


def test_language_rejects_what_no_language_fits(spark):
    """Planted gibberish and unlearned languages go, every clean document stays."""
    r = random.Random(3)
    docs = table(spark, SF, "documents")
    planted = [" ".join("".join(r.choices(string.ascii_lowercase, k=r.randint(3, 9)))
                        for _ in range(n)) for n in (5, 20, 200, 2000)] + [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
        "Все люди рождаются свободными и равными в своем достоинстве и правах",
        "人人生而自由在尊严和权利上一律平等他们赋有理性和良心"]
    extra = spark.createDataFrame([(10**9 + k, t) for k, t in enumerate(planted)],
                                  "doc_id bigint, text string")
    out = cp.language(spark, docs.unionByName(extra, allowMissingColumns=True), SF)
    want = {x.doc_id for x in docs.collect() if re.search(r"[^\W\d_]", x.text or "")}
    assert {x.doc_id for x in out.collect()} == want


def test_language_without_labels_drops_texts_without_letters(spark, ugly):
    out = cp.language(spark, ugly.withColumn("lang", F.lit(None).cast("string")), SF).collect()
    want = [x for x in ugly.collect() if re.search(r"[^\W\d_]", x.text or "")]
    assert len(out) == len(want) < ugly.count()


def test_a_stage_leaves_a_worker_what_it_keeps_alone():
    """Vocabularies and caches of other stages are dropped before and after a step."""
    held = tokens._LOADED, langid._PIECES
    before = [dict(h) for h in held]
    try:
        for keep, stay in (("", []), ("tokens", [0]), ("langid", [1])):
            seen = []

            def step(it, seen=seen):
                seen.append([k for k, h in enumerate(held) if h])
                yield from it
            for h in held:
                h["probe"] = object()
            assert list(common.lean(step, keep)(iter([1, 2]))) == [1, 2]
            assert seen == [stay] and [k for k, h in enumerate(held) if h] == stay
    finally:
        for h, old in zip(held, before, strict=True):
            h.clear()
            h.update(old)
