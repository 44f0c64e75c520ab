import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventcraft.llm import pii, secrets, topk
from eventcraft.llm.native import (
    BLOCK,
    CHUNK,
    after,
    before,
    between,
    chunks,
    running,
    total,
    with_spans,
)

SPANS = "array<struct<start:int,`rank`:int,kind:string,`end`:int>>"


def redacted(text, spans):
    out, at = "", 0
    for s, _, kind, e in spans:
        if s >= at:
            out += text[at:s] + f"<{kind.upper()}>"
        at = max(at, e)
    return out + text[at:]


def test_running(spark):
    r = random.Random(3)
    for n in (1, 2, BLOCK, BLOCK + 1, 3 * BLOCK, 5000):
        x = [r.randint(0, 50) for _ in range(n)]
        got = spark.createDataFrame([(x,)], "x array<int>").select(
            running(F.col("x"), total).alias("s"), running(F.col("x"), F.greatest).alias("m")).first()
        assert got.s == [sum(x[:i + 1]) for i in range(n)]
        assert got.m == [max(x[:i + 1]) for i in range(n)]


def test_parts_of_a_text(spark):
    text = "é日x😀 " * CHUNK
    places = [0, 1, 5, CHUNK - 1, CHUNK, CHUNK + 1, 3 * CHUNK, len(text) - 1, len(text)]
    rows = [(text, a, b) for a in places for b in places if a <= b]
    d = spark.createDataFrame(rows, "t string, a int, b int").withColumn("p", chunks(F.col("t")))
    for r in d.select("a", "b", between(F.col("p"), F.col("a"), F.col("b")).alias("part"),
                      before(F.col("p"), F.col("a"), 24).alias("lead"),
                      after(F.col("p"), F.col("b"), 16).alias("tail")).collect():
        assert r.part == text[r.a:r.b]
        assert r.lead == text[max(0, r.a - 24):r.a] and r.tail == text[r.b:r.b + 16]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("a1 é😀", max_size=900), min_size=1, max_size=8))
def test_spans_equal_a_search(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for r in with_spans(d, "t", "[a1]+", "s").collect():
        assert [tuple(x) for x in r.s] == [(m.start(), m.end(), m[0]) for m in re.finditer(
            "[a1]+", texts[r.id])]


def test_redaction_and_overlaps_equal_brute_force(spark):
    r = random.Random(5)
    rows = []
    for k in range(120):
        text = "".join(r.choices("abcé😀 ", k=r.choice([0, 3, 400, 2000])))
        def spans(n, text=text):
            out = set()
            for _ in range(n if text else 0):
                s = r.randrange(len(text))
                kind = r.randrange(4)
                out.add((s, kind, pii.KINDS[kind], min(len(text), s + r.randint(1, 30))))
            return sorted(out)
        rows.append((k, text, spans(r.choice([0, 1, 40, 300])), spans(r.choice([0, 1, 40, 300]))))
    rows.append((900, None, [], []))
    d = spark.createDataFrame(rows, f"id int, text string, a {SPANS}, b {SPANS}")
    got = d.select("id", pii.redact(F.col("text"), F.col("a")).alias("text"), F.when(
        (F.size("a") > 0) & (F.size("b") > 0), F.array_sort(pii._free(F.col("a"), F.col("b")))
    ).otherwise(F.col("a")).alias("free")).collect()
    by_id = {x[0]: x for x in rows}
    for g in got:
        _, text, a, b = by_id[g.id]
        assert g.text == (None if text is None else redacted(text, a))
        assert [tuple(x) for x in g.free] == [x for x in a if not any(
            y[0] < x[3] and x[0] < y[3] for y in b)]


def test_time_grows_with_the_spans_of_one_text(spark):
    def seconds(n):
        text = " ".join(f"mail user{k}@host{k % 97}.example.com or token={k:012d}ab" for k in range(n))
        d = spark.createDataFrame([(1, text, "src")], "doc_id bigint, text string, source string")
        model = pii.Classifier({"is_card": 5.0}, -1.0, 0.0)
        began = time.monotonic()
        out = pii.find(d, model).select(pii.count(F.col("pii_base"), "email").alias("n"), pii.redact(
            F.col("text"), F.col("pii_spans")).alias("t")).first()
        found = secrets.candidates(d).count()
        spent = time.monotonic() - began
        assert out.n == n and out.t.count("<EMAIL>") == n and found == n
        return spent

    seconds(100)
    small, large = seconds(4000), seconds(32000)
    assert large < 16 * small + 4  # eight times the spans; their square would be 64 times


def test_loose_addresses_in_any_case_and_length(spark):
    long = "x" * 300
    rows = [(k, f"call +1 (499) 555-{k:04d} and mail a{k}@b{k}.com") for k in range(40)]
    loose = ["j (at) x.de", "JAN (AT) X.DE", f"{long} [at] {long}.com",
             "a.b {At} c (DOT) d (dot) e (dot) f (dot) g (dot) org"]
    rows += [(100 + k, f"mail {x}") for k, x in enumerate(loose)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.s for r in pii.find(d, pii.train(d)).select(
        "doc_id", pii.listing(F.col("pii_spans")).alias("s")).collect()}
    for k, x in enumerate(loose):
        assert got[100 + k] == f"email:5:{5 + len(x)}"


def test_top_k_of_an_id_with_several_vectors(spark):
    c = spark.createDataFrame([(1, [1, 0]), (2, [3, 1]), (3, [2, 9])], "vec_id int, vector array<int>")
    q = [(7, [0, 1]), (7, [1, 0]), (7, [0, 1])]
    for rows in (q, q[::-1]):
        got = topk.top_k(c, spark.createDataFrame(rows, c.schema), 1).collect()
        assert [tuple(r) for r in got] == [(7, 1, 3, 9)]
