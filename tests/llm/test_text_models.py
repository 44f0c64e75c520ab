import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventcraft.llm import maxent, pii, secrets
from eventcraft.llm.common import table
from eventcraft.llm.queries import QUERIES, labelled_findings

SF = "/root/testdata/sf0.001"
PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    return sum((2 * int(c) - 9 * (c > "4")) if i % 2 else int(c)
               for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                    "card": lambda: 12 <= len(d) <= 19 and luhn(d),
                    "phone": lambda: 9 <= len(d) <= 15}[kind]():
                out.append((m.start(), rank, kind, m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


HARD = ["a@b.c_d@e.f x@y..z", "1.2.3.4.5.6.7.8 1.2.3 256.1.1.1 001.02.3.255 00000000001.1.1.1",
        "4111 1111-1111 1111 4111111111111112 0000000000000", "+1 (499) 555-6503 +12 +1+2345678901",
        "é日a.b@c.d 😀 +33 6 12 34 56 78 9é", "a" * 5000 + "@" + "b" * 50, "1" * 9000, "+1" + " " * 500,
        "call 12.34.56.78.90@x.org", "-".join("4111111111111111"), "99999999999999999999.1.1.1"]


def test_base_spans(spark, ugly):
    texts = [*HARD, *(r.text for r in ugly.collect()),
             *(r.text for r in table(spark, SF, "documents").collect())]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    model = pii.train(d)
    out = pii.find(d, model)
    for r in out.select("doc_id", pii.listing(F.col("pii_base")).alias("b"), "pii_spans").collect():
        assert r.b == base(texts[r.doc_id]), texts[r.doc_id][:80]
        assert set(r.b.split(",")) - {""} <= {f"{s.kind}:{s.start}:{s.end}" for s in r.pii_spans}


def test_digest_query(spark):
    text = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in QUERIES["op8_personal_data"](spark, SF).collect():
        assert r.base_sha256 == hashlib.sha256(base(text[r.doc_id]).encode()).hexdigest()


def test_loose_forms_follow_the_votes(spark):
    rows = [(k, f"call 4111 1111 1111 1111 or +1 (499) 555-{k:04d} and mail a{k}@b{k}.com")
            for k in range(40)]
    rows += [(100 + k, f"order {k}23 4567-{k} version 1.2.3.{256 + k}") for k in range(30)]
    rows += [(200, "please call (212) 555-0199 today"), (201, "write to jane (at) site (dot) org")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.s for r in pii.find(d, pii.train(d)).select(
        "doc_id", pii.listing(F.col("pii_spans")).alias("s")).collect()}
    assert got[200] == "phone:12:26" and got[201].startswith("email:9:")
    assert all(got[100 + k] == "" for k in range(30))


def test_redact(spark):
    d = spark.createDataFrame([("a b@c.de é +33 612345678 z",), (None,), ("clean",)], "text string")
    out = pii.find(d, pii.Classifier({}, -1.0, 0.0)).select(pii.redact(
        F.col("text"), F.col("pii_spans")).alias("t")).collect()
    assert [r.t for r in out] == ["a <EMAIL> é <PHONE> z", None, "clean"]


def test_em_finds_the_reliable_labelers():
    rows = [dict(zip(pii.LABELERS, v, strict=True), n=n) for v, n in [
        ((1, 1, 1, 1, 1), 50), ((-1, -1, -1, 1, -1), 50), ((0, 1, 1, -1, 1), 5),
        ((0, -1, -1, 1, -1), 5)]]
    post = pii.em(rows)
    assert post[0] > 0.9 and post[1] < 0.1 and post[2] > 0.9 and post[3] < 0.1


def test_pii_edges(spark, empty, ugly):
    assert pii.find(empty, pii.train(empty)).count() == 0
    out = pii.find(ugly, pii.train(ugly))
    assert out.columns == [*ugly.columns, "pii_base", "pii_spans"] and out.count() == 13


def test_secret_scan(spark):
    import random
    r = random.Random(1)
    hexes = "0123456789abcdef"
    rows = []
    for k in range(300):
        rows.append((k, f'set token = "{"".join(r.choices(hexes, k=40))}" here', "src/a.py"))
        rows.append((1000 + k, f"order number {r.randint(10**15, 10**16)} was sent", "doc/b.md"))
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = secrets.candidates(d)
    labelled = found.where("doc_id % 3 > 0").withColumn("is_secret", (F.col("doc_id") < 1000).cast(
        "int"))
    out = secrets.score(found, secrets.train(labelled)).where("doc_id % 3 = 0").collect()
    assert len(out) == 200
    assert np.mean([x.is_secret == (x.doc_id < 1000) for x in out]) >= 0.99
    assert {x.candidate for x in out} <= {t[x["start"]:x["end"]] for x in out for i, t, _ in rows
                                          if i == x.doc_id}


def test_secret_edges(spark, ugly, empty):
    docs = ugly.withColumn("length", F.lit("clash")).withColumn("probability", F.lit(1)).withColumn(
        "text", F.concat("text", F.lit(" key abcdef0123456789abcdef")))
    found = secrets.candidates(docs)
    out = secrets.score(found, secrets.train(labelled_findings(docs)))
    assert out.columns == ["doc_id", "start", "end", "candidate", "probability", "is_secret"]
    assert out.count() == 11
    none = secrets.train(labelled_findings(empty))
    assert secrets.score(secrets.candidates(empty), none).count() == 0
    held = QUERIES["op1_secret_scan"](spark, SF)
    assert held.where("is_secret").count() <= held.count()


def test_secret_labels_leave_unknown_formats_open(spark):
    """Upper-case and unlisted formats never become harmless labels, and the forest finds them."""
    import random
    import string
    r = random.Random(4)
    text64, lower = string.ascii_letters + string.digits + "+/", "0123456789abcdef"

    def value(chars, n):
        return "a1" + "".join(r.choices(chars, k=n - 2))

    kinds = {
        "lower": (1, lambda: f'token = "{value(lower, 40)}" x'),
        "upper": (1, lambda: f'TOKEN = "{value(lower, 40).upper()}" X'),
        "hex32": (1, lambda: f"api_key: {value(lower, 32)}"),
        "hex64": (1, lambda: f"SECRET={value(lower, 64)}"),
        "base64": (1, lambda: f"password = '{value(text64, 24)}'"),
        "own mark": (1, lambda: f"we use ghp_{value(string.ascii_letters, 36)} here"),
        "upper mark": (1, lambda: f"WE USE AKIA{value(string.ascii_letters, 16).upper()} HERE"),
        "unknown": (None, lambda: f"we use {value(text64[:62], 30)} here"),
        "number": (0, lambda: f"order number {r.randint(10**15, 10**16)} was sent"),
        "word": (0, lambda: f"THE {''.join(r.choices('AEILNORST', k=18))} WAS"),
        "id": (0, lambda: f"see case-{r.randint(10**7, 10**8)} below"),
        "placeholder": (0, lambda: 'password = "example_password"'),
    }
    names = list(kinds)
    rows = [(k, kinds[names[k % len(names)]][1](), "src") for k in range(480)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {}
    for x in labelled_findings(d).collect():
        got.setdefault(names[x.doc_id % len(names)], set()).add(x.is_secret)
    assert got == {k: {v[0]} for k, v in kinds.items()}
    # a format that no labelled finding has
    seen = d.where(F.col("doc_id") % len(names) != names.index("base64"))
    model = secrets.train(labelled_findings(seen))
    out = secrets.score(secrets.candidates(d), model).collect()
    for name in names:
        hits = [x.is_secret for x in out if names[x.doc_id % len(names)] == name]
        if kinds[name][0] is not None:
            assert np.mean([h == bool(kinds[name][0]) for h in hits]) >= 0.95, name


def test_lm_base_score_and_gain(spark, monkeypatch):
    monkeypatch.setattr(maxent, "SLICE_TEXT", 200_000)  # several slices
    docs = table(spark, SF, "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    out = QUERIES["op7_lm_score"](spark, SF).collect()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in text}
    words = {i: [*(t or "").encode().lower().split(), None] for i, t in text.items()}
    c = Counter(w for i in words if not held[i] for w in words[i])
    n, v = sum(c.values()), len(c)
    assert len(out) == len(text)
    for r in out:
        w = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            held[r.doc_id], len(w), sum(x in c for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
    gain = [r.score - r.base_score for r in out if r.held_out]
    assert sum(gain) > 0


def test_lm_distribution_sums_to_one():
    r = np.random.default_rng(0)
    w = tuple(r.standard_normal(x.shape).astype(np.float32) for x in maxent.new_weights())
    rows = r.integers(0, maxent.ROWS, size=(maxent.FEATURES, 1))
    p = sum(np.exp(maxent.class_scores(w, rows, np.array([k])))[0] for k in range(maxent.CLASSES))
    assert p == pytest.approx(1, abs=1e-4)


def test_lm_edges(spark, ugly, empty):
    out = maxent.lm_scores(ugly, F.col("doc_id") == 7).collect()
    assert len(out) == 13 and all(np.isfinite(r.score) and r.score <= 0 for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (3, 4, 5)} == {1}
    assert maxent.lm_scores(empty, F.lit(False)).count() == 0
    none = maxent.lm_scores(ugly, F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in none} == {(0, 0, 0.0)}
