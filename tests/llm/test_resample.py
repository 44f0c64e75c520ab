import hashlib
import math
import re
import zlib
from collections import Counter

from eventcraft.llm import resample
from eventcraft.llm.queries import QUERIES


def features(text):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", data)
    pairs = [b" ".join(words[k:k + 2]) for k in range(len(words) - 1)]
    return len(words), [zlib.crc32(x) % 10_000 for x in words + pairs]


def brute(rows, target):
    s, t = Counter(), Counter()
    found = [(i, *features(x)) for i, x in rows]
    for _, _, f in found:
        s.update(f)
    for x in target:
        t.update(features(x)[1])
    all_s, all_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t)))
    out = []
    for i, words, f in found:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, words])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (
        -r[3], r[0] is None, r[0] or 0, -r[2], -r[1]))
    for k, r in enumerate(able[:25 * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score",
                                       "rank").collect()), key=str)


def test_parts_do_not_change_buckets():
    text = "Écrire À, des-mots42 " * 50 + "x" * 300 + " Ünder_score\x7fend"
    whole = Counter(features(text)[1])
    for size in (1, 7, 64, 1 << 20):
        got = Counter()
        for _, b in resample.text_buckets(text, size=size):
            got.update(b.tolist())
        assert got == whole
    assert list(resample.text_buckets(None)) == list(resample.text_buckets(" - ")) == []


def test_longer_runs():
    words = "one two three four five six".encode().split()
    want = Counter(zlib.crc32(b" ".join(words[k:k + n])) % 10_000
                   for n in (1, 2, 3) for k in range(len(words) - n + 1))
    for size in (1, 9, 1 << 20):
        got = Counter()
        for _, b in resample.text_buckets("one two three four five six", 3, size=size):
            got.update(b.tolist())
        assert got == want


def test_ugly_rows_equal_brute_force(spark, ugly):
    target = spark.createDataFrame([("wordy wordy text",), (None,), ("",)], "text string")
    rows = [(r.doc_id, r.text) for r in ugly.collect()] * 4
    many = ugly.unionByName(ugly).unionByName(ugly).unionByName(ugly)
    assert found(resample.resample(many, target)) == brute(rows, ["wordy wordy text", None, ""])


def test_empty(ugly, empty):
    assert resample.resample(empty, ugly).count() == 0
    assert resample.resample(ugly, empty).count() == ugly.count()


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert found(QUERIES["op12_resample"](spark, sf)) == brute(rows, target)
