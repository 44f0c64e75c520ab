import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from eventcraft.llm import align
from eventcraft.llm.queries import QUERIES

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute(texts):
    a, b = libraries()
    byte = align._byte_values()
    docs, count = [], Counter()
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                 for i in ids_b for p in [b.id_to_piece(i)]]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (
                " " + text).encode():
            docs.append(([], [], [], []))
            continue
        spans = []
        for raw in (raw_a, raw_b):
            at, out = 0, []
            for x in raw:
                out.append((at, at + len(x)))
                at += len(x)
            spans.append(out)
        links = [(x, y) for x, (s, e) in zip(ids_a, spans[0], strict=True)
                 for y, (u, v) in zip(ids_b, spans[1], strict=True) if s < v and u < e]
        count.update(links)
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, low = [], 0
        for c in common:
            groups.append("|".join(",".join(str(i) for i, (_, e) in zip(ids, sp, strict=True)
                                            if low < e <= c) for ids, sp in zip(
                (ids_a, ids_b), spans, strict=True)))
            low = c
        docs.append((ids_a, ids_b, groups, links))
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return [(len(x), len(y), len(g), len(k), sum(count[p] == most[p[1]] for p in k),
             sum(count[p] for p in k), hashlib.sha256(";".join(g).encode()).hexdigest() if x else "")
            for x, y, g, k in docs]


TEXTS = ["the same words, the same ends", "", None, " leading and  double  blanks \n\t", "▁ odd sign ▁▁",
         "Écrire à <|endoftext|> <s> </s> <unk> 日本語の文。ときどき、句読点。", "x" * 700, "it's o'clock'll 12,345.67",
         "emoji 🙂🙃 and á mark", "tab\tand\x00nul\x1fsigns", "日本語" * 200, "word " * 300 + "end",
         "\n".join(f"line {k}: value={k * k};" for k in range(120)), "  ", "a", "the same words, the same ends"]


@pytest.mark.parametrize("chunk,block", [(1 << 16, 1 << 22), (37, 400), (8, 50)])
def test_documents_equal_brute_force(spark, chunk, block):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    got = align.document_links(df, chunk=chunk, block_links=block).select(COLUMNS).collect()
    assert [tuple(r)[1:] for r in sorted(got)] == brute(TEXTS)


def test_join_is_associative_and_has_an_identity():
    own = align.tokens(None, None)
    text = " " + "Wording, it's o'clock 12,345; naïve façade " * 8
    a, b = own.encode_a([text], [text.encode()])[0], own.encode_b([text], [text.encode()])[0]
    whole = align.Open(a, np.cumsum(own.size_a[a]), b, np.cumsum(own.size_b[b]))
    start = align.Fragment(True)
    want = align.join(own, start, align.fragment(own, whole))
    rnd = random.Random(4)
    for n in range(60):  # ranges cut anywhere, also inside tokens, and each side at its own places
        cuts = sorted(rnd.sample(range(1, len(text.encode())), 9))
        shift = 0 if n % 2 else 6
        a_cuts, b_cuts = cuts, [c + rnd.randint(0, shift) for c in cuts]
        b_cuts = np.maximum.accumulate(b_cuts).tolist()
        parts = []
        for s, e, u, v in zip([-1, *a_cuts], [*a_cuts, 1 << 40], [-1, *b_cuts], [*b_cuts, 1 << 40],
                              strict=True):
            x, y = whole.between(s, e), whole.between(u, v)
            parts.append(align.fragment(own, align.Open(x.a, x.a_end, y.b, y.b_end)))
        parts[0] = align.join(own, start, parts[0])
        while len(parts) > 1:
            k = rnd.randrange(len(parts) - 1)
            parts[k:k + 2] = [align.join(own, parts[k], parts[k + 1])]
            if rnd.random() < .2:
                parts.insert(rnd.randrange(len(parts) + 1), align.Fragment())
        got = parts[0]
        assert (got.cut, got.closed) == (True, want.closed)
        assert not len(got.suffix.a) and not len(got.prefix.a)


def test_both_a_encoders_agree():
    own, (a, _) = align.tokens(None, None), libraries()
    texts = [" " + t for t in TEXTS if t] + [" y" + " " * 3000 + "z" * 3000, " b" * 20 + "\n" * 1100]
    got = own.encode_a(texts, [t.encode() for t in texts])
    assert [x.tolist() for x in got] == [a.encode(t).ids for t in texts]


def test_ugly_and_empty(spark, ugly, empty):
    rows = ugly.select("doc_id", "text").collect()
    got = align.document_links(ugly, chunk=20_000).select(COLUMNS).collect()
    short = [r for r in rows if not r.text or len(r.text) < 1000]
    want = [(r.doc_id, *w[:4], w[6]) for r, w in zip(short, brute([r.text for r in short]), strict=True)]
    assert sorted(((r.doc_id, *r[1:5], r.groups_sha256) for r in got if r.n_a < 1000), key=str) == sorted(
        want, key=str)
    long = sorted((r for r in got if r.n_a >= 1000), key=lambda r: r.doc_id)
    a, b = libraries()
    assert [(r.doc_id, r.n_a, r.n_b) for r in long] == sorted(
        (r.doc_id, len(a.encode(" " + r.text).ids), len(b.encode(r.text))) for r in rows
        if r.text and len(r.text) >= 1000)
    assert long[0] == long[1]  # the repeated row
    assert align.document_links(empty).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where(
        "length(text) < 1500").orderBy("doc_id").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_alignment"](spark, sf).select(
        COLUMNS).collect()}
    want = brute([r.text for r in rows])
    for r, w in zip(rows, want, strict=True):
        g = got[r.doc_id]
        assert (*g[:4], g[6]) == (*w[:4], w[6])


def test_links_are_read_in_place(monkeypatch):
    """Slices, empty rows and columns; a reused worker gives its tokenizers back."""
    import pyarrow as pa
    rows = [b"", np.arange(3, dtype=np.uint32).tobytes(), b"", np.array([9, 7], np.uint32).tobytes()]
    for kind in (pa.binary(), pa.large_binary()):
        col = pa.array(rows, kind)
        links, at = align._flat(col)
        assert links.tolist() == [0, 1, 2, 9, 7] and at.tolist() == [0, 0, 3, 3, 5]
        links, at = align._flat(col.slice(2))
        assert links.tolist() == [9, 7] and at.tolist() == [0, 0, 2]
        links, at = align._flat(col.slice(0, 1))
        assert links.tolist() == [] and at.tolist() == [0, 0]
    monkeypatch.setattr(align, "_LOADED", {("a", "b"): None})
    align._release()
    assert align._LOADED == {}
