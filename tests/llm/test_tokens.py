import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventcraft.llm import packing, tokens
from eventcraft.llm.common import shared_path

WHOLE = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aé's.,  \n\x1c "
                                                                               "<|endoftext|>")),
               max_size=40))
def test_word_ids_equal_the_library(text):
    own = tokens.WordIds(public_tokenizers.path("word_bpe_49k.json"), cache_words=3) \
        if not hasattr(test_word_ids_equal_the_library, "own") \
        else test_word_ids_equal_the_library.own
    test_word_ids_equal_the_library.own = own
    assert np.frombuffer(own.ids(text), "<u4").tolist() + [2] == ids_of(text)


ODD_TEXTS = ["plain words, 12 of them's", None, "", "  \n", "Ünïcode ÷ × word's<|endoftext|>", "x" * 600,
             "é" * 255 + " " + "é" * 256, "a\xa0b \u2003c d\x1ce", "слово и plain", "слово 中文 😀 e\u0301",
             " lead and trail ", "< | <|", "İı ß ẞ Å"]


def test_texts_together_equal_the_library():
    own = tokens.WordIds(public_tokenizers.path("word_bpe_49k.json"), cache_words=2)
    for rows in (ODD_TEXTS, ODD_TEXTS[::-1], ODD_TEXTS[2:4], [None]):
        for kind in (pa.string(), pa.large_string()):
            col = pa.array(["cut off", *rows], kind)[1:]
            ids, off = own.texts(col)
            assert [ids[s:e].tolist() + [2] for s, e in zip(off[:-1], off[1:], strict=True)] == [
                ids_of(t) for t in rows]


def test_words_cost_little_more_than_their_encoder():
    own = tokens.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    r = np.random.default_rng(4)

    def seconds(step, *args):
        began = time.process_time()
        step(*args)
        return time.process_time() - began

    def text():  # new words each time, each of them about five times
        words = ["".join(map(chr, w)) for w in r.integers(97, 123, size=(40_000, 7))]
        return words, " ".join(words[i] for i in r.integers(0, len(words), size=200_000))

    ratios = []
    for _ in range(5):
        words, whole = text()
        bare = seconds(own.pieces.encode_to_numpy, "\n".join(words) + "\n")
        ratios.append(seconds(own.ids, whole) / bare)
    assert min(ratios) < 3


def test_token_files_round_trip(spark, ugly, empty):
    path = shared_path(spark, "tok")
    tokens.write_tokens(ugly, path)
    back = tokens.read_tokens(spark, path).collect()
    want = sorted(((r.doc_id is not None, r.doc_id or 0), ids_of(r.text)) for r in ugly.collect())
    got = sorted(((r.doc_id is not None, r.doc_id or 0), list(r.tokens)) for r in back)
    assert got == want
    rows = sorted(back, key=lambda r: r.start)
    assert [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows])[:-1])
    assert [r.doc_id for r in rows if r.doc_id is not None] == sorted(
        r.doc_id for r in rows if r.doc_id is not None) and rows[0].doc_id is None
    counters = tokens.read_tokens(spark, path, tokens=False, first_id=8)
    assert counters.columns == ["doc_id", "start", "n_tokens"] and counters.count() == 3
    path = shared_path(spark, "tok")
    tokens.write_tokens(empty, path)
    assert tokens.read_tokens(spark, path).count() == 0


def test_token_file_encodings(spark, ugly):
    path = shared_path(spark, "tok")
    tokens.write_tokens(ugly, path)
    file = spark.read.parquet(f"{path}/data").inputFiles()[0].removeprefix("file://")
    meta = pq.ParquetFile(file).metadata.row_group(0)
    kinds = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert "RLE_DICTIONARY" in str(kinds["tokens.list.element"].encodings)
    assert "DELTA_BINARY_PACKED" in str(kinds["doc_id"].encodings)
    assert kinds["doc_id"].has_column_index and kinds["doc_id"].has_offset_index


def test_list_crc32(spark):
    d = spark.createDataFrame([(1, [5, 6]), (2, [])], "doc_id bigint, tokens array<int>")
    assert {r.doc_id: r.c for r in tokens.list_crc32(d, "tokens", "c").collect()} == {
        1: crc([5, 6]), 2: crc([])}


@pytest.mark.parametrize("seed", range(60))
def test_cuts_cost_least(seed):
    r = np.random.default_rng(seed)
    total, window = int(r.integers(1, 500)), 64
    ends = np.unique(np.append(r.integers(1, total + 1, size=r.integers(1, 8)), total))
    marks = np.unique(r.integers(1, total + 1, size=r.integers(0, 30)))
    pos, pen = packing.candidates(ends, marks[marks < total], total, 4, 2.0, 32.0)
    least = [0.0] + [np.inf] * (len(pos) - 1)
    for j in range(1, len(pos)):
        for i in range(j):
            n = int(pos[j] - pos[i])
            if n <= window:
                pad = 0 if n & (n - 1) == 0 and n >= 4 else window - n
                least[j] = min(least[j], least[i] + pad + pen[j] + packing.SEQUENCE)
    best = min(least[j] - (pen[j] if pos[j] == total else 0)
               + packing.tail_lengths(int(total - pos[j]), window, 32.0)[0]
               for j in range(len(pos)) if total - pos[j] < window)
    value, cuts = packing.best_cuts(pos, pen, window, True, 32.0, 4)
    assert value == pytest.approx(best)
    assert cuts[0] == 0 and cuts[-1] == total and (np.diff(cuts) > 0).all()
    assert (np.diff(cuts) <= window).all()


def test_pack_places_every_id_once(spark, ugly, empty):
    p = packing.pack(ugly, window=256, block_windows=4).toPandas()
    want = sorted(ids_of(r.text) for r in ugly.collect())
    p["key"] = p.doc_id.fillna(-1).astype(int).astype(str) + ":" + p.doc_tokens.astype(str)
    seqs = p.sort_values(["sequence_id", "offset"])
    lengths = seqs.groupby("sequence_id").length.sum()
    assert lengths.max() <= 256
    assert (seqs.offset == seqs.groupby("sequence_id").length.cumsum() - seqs.length).all()
    placed = []
    ids = []
    for r in seqs.itertuples():  # the order of sequences is that of documents
        if r.start == 0 and ids:
            placed.append(ids)
            ids = []
        assert r.start == len(ids) and r.length == len(r.ids) // 4
        ids += np.frombuffer(bytes(r.ids), "<u4").tolist()
    assert sorted([*placed, ids]) == want
    pad = sum(0 if n & (n - 1) == 0 else 256 - n for n in lengths)
    assert pad <= 0.05 * lengths.sum()
    assert packing.pack(empty).count() == 0
    assert packing.pack(ugly.where("doc_id = 4"), end_id=None).count() == 0
