import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from eventcraft.llm import wfst

LIBRARY = sentencepiece.SentencePieceProcessor(
    model_file=public_tokenizers.path("piece_bpe_32k.model"))
OWN = wfst.transducer()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8", exclude_characters="\x00"),
                                  st.sampled_from("abetino  \n\t▁éñ日x1.")), max_size=60))
def test_path_is_the_library_encoding(text):
    ids = np.frombuffer(OWN.encode(text), np.int32)
    assert ids.tolist() == LIBRARY.encode(text)
    assert OWN.decode(ids) == text.replace("▁", " ")


def test_long_runs_of_spaces():
    for n in (1, 2, 15, 16, 17, 31, 33, 200):
        for text in (" " * n, " " * n + "the", "the" + " " * n):
            assert np.frombuffer(OWN.encode(text), np.int32).tolist() == LIBRARY.encode(text)


def test_unigram_weights_take_the_cheapest_path():
    t = object.__new__(wfst.Transducer)
    t.merging, t.letters = False, set("ab")
    t.ids = {"a": 0, "b": 1, "ab": 2, "ba": 3, "aba": 4}
    t.weight = {"a": 1.0, "b": 1.0, "ab": 1.5, "ba": 0.2, "aba": 9.0}
    t.ends = {p[i:] for p in t.weight for i in range(len(p))}
    t.follow, t.byte_ids, t.unknown, t.byte_weight = {}, {}, 7, 20.0
    assert t.path("aba") == [0, 3]
    assert t.path("a?b") == [0, 7, 1]


def test_tables(spark, ugly, empty):
    d = wfst.encode(ugly)
    back = {(r.doc_id, r.text) for r in wfst.decode(d).collect()}
    assert back == {(r.doc_id, r.text or "") for r in ugly.collect()}
    assert wfst.round_trip(ugly).where("not same").count() == 0
    assert wfst.round_trip(empty).count() == wfst.decode(wfst.encode(empty)).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert {r.doc_id: r.text for r in wfst.decode(nulls).collect()} == {1: None, 2: ""}
