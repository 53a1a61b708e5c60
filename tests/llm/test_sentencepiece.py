import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm import sentencepiece_prefix as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "   ", "a", " a  b ", "▁", "▁▁ a▁b", "\n\t", "日本語", "🎉🎉", "é", "<s></s><0x41>", "\x00", "ﬁ ſ", "aaaaaaaaaaaaa",
       "x" * 5000, " " * 3001, "the theother", "thetheother" * 300]


@pytest.fixture(scope="module")
def pair():
    return sp.PrefixEncoder(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(pair, text):
    own, library = pair
    ids = library.encode(text)
    assert own.encode(text).tolist() == ids
    assert own.decode([*ids, 2]) == library.decode([*ids, 2])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "e", " ", "  ", "▁", "\n", "é", "日", "🎉", "th", "er", "ing", "0", ".", "'", "ˈ"]), max_size=30))
def test_any_mixture(pair, parts):
    own, library = pair
    text = "".join(parts)
    ids = library.encode(text)
    assert own.encode(text).tolist() == ids and own.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("ids", [[], [2], [1, 2], [0], [259], [3 + 0x41], [3 + 0xE2], [3 + 0xE2, 3 + 0x96], [0, 259, 0], [3 + 0x20, 300]])
def test_decoding_of_any_ids(pair, ids):
    own, library = pair
    assert own.decode(ids) == library.decode(ids)


def test_documents(spark, folder, pair):
    library = pair[1]
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1, None), (-2, ""), (-2, ""), (None, "null id")], "doc_id bigint, text string"))
    found = sp.digests(sp.decode_ids(sp.encode_documents(docs, PATH), PATH)).collect()
    expected = []
    for r in docs.collect():
        ids = [*library.encode(r.text or ""), library.eos_id()]
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        expected.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, ids string")
    assert sp.digests(sp.decode_ids(sp.encode_documents(docs, PATH), PATH)).collect() == []


def test_pairs_against_merging(pair):
    own = pair[0]
    names = sorted(own.halves) + sorted(c for c in own.ids if len(c) == 1)[:100]
    chosen = random.Random(3)
    for _ in range(20_000):
        left, right = chosen.choice(names), chosen.choice(names)
        assert own.stand_together(left, right) == (own.merged(left + right) == [left, right])


def test_merges_out_of_order_are_merged_step_by_step(pair):
    own = sp.PrefixEncoder(PATH)
    # "bc" comes late but makes "abc" better than itself.
    own.score = {"a": 0.0, "b": 0.0, "c": 0.0, "bc": -9.0, "abc": -1.0, "ab": -10.0, "ca": -8.0}
    own.ids = {p: i for i, p in enumerate(own.score)}
    own.halves = {p: tuple(h) for p in own.ids if len(p) > 1 and len(h := own.merged(p, 2)) == 2}
    own.in_order, own.pairs = own._in_order(), {}
    assert "abc" not in own.in_order and "ca" in own.in_order
    for left in ["abc", "ca", "bc", "a"]:
        for right in ["abc", "ca", "bc", "c"]:
            assert own.stand_together(left, right) == (own.merged(left + right) == [left, right])


def test_many_texts_at_once(pair):
    own, library = pair
    chosen = random.Random(4)
    texts = ["".join(chosen.choice(["ab", "the ", "é", " ", "🎉", "日", "x" * 50, "▁", "q\u0301", "\n"]) for _ in range(chosen.randrange(30)))
             for _ in range(3000)]
    assert [i.tolist() for i in own.encode_all(texts)] == [library.encode(t) for t in texts]
    assert own.encode_all([]) == []
