import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docflow.llm import bpe
from tests.llm.plain import EDGE_DOCS

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.Bpe(PATH, cache_words=50)                         # a small cache, so that words are dropped and met again


def same(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "", " ", "Hello  WORLD's", "a<|endoftext|>b <|startoftext|>", "ΣΑΣ İx ﬁ é", "12½Ⅷ٣", "don't we'll I'M",
    "\x1c\x1f\x85 　 x", "😀👍🏽 漢字 한글 กำ", "_-–…!!!", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 50])
def test_texts(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcdeES'tΣσİßéÅ \t\n\x1c12½Ⅷ<|>!?😀漢한́_-"), max_size=40))
def test_any_text(text):
    same(text)


def test_frame_edges_and_clashing_columns(spark):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in EDGE_DOCS],
                                 "doc_id long, text string, ids string, decoded string")
    rows = bpe.encode(docs, PATH, decoded=True).collect()
    assert len(rows) == len(EDGE_DOCS) and set(rows[0].asDict()) == {"doc_id", "text", "ids", "decoded"}
    for r in rows:
        want = LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == LIBRARY.decode(want, skip_special_tokens=False)
    again = bpe.decode(bpe.encode(docs, PATH, keep=["doc_id"]), PATH).collect()
    assert sorted(r["decoded"] for r in again) == sorted(r["decoded"] for r in rows)


def test_empty_table(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), PATH, decoded=True).collect() == []
