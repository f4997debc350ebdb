"""The codec against the library, ids and decoded texts."""

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from rows_util import ordered

from transitlens.llm import piece_codec

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PIECES = piece_codec.Pieces(PATH)


def ids_of(text):
    ids, stops = PIECES.encode([text])
    return ids[:stops[0]].tolist()


def test_documents(spark, docs, rows):
    ids = piece_codec.encode(docs, PATH)
    out = piece_codec.decode(ids, PATH, into="text")
    want = []
    for i, text, _ in rows:
        x = [*LIBRARY.encode(text or ""), LIBRARY.eos_id()]
        want.append((i, x, LIBRARY.decode(x)))
    assert ordered([(r["doc_id"], list(r["ids"]), r["text"]) for r in out.collect()]) == ordered(want)


def test_empty(spark, empty):
    ids = piece_codec.encode(empty, PATH)
    assert ids.collect() == [] and ids.columns == ["doc_id", "ids"]
    assert piece_codec.decode(ids, PATH).columns == ["doc_id", "ids", "decoded"]


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, [264, 2], "x", "old"), (2, None, None, "old"), (3, [], "z", None)], "ids2 int, ids array<int>, keep string, decoded string")
    out = piece_codec.decode(df, PATH)
    assert out.columns == ["ids2", "ids", "keep", "decoded"]
    assert ordered([(r["ids2"], r["keep"], r["decoded"]) for r in out.collect()]) == [(1, "x", "a"), (2, None, ""), (3, "z", "")]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab e\n\t▁th in <s>/\x00é́😀①ﬁ　中文\r�"), max_size=60) | st.text(max_size=60))
def test_any_text(text):
    want = [*LIBRARY.encode(text), LIBRARY.eos_id()]
    assert ids_of(text) == want
    assert PIECES.decode(*PIECES.encode([text])) == [LIBRARY.decode(want)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 300) | st.integers(0, 31_999), max_size=20))
def test_any_ids(ids):
    """Lists of ids that no text gives: broken byte runs, control and unknown ids, marks in the middle."""
    import numpy as np

    assert PIECES.decode(np.array(ids, np.int64), np.array([len(ids)])) == [LIBRARY.decode(ids)]


@pytest.mark.parametrize("text", ["x" * 4_000, "ab" * 2_000, " " * 300, "aaaab" * 900, "=" * 1_001, "中" * 500])
def test_long_units(text):
    assert ids_of(text)[:-1] == LIBRARY.encode(text)


def test_random_words_step_back():
    """Without spaces, the longest piece is often wrong: the walk steps back and still ends with the merges."""
    rng = random.Random(2)
    text = "".join(rng.choice("etaoinshr") for _ in range(30_000))
    assert ids_of(text)[:-1] == LIBRARY.encode(text)


def test_neighbours():
    """What goes together is what merging gives, piece by piece."""
    for word in ("▁internationalization", "▁unbelievable", "▁aaaaaaa"):
        parts = PIECES.remerge(word)
        assert parts == LIBRARY.encode(word[1:], out_type=str)


def test_worker_starts_anew(monkeypatch):
    monkeypatch.setattr(piece_codec, "KEPT_UNITS", 3)
    monkeypatch.setattr(piece_codec, "PAIR_SLOTS", 3)
    p = piece_codec.Pieces(PATH)
    for text in ("one two three four", "five six seven", "one two", ""):
        ids, stops = p.encode([text, text])
        want = [*LIBRARY.encode(text), 2]
        assert ids.tolist() == want * 2 and stops.tolist() == [len(want), 2 * len(want)]


def test_foreign_id():
    with pytest.raises(ValueError):
        PIECES.decode(*map(__import__("numpy").array, ([40_000], [1])))
