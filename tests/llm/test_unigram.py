from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from rows import documents, hard
from wardline.llm.trie import DoubleArray, batches
from wardline.llm.unigram import MARK, codec, decode, digests, encode


@pytest.fixture(scope="module")
def own():
    return codec()


@given(st.sets(st.binary(min_size=1, max_size=5), min_size=1, max_size=40), st.lists(st.binary(max_size=12), max_size=8))
@settings(max_examples=60, deadline=None)
def test_trie(strings, words):
    strings = sorted(strings)
    trie = DoubleArray.build(strings, range(len(strings)))
    found = set()
    for places, letters, size in batches(words):
        for start, end, rows, ids in trie.walk(letters, size):
            found |= {(int(places[r]), start, end, int(i)) for r, i in zip(rows, ids, strict=True)}
    assert found == {
        (w, i, i + len(s), k)
        for w, word in enumerate(words)
        for k, s in enumerate(strings)
        for i in range(len(word))
        if word.startswith(s, i)
    }


def best(own, text: str) -> float:
    """The best score of a text, letter by letter over the whole of it."""
    shown = MARK + text.replace(" ", MARK)
    piece = {own.pieces.shown[i].decode(): own.pieces.scores[i] for i in own.pieces.ordinary}
    score = [0.0] + [-np.inf] * len(shown)
    for i in range(len(shown)):
        for j in range(i + 1, min(len(shown), i + 48) + 1):
            if shown[i:j] in piece:
                score[j] = max(score[j], score[i] + piece[shown[i:j]])
        if shown[i] not in piece:
            score[i + 1] = max(score[i + 1], score[i] + own.unknown)
    return score[-1]


@given(st.text(st.sampled_from("abeth in.,éß漢🙂\n\x00"), max_size=30))
@settings(max_examples=80, deadline=None)
def test_round_trip_and_best_score(own, text):
    ids, score = own.encode([text])[0]
    found = np.frombuffer(ids, "<u4")
    assert own.decode(found) == text
    if text:
        assert score == pytest.approx(best(own, text))


@given(st.text(max_size=40))
@settings(max_examples=80, deadline=None)
def test_any_text(own, text):
    ids, _ = own.encode([text])[0]
    assert own.decode(np.frombuffer(ids, "<u4")) == text.replace(MARK, " ")


def test_against_the_library(own):
    """The library encodes by Viterbi when the file says so; it may miss the best path, but must not beat it."""
    model = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    library = SentencePieceProcessor(model_proto=model.SerializeToString())
    texts = ["Hello world, thinking of things", "the quick brown fox", "mañana été Öffnung", "x", "a b c"]
    same = 0
    for text, (ids, score) in zip(texts, own.encode(texts), strict=True):
        theirs = library.encode(text)
        assert sum(own.pieces.scores[i] for i in theirs) <= score
        assert own.decode(np.array(theirs)) == library.decode(theirs) == text
        same += np.frombuffer(ids, "<u4").tolist() == theirs
    assert same >= 3


def test_rows(spark, own):
    df = hard(spark)
    rows = digests(df).collect()
    assert len(rows) == df.count()
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect() if r["doc_id"] is not None}
    for r in rows:
        if r["doc_id"] is not None:
            text = texts[r["doc_id"]]
            assert r["round_trip"] == (MARK not in text)
            assert r["decoded_crc32"] == zlib.crc32(text.replace(MARK, " ").encode())
            ids, score = own.encode([text])[0]
            assert (r["n_ids"], r["ids_crc32"], r["score"]) == (len(ids) // 4, zlib.crc32(ids), pytest.approx(score))
    encoded = encode(df)
    assert encoded.columns == [*df.columns, "pieces"]
    back = decode(encoded.select("doc_id", "text", "pieces.ids")).collect()
    assert all(r["decoded"] == (r["text"] or "").replace(MARK, " ") for r in back)


def test_empty(spark):
    assert digests(documents(spark)).count() == 0
    assert encode(documents(spark)).count() == 0
