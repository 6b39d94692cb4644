import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
MODEL = pieces.load(PATH)


def _same(text):
    ids = MODEL.encode(text)
    assert ids == LIB.encode(text, add_eos=True)
    assert MODEL.decode(ids) == LIB.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), st.text("aabetinh  ▁\n<s>/0é中🔥\x00.,", max_size=60)))
def test_any_text(text):
    _same(text)


@pytest.mark.parametrize("text", ["", " ", "   a   b ", "▁", "<s></s><unk>", "a" * 20_000, " " * 20_000, "ab" * 20_000, "中" * 3000, "\n" * 20_000, "the " * 20_000, "﻿x", "\x00"])
def test_odd_texts(text):
    _same(text)


def test_random_ids_decode():
    rng = random.Random(7)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(3), rng.randrange(3, 300), rng.randrange(32_000)]) for _ in range(rng.randrange(12))]
        assert MODEL.decode(ids) == LIB.decode(ids)


def test_words_against_merging():
    rng = random.Random(8)
    for _ in range(2000):
        word = "".join(rng.choice("▁aeinrstthdlo") for _ in range(rng.randrange(1, 14)))
        assert [MODEL.strings[i] for i in MODEL.segment(word)] == MODEL.merge(word)


def test_stores_are_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 5)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 5)
    own = pieces.PieceModel(PATH)
    for i in range(300):
        text = f"word{i} is number {i * 7919}"
        assert own.encode(text) == LIB.encode(text, add_eos=True)
        assert len(own.kept) <= 5 and len(own.pairs) <= 5


def test_columns(spark):
    df = spark.createDataFrame([(1, None, [9]), (2, "", [9]), (2, "", [9]), (3, "hello wörld\n", [9]), (None, "x " * 50_000, [9])], "doc_id long, text string, ids array<int>")
    encoded = pieces.encode_column(df, PATH, carry=["doc_id"])
    back = pieces.decode_column(encoded, PATH, carry=["doc_id"])
    assert {(r.doc_id, r.text) for r in back.collect()} == {(1, ""), (2, ""), (3, "hello wörld\n"), (None, "x " * 50_000)}
    for r in pieces.encoding_digest(df, PATH, carry=["doc_id"]).collect():
        text = {1: "", 2: "", 3: "hello wörld\n", None: "x " * 50_000}[r.doc_id]
        ids = LIB.encode(text, add_eos=True)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIB.decode(ids).encode()).hexdigest()
    assert pieces.encoding_digest(df.limit(0), PATH).count() == 0
