"""Strings of special tokens in a text, and worker memories, against the plain libraries."""

from array import array

import public_tokenizers
import pytest
import tiktoken

from shelfwise.llm import byte_bpe, packing

TEXTS = ["a <|endoftext|> b", "A<|endoftext|>B c", "<|ENDOFTEXT|> Q", "Hello WORLD ÉÀ İx, fine", "<|startoftext|><|endoftext|>", "< | <|", "", " \t\n"]


def test_words_are_coded_as_the_library_does(monkeypatch):
    monkeypatch.setattr(packing, "WORDS_HELD", 3)  # generations change within these texts
    words = packing.WordCodes(public_tokenizers.path("word_bpe_49k.json"))
    for text in TEXTS * 2:
        assert array("I", words.codes(text.encode())).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
    assert packing.word_codes(public_tokenizers.path("word_bpe_49k.json")) is packing.word_codes(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("held, pairs", [(250_000, 1_000_000), (4, 10)])
def test_texts_are_coded_as_the_library_does(held, pairs, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PIECES_HELD", held)
    monkeypatch.setattr(byte_bpe, "PAIRS_HELD", pairs)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own, plain = byte_bpe.Codec(path, public_tokenizers.PATTERN), tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={}
    )
    for text in [*TEXTS, "x" * 300, "naïve 漢字 😀 " * 20] * 2:
        ids = plain.encode_ordinary(text)
        assert own.ids(text) == ids and own.digest(text)[0] == len(ids)
