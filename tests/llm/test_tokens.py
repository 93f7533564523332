import array
import random

import public_tokenizers
import pytest

from pairrank.llm.tokens import PieceEncoder

HARD = ["", " ", "a  b", "a\nb  c \n\n d ", "Hello's WORLD'RE don't", "x <|endoftext|>y <|startoftext|> z<|", " lead",
        "trail ", "İstanbul ΣΑΣ ß é ́x a b c\x1cd\x85e", "你好 世界 🙂🙂 1234 ½²", "\t\x0b\x0c\r\n",
        "a" * 3000, "é" * 500 + " ​﻿", "! 's '’s", "ſ Kelvin K Å", "</w> w</w>"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_equals_the_library(name, small_docs):
    rnd = random.Random(1)
    letters = list("ab'sS tT\n  .,!é1\t 　<|>") + ["<|endoftext|>"]
    enc = PieceEncoder(public_tokenizers.path(name), limit=2000)
    assert enc.kind == name[:4]
    texts = HARD + ["".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(800)]
    for text in texts + [r.text for r in small_docs.limit(80).collect()]:
        assert enc.ids(text) == array.array("I", enc.library.encode(text, add_special_tokens=False).ids).tobytes()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_a_pre_token_is_encoded_once(name):
    enc = PieceEncoder(public_tokenizers.path(name))
    asked, model = [], enc.model

    class Counting:
        def tokenize(self, symbols):
            asked.append(symbols)
            return model.tokenize(symbols)
    enc.model = Counting()
    text = "x word, word. word! (word word"
    got = enc.ids(text)
    assert sum("word" in s and "(" not in s for s in asked) == 1 + (name[0] == "b")  # a byte-level one has no space after (
    assert got == array.array("I", enc.library.encode(text, add_special_tokens=False).ids).tobytes()


def test_lines_within_a_piece_need_no_whole_encoding():
    """Pieces with a line feed are split at the tokenizer's own cuts; their words are remembered like others."""
    enc = PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    whole, library = [], enc.library

    class Counting:
        def encode(self, text, **how):
            whole.append(text)
            return library.encode(text, **how)
    enc.library = Counting()
    text = "some words.\nThen more words.\n\nThen ends\n\n\n12.\nThen"
    assert enc.ids(text) == array.array("I", library.encode(text, add_special_tokens=False).ids).tobytes()
    assert whole == []


def test_pieces_in_use_stay_remembered():
    """Beyond the bound the pieces asked for again are kept, not encoded again."""
    enc = PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"), limit=20)
    asked, model = [], enc.model

    class Counting:
        def tokenize(self, symbols):
            asked.append(symbols)
            return model.tokenize(symbols)
    enc.model = Counting()
    for k in range(100):
        enc.ids("x often " + "ab"[k % 2] * (k + 1))
        assert len(enc.known) + len(enc.older) <= 20
    assert sum("often" in s for s in asked) == 1
