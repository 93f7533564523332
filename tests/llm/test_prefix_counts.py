import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pairrank.llm import prefix_counts as C

from .conftest import pairs_of

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def test_every_prefix_equals_encoding_it(tok):
    rnd = random.Random(8)
    letters = list("abcdefghinorst'' ,.!<|>/w\n1é") + ["<|endoftext|>", "'re", "the", "ing", "</w>"]
    count = C.PrefixCounter(PATH)
    texts = ["Hello's world'RE don't!! 'sx''ve", "a<|startoftext|><|endoftext|>b", "straße Éa", ""]
    for text in texts + ["".join(rnd.choice(letters) for _ in range(rnd.randrange(40))) for _ in range(150)]:
        got = np.cumsum(next(count.differences([text]))).tolist()
        assert got == [len(tok.encode(text[:k], add_special_tokens=False).ids) for k in range(1, len(text) + 1)], text


def test_counts(edge_docs, no_docs, small_docs, tok):
    for docs in (edge_docs, small_docs):
        got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in C.prefix_counts(docs, PATH).collect()), key=repr)
        assert got == sorted(((d, len(t.encode()), len(tok.encode(t, add_special_tokens=False).ids))
                              for d, t in pairs_of(docs)), key=repr)
        table = C.prefix_counts(docs, PATH)
        assert got == sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in C.whole_counts(table).collect()), key=repr)
    assert C.prefix_counts(no_docs, PATH).count() == 0 and C.whole_counts(C.prefix_counts(no_docs, PATH)).count() == 0


def test_packed_differences():
    for d in ([], [0, 1, 1, 0, -1, 2], [1] * 500, [127, -128, 0], [128, 0, -5], [-129], [70_000, -3]):
        assert C.unpack(C.pack(np.array(d, np.int32))).tolist() == np.cumsum(d).astype(int).tolist()


def test_truncation_and_positions(spark, small_docs, tok):
    docs = small_docs.where("length(text) < 3000").limit(30)
    table = C.prefix_counts(docs, PATH).cache()
    texts = dict(pairs_of(docs))
    for r in C.truncated(table, 50).collect():
        text = texts[r.doc_id]
        n = [len(tok.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert r.n_keep == max(k for k in range(len(text) + 1) if n[k] <= 50) and r.tokens == n[r.n_keep]
    for r in C.tokens_at(table.selectExpr("*", "30 AS at"), "at").collect():
        assert r.tokens == len(tok.encode(texts[r.doc_id][:30], add_special_tokens=False).ids)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        C.PrefixCounter(public_tokenizers.path("byte_bpe_50k.json"))


def test_a_place_is_only_asked_for_tokens_that_may_end_there():
    count = C.PrefixCounter(PATH)
    asked = []

    class Asked(dict):
        def get(self, token, default=None):
            asked.append(token)
            return dict.get(self, token, default)
    count.forms = Asked(count.forms)
    word = "qzxjkvqwzx" * 4  # no token is longer than three of these
    every = count.word_counts(word)
    assert len(every) == len(word) and len(asked) <= len(word) * (C.REACH + 1)
