import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pairrank.llm import katz as K

from .conftest import pairs_of


class Brute:
    def __init__(self, rows):
        self.rows = [(d, t.encode().lower().split() + [None]) for d, t in rows]
        self.held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
        self.u, self.b, self.c = Counter(), Counter(), Counter()
        for (_, w), held in zip(self.rows, self.held):
            if not held:
                before = ["<s>", *w[:-1]]
                self.u.update(w)
                self.b.update(zip(before, w))
                self.c.update(before)
        self.n, self.v = sum(self.u.values()), len(self.u)
        self.du, self.db = (K.discounts(np.array([Counter(x.values())[r] for r in range(1, 7)], float)) for x in (self.u, self.b))
        self.unknown = 1 - sum(self.down(self.du, c) / (self.n + 1) for c in self.u.values())
        self.kept, self.low = defaultdict(float), defaultdict(float)
        for (h, w), c in self.b.items():
            self.kept[h] += self.down(self.db, c) / (self.c[h] + 1)
            self.low[h] += self.p(w)

    @staticmethod
    def down(d, c):
        return (d[c - 1] if c <= K.CUT else 1) * c

    def p(self, w):
        return self.down(self.du, self.u[w]) / (self.n + 1) if self.u[w] else self.unknown

    def q(self, h, w):
        if self.b[h, w]:
            return self.down(self.db, self.b[h, w]) / (self.c[h] + 1)
        return self.p(w) * ((1 - self.kept[h]) / (1 - self.low[h]) if self.c[h] else 1)

    def results(self):
        for (d, w), held in zip(self.rows, self.held):
            yield (d, held, len(w), sum(self.u[x] > 0 for x in w), self.n,
                   sum(math.log10((self.u[x] + 1) / (self.n + self.v + 1)) for x in w),
                   sum(math.log10(self.q(h, x)) for h, x in zip(["<s>", *w[:-1]], w)))


def check(docs):
    model = Brute(pairs_of(docs))
    want = sorted(model.results(), key=repr)
    got = sorted((tuple(r) for r in K.score_documents(docs).collect()), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], atol=1e-6)
    return model


def test_edge_cases(edge_docs, no_docs):
    check(edge_docs)
    assert K.score_documents(no_docs).count() == 0


def test_all_rows_held_out(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    docs = spark.createDataFrame([(i, "a b a") for i in held], "doc_id long, text string")
    assert all(r.score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in K.score_documents(docs).collect())


@pytest.mark.parametrize("split", [K.SPLIT, 30])
def test_small_table(small_docs, split, monkeypatch):
    """Also with contexts dealt over many buckets, and in many chunks."""
    monkeypatch.setattr(K, "SPLIT", split)
    monkeypatch.setattr(K, "CHUNK_CHARS", 100_000)
    model = check(small_docs)
    for h in list(model.c)[:25]:
        assert abs(sum(model.q(h, w) for w in model.u) + model.q(h, ("unknown",)) - 1) < 1e-9


def test_better_than_the_base_on_held_out(small_docs):
    r = K.score_documents(small_docs).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert r["sum(score)"] > r["sum(base_score)"]


def test_stored_tables(small_docs):
    _, tables = K.train_and_score(small_docs)
    model = Brute(pairs_of(small_docs))
    counts = [K.unpack(bytes(r.body)) for r in tables.words.collect()]
    assert sum(int(c.sum()) for _, c in counts) == model.n
    assert sorted(np.concatenate([K.unpack(bytes(r.body))[2] for r in tables.bigrams.collect()]).tolist()) == sorted(model.b.values())
    assert tables.weights.where("log_alpha IS NULL").count() == 0


def test_packed_arrays():
    arrays = [np.arange(5, dtype=np.uint64), np.array([1.5, -2]), np.zeros(0, np.uint32), np.array([3], np.uint8)]
    for a, b in zip(arrays, K.unpack(K.pack(*arrays))):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()
