import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from pairrank.llm import spelling as S

from .conftest import pairs_of


def distance_one(a, b):
    """Whether some deletion, insertion or replacement of one letter makes a into b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows):
    n = Counter()
    for d, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
        for w in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'null' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [] for w in n}
    for a, b in itertools.combinations(sorted(n, key=len), 2):
        if len(b) - len(a) <= 1 and distance_one(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w], 0)) for w in n)


def got(docs, **options):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0)
                  for r in S.spelling_variants(docs, **options).collect())


def spelt_docs(spark, n=60, seed=3):
    """Words of a small alphabet with typos, some of them chains of ever rarer forms, and one very long word."""
    rnd = random.Random(seed)
    roots = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(7, 10))) for _ in range(40)]
    rows = []
    for d in range(n):
        out = []
        for _ in range(60):
            w = rnd.choice(roots[:8] if rnd.random() < 0.8 else roots)
            if rnd.random() < 0.08:
                at = rnd.randrange(len(w))
                w = rnd.choice([w[:at] + w[at + 1:], w[:at] + rnd.choice("abcde") + w[at:], w[:at] + rnd.choice("xyz") + w[at + 1:]])
            out.append(w.upper() if rnd.random() < 0.1 else w)
        rows.append((d, " ".join(out)))
    rows += [(200, "y" * 300 + " " + "y" * 300), (201, "y" * 299 + "z " + "y" * 299 + "z"),
             (202, "chained " * 1500 + "chaimed " * 110 + "chaimex " * 9 + "chaimey " * 3)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("options", [{}, {"subtree": 25}, {"groups": 4, "top": 1, "subtree": 7}, {"groups": 3, "subtree": 10}])
def test_against_brute_force(spark, options):
    """Also with subtrees opened level by level, and with leaves dealt into parts."""
    docs = spelt_docs(spark)
    rows = got(docs, **options)
    assert rows == brute(pairs_of(docs))
    assert any(r[4] > 3 for r in rows) and any(r[1] and r[1] != r[2] for r in rows)


def test_edge_cases(edge_docs, no_docs, small_docs):
    assert got(edge_docs) == brute(pairs_of(edge_docs))
    assert got(no_docs) == []
    assert got(small_docs) == brute(pairs_of(small_docs))


def test_verification():
    rnd = random.Random(1)
    words = ["".join(rnd.choice("ab") for _ in range(rnd.choice([3, 4, 5, 70, 71]))) for _ in range(120)]
    words += [w[:-1] + "c" for w in words[:60]] + [w + "c" for w in words[60:]]
    spelled = S.Spelled([w.encode("latin-1") for w in words])
    pairs = list(itertools.product(range(len(words)), repeat=2))
    a, b = (S.np.array(x) for x in zip(*pairs))
    assert spelled.near(a, b).tolist() == [distance_one(words[x], words[y]) if words[x] != words[y] else False for x, y in pairs]
    assert all(S.one_edit(words[x], words[y]) == (words[x] != words[y] and distance_one(words[x], words[y])) for x, y in pairs)


def test_trie_search_spends_one_surplus_and_one_deficit():
    rnd = random.Random(2)
    v = S.np.array([[rnd.choice([0, 1, 2, 255]) for _ in range(5)] for _ in range(150)], S.np.uint8)
    budget = S.np.ones(len(v), S.np.int64)
    found = set()
    for q, m in S.Trie(v).search(v, budget, budget):
        found |= set(zip(q.tolist(), m.tolist()))
    diff = v[None].astype(int) - v[:, None]
    want = (S.np.maximum(diff, 0).sum(2) <= 1) & (S.np.maximum(-diff, 0).sum(2) <= 1)
    assert found == set(zip(*(x.tolist() for x in S.np.nonzero(want))))
