import random

import pytest

from pairrank.llm import near_dedup as N
from pairrank.llm.components import components

from .conftest import pairs_of


def shingles(text, width):
    w = text.encode().lower().split()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def brute(rows, width):
    sets = [shingles(t, width) for _, t in rows]
    of = list(range(len(rows)))
    by = {}
    for i, s in enumerate(sets):
        count = {}
        for g in s:
            for j in by.setdefault(g, []):
                count[j] = count.get(j, 0) + 1
            by[g].append(i)
        for j, c in count.items():
            if c * 100 >= 80 * (len(s) + len(sets[j]) - c):
                a, b = of[i], of[j]
                of = [b if x == a else x for x in of]
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if of[j] == of[i] and rows[j][0] is not None]
        component = d if not sets[i] else min(ids, default=None)
        out.append((d, len(sets[i]), component, d == component))
    return sorted(out, key=repr)


def check(docs, width):
    got = sorted((tuple(r) for r in N.near_duplicates(docs, width).collect()), key=repr)
    assert got == brute(pairs_of(docs), width)


@pytest.mark.parametrize("width", [2, 5])
def test_edge_cases(edge_docs, no_docs, width):
    check(edge_docs, width)
    assert N.near_duplicates(no_docs, width).count() == 0
    kept = N.drop_near_duplicates(edge_docs, width)
    assert kept.columns == edge_docs.columns and kept.where("doc_id = 3").count() == 0


def test_small_table(small_docs):
    check(small_docs, 2)


def test_large_groups_stay_whole(spark):
    """Copies of one text that are only similar to it, not to each other, and a chain."""
    rnd = random.Random(7)
    word = [f"w{k}" for k in range(4000)]
    rows = []
    hub = rnd.sample(word, 120)
    rows.append((500, " ".join(hub)))
    for k in range(150):
        text = list(hub)
        for at in rnd.sample(range(120), 6):
            text[at] = f"v{k}x{at}"
        rows.append((1000 + k, " ".join(text)))
    chain = rnd.sample(word, 150)
    for k in range(40):
        chain[3 * k] = f"c{k}"
        rows.append((2000 + k, " ".join(chain)))
    rows += [(3000 + k, " ".join(rnd.sample(word, 80))) for k in range(100)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), 2)


def test_pairs_that_share_large_regions_only(spark):
    """A family of one template whose members are at 0.74 to each other, and planted pairs at 0.81 among them."""
    rnd = random.Random(3)
    word = [f"t{k}" for k in range(170)]
    rows = []

    def member(tag):
        return word + [f"m{tag}x{j}" for j in range(30)]
    for k in range(400):
        rows.append((k, " ".join(member(k))))
    for k in range(40):
        text = member(k)
        for at in rnd.sample(range(170, 200), 21):
            text[at] = f"p{k}x{at}"
        rows.append((1000 + k, " ".join(text)))
    check(spark.createDataFrame(rows, "doc_id long, text string"), 1)


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 200) if i % 50] + [(300, 299), (301, 299), (302, 301), (400, 400)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: (i - 1) // 50 * 50 + 1 for i in range(1, 201) if i % 50 != 1} | {300: 299, 301: 299, 302: 299}


def test_dropping_goes_by_row(spark):
    """Rows that repeat a doc_id go by their own texts; equal rows and null ids leave one."""
    a, b, c, d = (" ".join(f"{k}{j}" for j in range(30)) for k in "abcd")
    rows = [(8, a), (8, b), (3, b), (1, c), (1, c), (None, d), (None, d), (None, d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in N.drop_near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(8, a), (3, b), (1, c), (None, d)], key=repr)
