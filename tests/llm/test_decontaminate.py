import random

import numpy as np

from pairrank.llm import decontaminate as D

from .conftest import SF, pairs_of


def least_edits(item, text):
    row = np.zeros(len(text) + 1, int)
    for ch in item:
        new = np.append(row[0] + 1, np.minimum(row[:-1] + (text != ch), row[1:] + 1))
        steps = np.arange(len(new))
        row = np.minimum.accumulate(new - steps) + steps
    return row.min()


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_edited_items_against_alignment(spark):
    rnd = random.Random(3)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hosts = [t for _, t in pairs_of(spark.read.parquet(f"{SF}/documents.parquet").limit(30))]
    index = D.ItemIndex(items)
    for _ in range(120):
        item_id, item = rnd.choice(items)
        item = D.normal(item)
        budget, made = int(len(item) * D.BUDGET), list(item)
        for _ in range(rnd.randrange(budget + 3)):
            at = rnd.randrange(len(made))
            what = rnd.randrange(3)
            made[at:at + (what > 0)] = rnd.choice("abcdefgh ") if what < 2 else ""
        host = rnd.choice(hosts)[:1500]
        cut = rnd.randrange(len(host) + 1)
        text = D.normal(host[:cut] + " " + "".join(made) + " " + host[cut:])
        got = [o for o in index.occurrences(text) if o[0] == item_id]
        least = least_edits(D.codes(item), D.codes(text))
        assert bool(got) == (least <= budget)
        if got:
            assert got[0][3] == least == edits(item, text[got[0][1]:got[0][2]])


def test_table_against_substrings(spark, small_docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in D.find_items(small_docs, items).where("distance = 0").collect()}
    assert found == {(d, i.item_id) for d, t in pairs_of(small_docs) for i in items.collect()
                     if D.normal(i.text) in D.normal(t)}
    kept = D.drop_contaminated(small_docs, items)
    assert kept.columns == small_docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in pairs_of(small_docs)} - \
        {r.doc_id for r in D.find_items(small_docs, items).collect()}


def test_edge_cases(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "word", "x"), (4, "gamma  DELTA", "x"), (None, "Ünïcödé", "x"),
                                   (3, "word", "x")], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in D.find_items(edge_docs, items).collect()}
    texts = pairs_of(edge_docs)
    assert {d for d, i in got if i == 3} == {9, 10} and (13, None) in got
    assert {d for d, i in got if i == 4} == {d for d, t in texts if "gamma delta" in D.normal(t)}
    assert D.find_items(no_docs, items).count() == 0
    assert D.find_items(edge_docs, items.where("false")).count() == 0
    assert D.drop_contaminated(edge_docs, items.where("false")).count() == len(texts)


def test_blocks_of_items_find_the_same(spark, small_docs, monkeypatch):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = sorted(map(tuple, D.find_items(small_docs, items).collect()))
    monkeypatch.setattr(D, "BLOCK_CHARS", 3000)
    assert sorted(map(tuple, D.find_items(small_docs, items).collect())) == want


def test_every_place_of_short_items(spark):
    docs = spark.createDataFrame([(1, "cab x cab cabcab"), (2, "aaaa")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "cab"), (8, "aaa")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.start, r.end) for r in D.find_items(docs, items).collect())
    assert got == [(1, 7, 0, 3), (1, 7, 6, 9), (1, 7, 10, 13), (1, 7, 13, 16), (2, 8, 0, 3)]


def test_blocks_one_after_another(spark, small_docs, monkeypatch):
    """Many small blocks find and drop what one does."""
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(map(tuple, D.find_items(small_docs, items).collect()))
    clean = sorted(r.doc_id for r in D.drop_contaminated(small_docs, items).collect())
    chars = sum(len(r.text or "") for r in items.collect())
    monkeypatch.setattr(D, "BLOCK_CHARS", chars // 3)
    assert sorted(map(tuple, D.find_items(small_docs, items).collect())) == whole and whole
    kept = D.drop_contaminated(small_docs, items)
    assert kept.columns == small_docs.columns and sorted(r.doc_id for r in kept.collect()) == clean
