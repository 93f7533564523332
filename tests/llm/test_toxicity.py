import math
import random
import zlib

import numpy as np

from pairrank.llm import toxicity as T

from .conftest import SF


def test_index_is_exact():
    rnd = random.Random(9)
    vectors = []
    for _ in range(500):
        at = np.array(sorted(rnd.sample(range(60), rnd.randrange(1, 8))))
        w = np.array([rnd.choice([0.5, 1, 2]) for _ in at])
        vectors.append((at, w / math.sqrt(w @ w)))
    index = T.BlockMaxIndex(vectors, list(range(1000, 1500)))
    dense = np.zeros((500, 60))
    for k, (at, w) in enumerate(vectors):
        dense[k, at] = w
    for k in range(60):
        cos, places = index.nearest(*vectors[k], 10, but=1000 + k if k % 2 else None)
        want = sorted((-round(float(c), 9), i) for i, c in enumerate(dense @ dense[k]) if c > 0 and not (k % 2 and i == k))[:10]
        assert [(-c, index.ids[p] - 1000) for c, p in zip(cos, places)] == want


def test_isotonic_never_falls():
    rnd = np.random.default_rng(1)
    x = np.round(rnd.random(300), 2)
    steps, values = T.isotonic(x, (rnd.random(300) < x).astype(float), np.ones(300))
    assert (np.diff(steps) > 0).all() and (np.diff(values) >= 0).all() and 0 <= values.min() <= values.max() <= 1


def test_held_out_accuracy_and_fold(spark):
    docs, labels = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet"), spark.read.parquet(f"{SF}/../sf0.01/labels.parquet")
    got = T.score(docs, T.fit(docs, labels)).join(labels.select("doc_id", "toxic"), "doc_id", "left").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out and r.toxic is not None]
    assert sum(r.predicted == r.toxic for r in held) >= 0.93 * len(held)
    assert all(r.toxic for r in held if r.predicted)
    assert any(r.evidence for r in got if r.predicted)


def test_edge_cases(spark, edge_docs, no_docs):
    ids = [i for i in range(100, 400) if zlib.crc32(str(i).encode()) % 5]
    train = spark.createDataFrame([(i, "you idiot fool" if i % 2 else "kind words here", "x") for i in ids],
                                  "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids] + [(None, 1, 0), (ids[0], None, 0), (ids[1], ids[1] % 2, 0)],
                                   "doc_id long, toxic int, score int")
    model = T.fit(train, labels)
    got = T.score(edge_docs, model).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.score <= 1 for r in got)
    asked = spark.createDataFrame([(1, "such an IDIOT, a fool"), (2, "words so kind"), (3, None)], "doc_id long, text string")
    by_id = {r.doc_id: r for r in T.score(asked, model).collect()}
    assert by_id[1].predicted == 1 and by_id[2].predicted == 0 and by_id[1].score > by_id[3].score
    assert T.score(no_docs, model).count() == 0
    assert [r.doc_id for r in T.drop_toxic(asked, labels.where("false")).collect()] == [1, 2, 3]
    for one_class in (labels.where("toxic = 0"), labels.where("false")):
        assert all(r.score == 0 for r in T.score(asked, T.fit(train, one_class)).collect())
    kept = T.drop_toxic(edge_docs, labels)
    assert kept.columns == edge_docs.columns


def test_labels_of_the_held_out_fold_are_not_learnt(spark):
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 5 == 0][:200]
    docs = spark.createDataFrame([(i, "idiot" if i % 2 else "kind") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    assert not T.fit(docs, labels).place
