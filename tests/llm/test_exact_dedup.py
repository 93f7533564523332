import hashlib
import random
import re

from pairrank.llm import exact_dedup as X

from .conftest import pairs_of


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t).encode()).hexdigest(), []).append((d, t))
    out = []
    for sha, g in groups.items():
        keep = min(g, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0]
        out += [(d, keep, len(g), d == keep, sha) for d, _ in g]
    return sorted(out, key=repr)


def check(docs):
    got = sorted((tuple(r) for r in X.exact_duplicates(docs).collect()), key=repr)
    assert got == brute(pairs_of(docs))


def test_edge_cases(edge_docs, no_docs):
    check(edge_docs)
    assert X.exact_duplicates(no_docs).count() == 0
    kept = X.drop_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns and X.drop_duplicates(no_docs).count() == 0
    assert kept.where("doc_id IN (1, 2)").count() == 0 and kept.where("doc_id IN (3, 6)").count() == 2


def test_small_table(small_docs):
    check(small_docs)


def _digests(n, seed=0):
    rnd = random.Random(seed)
    return [rnd.randbytes(32) for _ in range(n)]


def test_filter_resizes_and_deletes():
    index, keys = X.ShardIndex(buckets=2), _digests(5000)
    for k in keys:
        assert index.find(k) is None
        index.insert(k, True)
    assert index.resizes > 5 and all(index.find(k) for k in keys)
    for k in keys[::2]:
        assert index.delete(k) and not index.delete(k)
    assert index.size == 2500
    assert all((index.find(k) is not None) == (i % 2 == 1) for i, k in enumerate(keys))
    back = X.ShardIndex.from_bytes(index.to_bytes())
    assert sorted(back.keys()) == sorted(keys[1::2]) and all(back.find(k) for k in keys[1::2])


def test_false_positive_is_verified():
    """Two keys with one fingerprint and bucket: the content tells them apart."""
    a, b = bytes(10) + b"a" * 22, bytes(10) + b"b" * 22
    index = X.ShardIndex()
    index.insert(a, True)
    assert b in index.filter and index.find(b) is None and index.false_hits == 1
    index.insert(b, True)
    assert index.delete(a) and index.find(b) and index.find(a) is None


def test_index_table(spark):
    keys = _digests(400, 3)
    first = spark.createDataFrame([(i, "insert", bytearray(k)) for i, k in enumerate(keys)] + [(900, "insert", None)],
                                  "seq long, op string, digest binary")
    index = X.change_index(None, first, shards=5)
    changes = spark.createDataFrame(
        [(i, "delete", bytearray(k)) for i, k in enumerate(keys[:100])] + [(500, "insert", bytearray(keys[0]))],
        "seq long, op string, digest binary")
    index = X.change_index(index, changes, shards=5)
    assert index.agg({"n_keys": "sum"}).first()[0] == 301
    asked = spark.createDataFrame([(bytearray(k),) for k in keys + _digests(50, 9)], "digest binary")
    live = {bytes(r.digest): r.live for r in X.probe_index(index, asked, shards=5).collect()}
    assert all(live[k] == (i == 0 or i >= 100) for i, k in enumerate(keys)) and sum(live.values()) == 301


def test_dropping_goes_by_row(spark):
    """Rows that repeat a doc_id go by their own texts; equal rows and null ids leave one."""
    a, b, c, d = (" ".join(f"{k}{j}" for j in range(30)) for k in "abcd")
    rows = [(8, a), (8, b), (3, b), (1, c), (1, c), (None, d), (None, d), (None, d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in X.drop_duplicates(docs).collect()), key=repr)
    assert got == sorted([(8, a), (3, b), (1, c), (None, d)], key=repr)
