import random
import re
from collections import Counter

import numpy as np

from pairrank.llm import quality_rules as R

from .conftest import SF, pairs_of


def brute(text):
    ws = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    inside = {i + k for i in range(len(ws) - 7) if windows[tuple(ws[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (len(ws), sum(map(len, ws)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def check(spark, docs, labels):
    rows = R.judge_documents(docs, labels).collect()
    got = sorted(((r.doc_id, *tuple(r)[1:6]) for r in rows), key=repr)
    assert got == sorted(((d, *brute(t)) for d, t in pairs_of(docs)), key=repr)
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.rule == 0)
    return rows


def test_small_table(spark, small_docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = check(spark, small_docs, labels)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    good = [r for r in rows if quality.get(r.doc_id) == 1 and not r.base_failed]
    low = [r for r in rows if quality.get(r.doc_id) == 0 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.98 * len(good) and sum(not r.kept for r in low) >= 0.8 * len(low)


def test_edge_cases(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (7, 1), (None, 0), (8, None)], "doc_id long, quality int")
    check(spark, edge_docs, labels)
    check(spark, edge_docs, labels.where("false"))
    assert R.judge_documents(no_docs, labels).count() == 0
    tail = "w0 w1 w2 w3 w4 w5 w6 w7 w8"
    repeats = [(1, f"{tail} x {tail} y {tail[:-3]}"), (2, "a " * 40), (3, "a\na\n a\na \n\n\na"), (4, "#*$%&|<>" * 9),
               (5, "é ü " * 30), (6, f"{tail}\n{tail}")]
    check(spark, spark.createDataFrame(repeats, "doc_id long, text string"), labels)


def planted(n, seed):
    """Three features of ``R.FEATURES`` order are telling: low is (f0 > 0.5) or (f1 > 0.6 and f2 <= 0.3)."""
    rnd = np.random.default_rng(seed)
    x = np.round(rnd.random((n, 5)), 4)
    return x, (x[:, 0] > 0.8) | ((x[:, 1] > 0.6) & (x[:, 2] <= 0.3))


def test_learns_a_planted_list():
    names = [f"f{k}" for k in range(5)]
    x, low = planted(3000, 1)
    prune = np.arange(len(x)) % 3 == 0
    rules = R.learn(x, low, np.ones(len(x)), prune, names)
    fresh, truth = planted(4000, 2)
    assert 2 <= len(rules.rules) <= 6
    assert ((rules.first(fresh, names) > 0) == truth).mean() > 0.985
    assert {c.feature for rule in rules.rules for c in rule} <= {"f0", "f1", "f2"}


def test_noise_gives_no_rules():
    rnd = np.random.default_rng(3)
    x, low = rnd.random((2000, 4)), rnd.random(2000) < 0.2
    assert R.learn(x, low, np.ones(2000), np.arange(2000) % 3 == 0, list("abcd")).rules == []


def test_grown_condition_is_the_best_of_all():
    rnd = random.Random(4)
    names = ["a", "b"]
    for _ in range(30):
        x = np.array([[rnd.randrange(6), rnd.randrange(6)] for _ in range(25)], float)
        low = np.array([rnd.random() < 0.3 + 0.1 * r[0] for r in x])
        weight = np.array([rnd.choice([1.0, 2.5]) for _ in x])

        def gain(rows):
            p, n, p0, n0 = (weight[m].sum() for m in (rows & low, rows & ~low, low, ~low))
            return p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else 0.0
        c = R.best_condition(x, low, weight, names)
        best = max([gain(x[:, f] > t) for f in (0, 1) for t in range(6)] + [gain(x[:, f] <= t) for f in (0, 1) for t in range(6)])
        assert (c is None and best < 1e-6) or abs(gain(c.holds(x, names)) - best) < 1e-9


def test_expression_and_matrix_agree(spark, small_docs):
    """The emitted Spark conditions fire as the learnt list does on the same numbers, in order."""
    rules = R.RuleList([[R.Condition("words", False, 60), R.Condition("symbols_share", False, 0.02)],
                        [R.Condition("distinct_share", False, 0.75)], [R.Condition("capitals_share", True, 0.05)]])
    of = R.features()
    rows = R.statistics(small_docs).select(*[c.alias(n) for n, c in of.items()], rules.column().alias("rule")).collect()
    x = np.array([[r[n] for n in of] for r in rows])
    assert rules.first(x, list(of)).tolist() == [r.rule for r in rows] and len({r.rule for r in rows}) > 2
    assert str(rules).startswith("1. low if words <= 60 and symbols_share <= 0.02\n2. low if")
    empty = small_docs.limit(1).select(R.RuleList().column().alias("rule")).first()
    assert empty.rule == 0


def test_threshold_is_short_and_between():
    for a, b in ((0.0, 0.5), (3.0, 3.001), (1.0, 2.0), (0.1, 100.0), (1.0, np.nextafter(1.0, 2))):
        t = R.between(a, b)
        assert a <= t < b
    assert R.between(0.0, 1.0) in (0.5, 0.25) and R.between(2.0, 9.0) == 6.0
