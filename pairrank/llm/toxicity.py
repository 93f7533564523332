"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Learning.  At most ``EXAMPLES`` labelled documents per class (those of least
hash; the bound is a parameter) give the examples.  Their terms are kept when
the two classes use them significantly and clearly differently (G-squared of at
least ``LEAST_G2``, rates at least ``LEAST_RATIO`` apart), at most ``TERMS`` of
them.  Inverse document frequencies of the kept terms are counted over all
documents.

Scoring.  Examples lie in an inverted index whose postings are cut into blocks
of ``BLOCK`` examples with the greatest weight of each term per block.  A text
visits blocks by falling upper bound and stops when no block can reach its
``NEAREST``-th best cosine, so the neighbours are exact.  They vote with the
square of their cosine against the background (the labelled documents without
any kept term); a class counts by its share among all labelled documents.
Votes become probabilities by an isotonic fit to the examples, each voted on
without itself.

Only the text is an input of a score.  Everything sent to executors is bounded
by ``EXAMPLES``, ``TERMS`` and the longest list of kept terms in one example.

Defined results: a null or empty text, or one without kept terms, gets the
background's probability; without labels (or with one class only) every text
gets the known share of toxic labels, 0 if there are none; labels that repeat a
document count once, toxic before clean, and null labels are ignored; rows that
repeat a doc_id are scored by their own texts; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, texts

EXAMPLES = 4096
TERMS = 4096
LEAST_G2 = 20.0
LEAST_RATIO = 4.0
NEAREST = 15
BLOCK = 64
BACKGROUND = 0.25
_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id="doc_id", folds: int = 5, fold: int = 0):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = EXAMPLES):
    """(doc_id, toxic, text) of the sample, and how many labelled documents each class has."""
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .where(F.coalesce(~held_out(), F.lit(False))))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pick = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    # at most 2 x per_class rows of two numbers: small whatever the input
    # rows that repeat a document and its text count once
    return texts(docs).join(F.broadcast(pick[0].unionByName(pick[1])), "doc_id").dropDuplicates(["doc_id", "text"]), totals


def _terms(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def telling_terms(sample: DataFrame) -> list[str]:
    """The terms the two classes use differently, in order."""
    def run(batches):
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                for w in set(_terms(text.as_py())):
                    seen.setdefault(w, [0, 0])[toxic] += 1
            if seen:
                yield batch_of(term=pa.array(list(seen), pa.string()),
                               clean=pa.array([v[0] for v in seen.values()], pa.int64()),
                               toxic=pa.array([v[1] for v in seen.values()], pa.int64()))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = (float(sizes.get(c, 0)) for c in (0, 1))
    if not n0 or not n1:
        return []
    uses = (sample.select("text", "toxic").mapInArrow(run, "term string, clean bigint, toxic bigint")
            .groupBy("term").agg(F.sum("clean").alias("a"), F.sum("toxic").alias("b")))
    rest = F.lit(n0 + n1) - F.col("a") - F.col("b")

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))
    used = F.col("a") + F.col("b")
    g2 = 2 * sum(part(o, t * F.lit(n / (n0 + n1))) for o, t, n in (
        (F.col("a"), used, n0), (F.col("b"), used, n1), (F.lit(n0) - F.col("a"), rest, n0),
        (F.lit(n1) - F.col("b"), rest, n1)))
    ratio = ((F.col("b") + 0.5) / (n1 + 1)) / ((F.col("a") + 0.5) / (n0 + 1))
    apart = (ratio >= LEAST_RATIO) | (ratio <= 1 / LEAST_RATIO)
    kept = uses.where(apart).withColumn("g2", g2).where(F.col("g2") >= LEAST_G2)
    return sorted(r["term"] for r in kept.orderBy(F.desc("g2"), "term").select("term").limit(TERMS).collect())


def document_frequencies(docs: DataFrame, terms: list[str]) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each term, over all documents."""
    place = {t: k for k, t in enumerate(terms)}

    def run(batches):
        n, count = 0, Counter()
        for batch in batches:
            n += batch.num_rows
            for text in batch.column("text"):
                count.update(place.keys() & set(_terms(text.as_py())))
        yield batch_of(term=pa.array([-1, *(place[t] for t in count)], pa.int32()),
                       n=pa.array([n, *count.values()], pa.int64()))
    rows = texts(docs).select("text").mapInArrow(run, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: r["n"] for r in rows}
    return found.get(-1, 0), np.array([found.get(k, 0) for k in range(len(terms))], np.float64)


class BlockMaxIndex:
    """Unit vectors of examples, by term and block of examples."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], ids: list[int]):
        # examples with the same leading terms share blocks, so that bounds are tight
        order = sorted(range(len(ids)), key=lambda e: (tuple(vectors[e][0][np.argsort(-vectors[e][1], kind="stable")][:4]), ids[e]))
        self.ids = np.array([ids[e] for e in order], np.int64)
        self.blocks = -(-len(order) // BLOCK)
        posts: dict[int, list[tuple[int, float]]] = {}
        for at, e in enumerate(order):
            for t, w in zip(*vectors[e]):
                posts.setdefault(int(t), []).append((at, float(w)))
        self.posts = {}
        for t, rows in posts.items():
            at, w = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
            block, first = np.unique(at // BLOCK, return_index=True)
            self.posts[t] = (at, w, block, np.append(first, len(at)), np.maximum.reduceat(w, first))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, but: int | None = None):
        """(cosines, places) of the k nearest with a positive cosine; ties by doc_id.
        ``but``: a doc_id that is left out."""
        lists = [(self.posts[int(t)], q) for t, q in zip(terms, weights) if int(t) in self.posts]
        bound = np.zeros(self.blocks)
        for (_, _, block, _, most), q in lists:
            bound[block] += q * most
        best: list[tuple[float, int, int]] = []
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or len(best) == k and bound[b] < -best[-1][0] - 1e-9:
                break
            scores = np.zeros(BLOCK)
            for (at, w, block, first, _), q in lists:
                x = np.searchsorted(block, b)
                if x < len(block) and block[x] == b:
                    own = slice(first[x], first[x + 1])
                    scores[at[own] - b * BLOCK] += q * w[own]
            least = -best[-1][0] - 1e-9 if len(best) == k else 0.0
            for s in np.flatnonzero((scores > 0) & (scores >= least)):
                place = int(b) * BLOCK + int(s)
                if but is None or self.ids[place] != but:
                    best.append((-round(float(scores[s]), 9), int(self.ids[place]), place))
            best = sorted(best)[:k]
        return np.array([-s for s, _, _ in best]), np.array([p for _, _, p in best], np.int64)


class Neighbours:
    """The fitted scorer: terms, idf, index, labels, class weights, background and calibration."""

    def __init__(self, terms: list[str], idf: np.ndarray):
        self.place = {t: k for k, t in enumerate(terms)}
        self.idf = idf
        self.index, self.toxic = None, np.zeros(0)
        self.weight, self.background = np.ones(2), 0.0
        self.steps, self.values = np.zeros(0), np.zeros(0)

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        place = self.place
        found = Counter(w for w in _terms(text) if w in place) if place else {}
        at = np.array(sorted(place[w] for w in found), np.int64)
        tf = {place[w]: n for w, n in found.items()}
        w = np.array([(1 + math.log(tf[int(t)])) * self.idf[t] for t in at])
        size = math.sqrt(float(w @ w)) if len(w) else 0.0
        return (at, w / size) if size else (at[:0], w[:0])

    def vote(self, text: str, but: int | None = None):
        """The toxic share of the weighted votes, the cosines and the places of the voters."""
        at, w = self.vector(text)
        if not len(at) or self.index is None:
            return self.background, (), ()
        cos, places = self.index.nearest(at, w, NEAREST, but)
        power = cos ** 2 * self.weight[self.toxic[places].astype(int)]
        total = float(power.sum()) + BACKGROUND
        return (float((power * self.toxic[places]).sum()) + BACKGROUND * self.background) / total, cos, places

    def probability(self, vote: float) -> float:
        if len(self.steps):
            vote = float(np.interp(vote, self.steps, self.values))
        return round(min(1.0, max(0.0, vote)), 9)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted least-squares non-decreasing fit (pooled neighbours), as knots."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b, c in zip(x[order], y[order], w[order]):
        pools.append([a, a, b * c, c])
        while len(pools) > 1 and (pools[-2][1] == pools[-1][0]
                                  or pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3]):
            last = pools.pop()
            pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
    knots, values = [], []
    for first, last, s, n in pools:
        for at in (first, last):
            if not knots or at > knots[-1]:
                knots.append(at)
                values.append(s / n)
    return np.array(knots), np.array(values)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = EXAMPLES) -> Neighbours:
    spark = docs.sparkSession
    sample, totals = labelled_sample(docs, labels, per_class)
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 or not n1:
        out = Neighbours([], np.zeros(0))
        out.background = float(bool(n1))
        return out
    terms = telling_terms(sample)
    n, df = document_frequencies(docs, terms)
    model = Neighbours(terms, np.log((n + 1) / (df + 1)) + 1)

    def vectors(batches):
        for batch in batches:
            rows = [model.vector(t.as_py()) for t in batch.column("text")]
            yield batch_of(doc_id=batch.column("doc_id"), toxic=batch.column("toxic"),
                           terms=pa.array([r[0].tolist() for r in rows], pa.list_(pa.int64())),
                           weights=pa.array([r[1].tolist() for r in rows], pa.list_(pa.float64())))
    rows = sample.select("doc_id", "toxic", "text").mapInArrow(
        vectors, "doc_id bigint, toxic int, terms array<bigint>, weights array<double>").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["terms"], r["weights"]))  # at most 2 x per_class
    sizes = Counter(r["toxic"] for r in rows)
    model.weight = np.array([n0 / max(sizes[0], 1), n1 / max(sizes[1], 1)])
    with_terms = [r for r in rows if r["terms"]]
    bare = Counter(r["toxic"] for r in rows if not r["terms"])
    mass = [bare[c] * model.weight[c] for c in (0, 1)]
    model.background = (mass[1] + 1e-3 * n1 / (n0 + n1)) / (sum(mass) + 1e-3)
    if with_terms:
        index = BlockMaxIndex([(np.array(r["terms"]), np.array(r["weights"])) for r in with_terms],
                              [r["doc_id"] for r in with_terms])
        toxic_of = {r["doc_id"]: r["toxic"] for r in with_terms}
        model.index, model.toxic = index, np.array([toxic_of[int(i)] for i in index.ids], np.float64)
    sent = spark.sparkContext.broadcast(model)

    def votes(batches):
        for batch in batches:
            got = [sent.value.vote(t.as_py(), d)[0] for t, d in zip(batch.column("text"), batch.column("doc_id").to_pylist())]
            yield batch_of(vote=pa.array(got, pa.float64()), toxic=batch.column("toxic"))
    cast = sample.select("doc_id", "toxic", "text").mapInArrow(votes, "vote double, toxic int").collect()
    x, y = np.array([r["vote"] for r in cast]), np.array([float(r["toxic"]) for r in cast])
    order = np.lexsort((y, x))
    model.steps, model.values = isotonic(x[order], y[order], model.weight[y[order].astype(int)])
    sent.unpersist()
    return model


def _scored(batches, model, passed: list[str]):
    for batch in batches:
        scores, evidence = [], []
        for text in batch.column("text"):
            vote, cos, places = model.vote(text.as_py() or "")
            scores.append(model.probability(vote))
            evidence.append(",".join(f"{model.index.ids[p]}:{c:.4f}" for c, p in zip(cos, places)))
        columns = {c: batch.column(c) for c in passed}
        yield batch_of(**columns, score=pa.array(scores, pa.float64()), evidence=pa.array(evidence, pa.string()))


def score(docs: DataFrame, model: Neighbours) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence); ``evidence`` lists the
    nearest examples as doc_id:cosine."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    out = texts(docs).mapInArrow(lambda b: _scored(b, sent.value, ["doc_id"]),
                                 "doc_id bigint, score double, evidence string")
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows scored toxic, all columns unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches):
        for batch in batches:
            clean = [sent.value.probability(sent.value.vote(t.as_py() or "")[0]) < 0.5 for t in batch.column("text")]
            yield batch.filter(pa.array(clean, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
