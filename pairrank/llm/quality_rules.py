"""Quality rules: a decision list learnt from labelled statistics, run as Spark conditions.

Every text gets counted statistics; their ratios (``FEATURES``) are Spark
expressions.  Sequential covering learns an ordered list of rules for the low
class from labelled rows: a rule is grown on two thirds of the rows by adding
the threshold condition of greatest FOIL gain until it covers no good row,
pruned on the last third to the prefix of conditions that separates the classes
there best, and taken while it is right often enough on both parts; the rows it
covers are then set aside and the next rule is grown on the rest.  The list is
emitted as ``CASE WHEN a > x AND b <= y THEN 1 WHEN ... ELSE 0 END``: the number
of the first rule that holds, 0 if none does.  Documents of a rule are not kept.

Only the statistics of at most ``EXAMPLES`` labelled rows a class (those of
least hash; a parameter) reach the driver; every text is read whole.

Defined results: a null or empty text has no words, all counts 0, and fails the
base; a text is judged by its own row, so rows that repeat a doc_id or a null
doc_id are judged alike by their texts; labels that repeat a document count
once, low before good, and null labels are ignored; without labels, or with one
class only, the list is empty and the base alone decides; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import intermediate_tables, materialise
from .common import WordHashes, batch_of, map_rows, mix64, texts

EXAMPLES = 4096
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30          # per cent of the words
CONDITIONS = 4              # of a rule, at most
LEAST_RIGHT = 0.9           # share of low rows among those a rule covers, on both parts
LEAST_COVER = 0.01          # share of the low rows that a rule covers, at least
PRUNED_ON = 3               # one of this many rows prunes

# The symbols the base counts.
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_digits",
           "n_marks", "n_stops", "n_distinct", "n_long"]


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """How many words lie in a window of ``window`` words that the text has twice or more."""
    n = len(hashes) - window + 1
    if n < 2:
        return 0
    key = np.zeros(n, np.uint64)
    for k in range(window):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + hashes[k:n + k])
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(n + window, np.int64)
    edges[:n] += twice
    edges[window:] -= twice
    return int((np.cumsum(edges[:-1]) > 0).sum())


def count(text: str, known: WordHashes) -> tuple[int, ...]:
    """The numbers of ``_COUNTS`` for one text."""
    ws = text.encode("utf-8", "surrogatepass").split()
    hashes = known.array(ws)
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(_SPACES):
            lines += 1
            dup += line in seen
            seen.add(line)

    def of(chars: str) -> int:
        return sum(map(text.count, chars))
    return (len(ws), len(text) - of(_SPACES), of(SYMBOLS), dup, repeated_words(hashes), lines, of(_CAPITALS),
            of("0123456789"), of("!?"), of(".,;:"), len(np.unique(hashes)), sum(1 for w in ws if len(w) > 30))


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, counts of ``_COUNTS``) of every row."""
    def make():
        known = WordHashes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [count(t.as_py(), known) for t in batch.column("text")]
            return batch_of(doc_id=batch.column("doc_id"),
                            **{c: pa.array(v, pa.int64()) for c, v in zip(_COUNTS, zip(*rows))})
        return step
    return map_rows(texts(docs), "doc_id bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS), make)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


# Interpretable ratios, in the order in which ties between conditions are settled.
FEATURES = ("symbols_per_word", "marks_per_word", "stops_per_word", "capitals_share", "digits_share", "symbols_share",
            "dup_lines_share", "repeat_words_share", "distinct_share", "word_length", "words_per_line", "long_words_share",
            "words")


def features() -> dict[str, Column]:
    """Name -> expression over the counts."""
    return dict(zip(FEATURES, (
        _share("n_symbols", "n_words"), _share("n_marks", "n_words"), _share("n_stops", "n_words"),
        _share("n_capitals", "word_chars"), _share("n_digits", "word_chars"), _share("n_symbols", "word_chars"),
        _share("n_dup_lines", "n_lines"), _share("n_repeat_words", "n_words"), _share("n_distinct", "n_words"),
        _share("word_chars", "n_words"), _share("n_words", "n_lines"), _share("n_long", "n_words"),
        F.col("n_words").cast("double"))))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)


# --- the list -------------------------------------------------------------------------------

@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool         # feature > threshold, else feature <= threshold
    threshold: float

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        column = x[:, names.index(self.feature)]
        return column > self.threshold if self.above else column <= self.threshold

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] > self.threshold if self.above else of[self.feature] <= self.threshold


@dataclass
class RuleList:
    """Ordered conjunctions for the low class; every other row is good."""

    rules: list[list[Condition]] = field(default_factory=list)

    def column(self) -> Column:
        """The number of the first rule that holds (from 1), 0 if none."""
        of, out = features(), None
        for k, rule in enumerate(self.rules, 1):
            test = F.lit(True)
            for c in rule:
                test = test & c.column(of)
            out = F.when(test, k) if out is None else out.when(test, k)
        return F.lit(0) if out is None else out.otherwise(0)

    def first(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        """``column`` over a matrix of feature values."""
        out = np.zeros(len(x), np.int64)
        for k, rule in enumerate(self.rules, 1):
            out[(out == 0) & covers(rule, x, names)] = k
        return out

    def __str__(self) -> str:
        return "\n".join([f"{k}. low if " + " and ".join(map(str, rule)) for k, rule in enumerate(self.rules, 1)]
                         + ["otherwise good"])


def covers(rule: list[Condition], x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x, names)
    return out


def between(a: float, b: float) -> float:
    """A short decimal in the middle half of the gap between two seen values."""
    middle, room = (a + b) / 2, (b - a) / 4
    for digits in range(0, 7):
        t = round(middle, digits)
        if a + room <= t <= b - room:
            return t
    return middle if a <= middle < b else a


def best_condition(x: np.ndarray, low: np.ndarray, weight: np.ndarray, names: list[str]) -> Condition | None:
    """The condition of greatest FOIL gain on these rows; None if none gains."""
    p0, n0 = weight[low].sum(), weight[~low].sum()
    best, found = 1e-9, None
    if not p0 or not n0:
        return None
    for f, name in enumerate(names):
        order = np.argsort(x[:, f], kind="stable")
        v = x[order, f]
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        p = np.cumsum(weight[order] * low[order])[cut]
        n = np.cumsum(weight[order] * ~low[order])[cut]
        for above in (False, True):
            pp, nn = (p0 - p, n0 - n) if above else (p, n)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(pp > 1e-9, pp * (np.log2(pp / (pp + np.maximum(nn, 0))) - np.log2(p0 / (p0 + n0))), 0.0)
            at = int(gain.argmax())
            if gain[at] > best + 1e-9:
                best = gain[at]
                found = Condition(name, above, between(float(v[cut[at]]), float(v[cut[at] + 1])))
    return found


def learn(x: np.ndarray, low: np.ndarray, weight: np.ndarray, prune: np.ndarray, names: list[str]) -> RuleList:
    """Sequential covering: grow, prune, take, set the covered rows aside."""
    out, left = RuleList(), np.ones(len(x), bool)
    total = weight[low].sum()

    def right(rule, rows):
        got = rows & covers(rule, x, names)
        p, n = weight[got & low].sum(), weight[got & ~low].sum()
        return p, n
    while (left & low & ~prune).any() and (left & low & prune).any():
        rule, live = [], left & ~prune
        while len(rule) < CONDITIONS and (live & ~low).any():
            c = best_condition(x[live], low[live], weight[live], names)
            if c is None:
                break
            rule.append(c)
            live &= c.holds(x, names)
        worth = []
        for k in range(1, len(rule) + 1):
            p, n = right(rule[:k], left & prune)
            worth.append(((p - n) / (p + n) if p + n else -1.0, -k))
        if not worth:
            break
        rule = rule[:-max(worth)[1]]
        p, n = right(rule, left & prune)
        q, m = right(rule, left & ~prune)
        if p + q < LEAST_COVER * total or p < LEAST_RIGHT * (p + n) or q < LEAST_RIGHT * (q + m) or not p:
            break
        out.rules.append(rule)
        left &= ~covers(rule, x, names)
    return out


# --- on tables ------------------------------------------------------------------------------

def fit(stats: DataFrame, labels: DataFrame, per_class: int = EXAMPLES) -> RuleList:
    """The list learnt from the labelled rows of ``stats`` that pass the base."""
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality")))
    of = features()
    rows = (stats.where(~base_failed()).join(known, "doc_id")
            .select("doc_id", "quality", *[c.alias(n) for n, c in of.items()]).dropDuplicates())
    totals = {r["quality"]: r["n"] for r in rows.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return RuleList()
    names, got = list(of), []
    for c in (0, 1):  # at most per_class rows each
        got += rows.where(F.col("quality") == c).orderBy(F.xxhash64("doc_id"), "doc_id", *names).limit(per_class).collect()
    x = np.array([[r[n] for n in names] for r in got], np.float64)
    low = np.array([r["quality"] == 0 for r in got])
    share = {c: totals[c] / sum(r["quality"] == c for r in got) for c in (0, 1)}
    weight = np.array([share[r["quality"]] for r in got])
    prune = mix64(np.array([r["doc_id"] for r in got]).astype(np.uint64)) % np.uint64(PRUNED_ON) == 0
    return learn(x, low, weight, prune, names)


def judge(stats: DataFrame, rules: RuleList) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule)."""
    return (stats.withColumn("base_failed", base_failed()).withColumn("rule", rules.column())
            .select("doc_id", *_COUNTS[:5], "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"),
                    F.col("rule").cast("int").alias("rule")))


def judge_documents(docs: DataFrame, labels: DataFrame, per_class: int = EXAMPLES) -> DataFrame:
    """Every row of ``docs`` under the list learnt from ``labels``."""
    with intermediate_tables(docs.sparkSession) as keep:
        stats = materialise(statistics(docs), "quality-stats")
        keep.append(stats)
        return judge(stats, fit(stats, labels, per_class))
