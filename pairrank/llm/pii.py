"""Personal data by validated formats and bootstrapped contexts.

Base finds are e-mail addresses, IP addresses, card and phone numbers in their
usual formats, checked (parts, Luhn, digit counts).  They are the seeds.  Every
looser mention (obfuscated addresses, numbers with other separators, without
the plus sign or with a wrong check digit) is a candidate.  The words beside
seeds and candidates are lexical patterns; a graph joins patterns with the
values found beside them.  Rounds over that graph score a pattern by the mean
score of its values and a value by the noisy-or of its trusted patterns; seeds
stay at 1.  A pattern is trusted with ``SUPPORT`` values that are seeds or have
reached ``ACCEPT``, so discovered values support new patterns.  Scores only
rise, and rounds go on until none changes (to ``PLACES`` decimals).  Values that
reach ``ACCEPT`` add all their mentions as spans.

Everything is DataFrame operations.  A text is scanned once; after that only
mentions move, folded to distinct (kind, pattern, value) before any join.

Base expressions are the stated ones with look-behinds and possessive
quantifiers, so a scan is linear in the text; they find the same spans.

Defined results: a null text is empty and has no spans; positions are code
points, ends exclusive; rows that repeat a doc_id keep their own texts' spans;
a null doc_id stays null; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import delete_path, intermediate_tables, materialise
from .common import texts

# Kinds in order, and their expressions.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
EXPRESSIONS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
_AT, _DOT = r"(?:@|\x20?[(\[]at[)\]]\x20?)", r"(?:\.|\x20?[(\[]dot[)\]]\x20?)"
MENTION = (rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)*+"
           r"|(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
           r"|(?<![0-9])\+?+\(?+[0-9](?:[\x20().-]{0,2}+[0-9])++")

SUPPORT = 3
TRUST = 0.7
ACCEPT = 0.75
PLACES = 6
_BLOCK = 64
_SPAN = "array<struct<kind:string,start:int,end:int>>"
_MENTIONS = "array<struct<kind:string,start:int,end:int,value:string,patterns:array<string>>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(sizes: Column) -> Column:
    """Sum of the elements before each place, by blocks of ``_BLOCK``."""
    def total(a):
        return F.aggregate(a, F.lit(0), lambda s, x: s + x)
    blocks = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _BLOCK).cast("int"))
    return let(F.transform(blocks, lambda b: total(F.slice(sizes, b * _BLOCK + 1, F.lit(_BLOCK)))), lambda sums: let(
        F.transform(blocks, lambda b: total(F.slice(sums, F.lit(1), b))), lambda bases: F.transform(
            sizes, lambda _, i: F.element_at(bases, F.floor(i / _BLOCK).cast("int") + 1)
            + total(F.slice(sizes, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)))))


def _matches(text: Column, expression: str, make) -> Column:
    """``make(match, start, before, after)`` for every match; before and after are the
    texts up to the neighbouring matches."""
    found = F.regexp_extract_all(text, F.lit(expression), F.lit(0))

    def place(m):
        return let(F.split(text, expression, -1), lambda gaps: let(
            _running(F.transform(m, lambda x, i: F.length(x) + F.length(F.element_at(gaps, i + 1)))),
            lambda starts: F.transform(m, lambda x, i: make(
                x, F.element_at(starts, i + 1) + F.length(F.element_at(gaps, i + 1)),
                F.element_at(gaps, i + 1), F.element_at(gaps, i + 2)))))
    return let(found, lambda m: F.when(F.size(m) > 0, place(m)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weighed(d, i):
        v = d.cast("int") * (1 + i % 2)
        return v - F.when(v > 9, 9).otherwise(0)
    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), weighed)
    return F.aggregate(each, F.lit(0), lambda s, x: s + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    n = F.length(_digits(value))
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(_digits(value))).otherwise(F.lit(False))
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column) -> Column:
    """The validated spans of a text, by kind and start."""
    out = []
    for kind in KINDS:
        mark = {"email": "@", "phone": "+"}.get(kind)
        likely = F.contains(text, F.lit(mark)) if mark else text.rlike("[0-9]")
        every = _matches(text, EXPRESSIONS[kind], lambda x, start, *_, k=kind: F.struct(
            F.lit(k).alias("kind"), start.alias("start"), (start + F.length(x)).alias("end"), _valid(k, x).alias("valid")))
        spans = F.transform(F.filter(every, lambda s: s["valid"]),
                            lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
        out.append(F.coalesce(F.when(likely, spans), F.array()).cast(_SPAN))
    return F.concat(*out)


def _kind_of(value: Column) -> Column:
    n, only = F.length(_digits(value)), value.rlike(r"^[+0-9().\x20-]+$")
    return (F.when(value.rlike(r"@|[(\[]at[)\]]"), F.lit("email"))
            .when(~only | value.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), F.lit("ip"))
            .when((n >= 13) & (n <= 19) & ~value.rlike("[+()]"), F.lit("card"))
            .when((n >= 7) & (n <= 15), F.lit("phone")))


def _patterns(before: Column, after: Column) -> Column:
    left = F.lower(F.right(before, F.lit(_BLOCK)))
    one = F.regexp_extract(left, r"(\S+)\s*$", 1)
    two = F.regexp_extract(left, r"(\S+\s+\S+)\s*$", 1)
    right = F.regexp_extract(F.lower(F.left(after, F.lit(_BLOCK))), r"^\s*(\S+)", 1)
    named = F.array(F.when(one != "", F.concat(F.lit("1 "), one)),
                    F.when(two != "", F.concat(F.lit("2 "), F.regexp_replace(two, r"\s+", " "))),
                    F.when(right != "", F.concat(F.lit("r "), right)))
    return F.filter(named, lambda p: p.isNotNull())


def mentions(text: Column) -> Column:
    """Loose mentions with the patterns beside them, in order."""
    def make(x, start, before, after):
        plain = F.when(x.rlike(r"^[+0-9().\x20-]+$"), _digits(x)).otherwise(F.lower(x))
        return F.struct(_kind_of(x).alias("kind"), start.alias("start"), (start + F.length(x)).alias("end"),
                        plain.alias("value"), _patterns(before, after).alias("patterns"))
    found = F.when(text.rlike(r"[0-9@]|[(\[]at[)\]]"), _matches(text, MENTION, make))
    return F.filter(F.coalesce(found, F.array().cast(_MENTIONS)), lambda m: m["kind"].isNotNull())


def _graph(rows: DataFrame) -> DataFrame:
    """(kind, value, pattern, seed, score): distinct links between values and patterns."""
    return (rows.select(F.explode("mentions").alias("m"), "base")
            .withColumn("_own", F.filter("base", lambda b: (b["start"] < F.col("m.end")) & (b["end"] > F.col("m.start"))))
            .withColumn("seed", F.size("_own") > 0)
            .select(F.coalesce(F.get("_own", F.lit(0))["kind"], F.col("m.kind")).alias("kind"),
                    F.col("m.value").alias("value"), "seed", F.explode("m.patterns").alias("pattern"))
            .groupBy("kind", "value", "pattern").agg(F.max("seed").alias("seed"))
            .withColumn("score", F.col("seed").cast("double")))


def _state(graph: DataFrame) -> tuple:
    score = F.round("score", PLACES)
    return tuple(graph.agg(F.count(F.lit(1)), F.sum(
        F.xxhash64("kind", "value", "pattern", score).cast("decimal(38,0)"))).first())


def accepted_values(rows: DataFrame) -> DataFrame:
    """(kind, value, score) of the values that trusted patterns discover."""
    graph = materialise(_graph(rows), "pii-graph")
    old, state = None, _state(graph)
    while state != old:
        trusted = (graph.groupBy("kind", "pattern").agg(
            F.sum("score").alias("_s"), F.count(F.lit(1)).alias("_n"), F.sum((F.col("score") >= ACCEPT).cast("int")).alias("_k"))
            .where(F.col("_k") >= SUPPORT).select("kind", "pattern", (F.col("_s") / (F.col("_n") + 1)).alias("trust"))
            .where(F.col("trust") >= TRUST))
        told = (graph.where("NOT seed").join(trusted, ["kind", "pattern"]).groupBy("kind", "value")
                .agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("_told")))
        rescored = materialise(
            graph.join(told, ["kind", "value"], "left").withColumn(
                "score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("_told", F.lit(0.0)))).drop("_told"),
            "pii-graph")
        delete_path(graph.sparkSession, graph._scratch_path)
        graph, old, state = rescored, state, _state(rescored)
    seeds = graph.where("seed").select("kind", "value")
    return (graph.where(F.col("score") >= ACCEPT).groupBy("kind", "value").agg(F.max("score").alias("score"))
            .join(seeds, ["kind", "value"], "left_anti"))


def _shown(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is(kind: str):
    return lambda span: span["kind"] == kind


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for every row."""
    with intermediate_tables(docs.sparkSession) as keep:
        text = F.col("text")
        rows = materialise(texts(docs).select("doc_id", F.xxhash64("text").alias("text_key"),
                                              base_spans(text).alias("base"), mentions(text).alias("mentions")), "pii-rows")
        loose = (rows.where(F.size("mentions") > 0).select("doc_id", "text_key", "base", F.explode("mentions").alias("m"))
                 .where(~F.exists("base", lambda b: (b["start"] < F.col("m.end")) & (b["end"] > F.col("m.start"))))
                 .select("doc_id", "text_key", "m.kind", "m.start", "m.end", "m.value"))
        added = (loose.join(accepted_values(rows).select("kind", "value"), ["kind", "value"], "left_semi")
                 .groupBy(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"))
                 .agg(F.collect_set(F.struct("kind", "start", "end")).alias("_added")))
        order = F.array(*map(F.lit, KINDS))
        whole = rows.join(added, rows["doc_id"].eqNullSafe(F.col("_d")) & (rows["text_key"] == F.col("_t")), "left")
        every = F.concat("base", F.coalesce("_added", F.array().cast(_SPAN)))
        ranked = F.array_sort(F.transform(every, lambda s: F.struct(
            F.array_position(order, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
            s["kind"].alias("kind"))))
        counts = [F.size(F.filter("base", _is(kind))).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
        out = materialise(whole.select(
            "doc_id", *counts, F.sha2(_shown(F.col("base")), 256).alias("base_sha256"),
            F.when(F.col("_added").isNull(), _shown(F.col("base"))).otherwise(_shown(ranked)).alias("spans"),
            F.coalesce(F.size("_added"), F.lit(0)).cast("bigint").alias("n_added")), "pii")
        keep.append(out)
    return out
