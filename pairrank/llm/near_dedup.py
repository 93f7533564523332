"""Near duplicates by an LSH forest over MinHash signatures.

A text's set is its distinct word shingles; texts of equal sets are one class
from the start.  A class has a signature of ``COORDINATES`` minima.  The forest
has ``ORDERS`` trees: tree t orders the classes by the signature read from
coordinate ``4 t`` on, so a subtree is a region of the sorted order whose
members share a prefix.  The depth adapts to the region: from depth 4, a region
is opened level by level until it holds at most ``REGION`` classes, and all of
those neighbours become candidates.  A region too large at some level also
makes each member a candidate with its most central class (the one that shares
most prefixes over the whole forest), so a large group of copies of one text is
tied to that text without comparing its members with each other.  In its last
large region a class also meets three more central ones and the one of most
copies, and, if no deeper region holds it, about ``MATES`` others.

Candidates are confirmed on the full sets: first each class with its most
central candidate, then every other candidate pair that these links do not
already connect.  Components of confirmed links are found by star contraction.

Two similar classes may share large regions only and meet nobody there.  So all
classes of large regions are also joined exactly: a class lists the rarest fifth
of its shingles (rare by a table of counts of fixed size, which only orders
them), and two classes of different components are compared when their lists
share a shingle early enough for the sizes to allow Jaccard 0.8, and the shared
ones so far leave enough room for the rest.  No list is cut; long ones are dealt
out in blocks, and the members of a list's largest component do not meet.

At Jaccard 0.8 a pair shares depth 4 in at least one of 16 trees with
probability 0.9998; a pair that does is found.

Defined results: a null or empty text, or one without words, has an empty set
and is linked with nothing; a text with fewer words than a shingle is one
shingle; copies are one component; a row with a null doc_id belongs to its
copies' component, and without such copies to none (null, kept); rows that repeat a
doc_id are compared by their own texts; an empty table gives an empty result;
extra columns are ignored.  Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import intermediate_tables, materialise
from .common import WordHashes, batch_of, map_rows, mix64, text_key, texts, without_rows, words
from .components import components

ORDERS = 16
COORDINATES = 64
LEVELS = (4, 6, 8, 11, 16, 24, 36, 64)
REGION = 16
MATES = 8
PERCENT = 80
COUNTER_BITS, PAGE_BITS = 21, 16
LIST_BLOCK = 1024

_MULT, _ADD = (mix64(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64)).reshape(2, COORDINATES, 1)
               | np.array([1, 0], np.uint64).reshape(2, 1, 1))


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(width, n)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:n - width + 1 + k])
    return np.unique(out)


def signature(shingles: np.ndarray) -> bytes:
    """``COORDINATES`` 32-bit minima, big-endian; in blocks, so memory stays bounded."""
    low = np.full(COORDINATES, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = (shingles[None, at:at + 2048] * _MULT + _ADD) >> np.uint64(32)
        low = np.minimum(low, part.min(axis=1))
    return low.astype(">u4").tobytes()


def _documents(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_key, sig); key and signature are null for an empty set."""
    def make():
        known = WordHashes()

        def step(batch):
            n, keys, sigs = [], [], []
            for text in batch.column("text"):
                s = shingle_set(known.array(words(text.as_py())), width)
                n.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sigs.append(signature(s) if len(s) else None)
            return batch_of(doc_id=batch.column("doc_id"), text_key=batch.column("text_key"), n_shingles=pa.array(n, pa.int64()),
                            set_key=pa.array(keys, pa.binary()), sig=pa.array(sigs, pa.binary()))
        return step
    return map_rows(texts(docs).withColumn("text_key", text_key()), "doc_id bigint, text_key bigint, n_shingles bigint, set_key binary, sig binary", make)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(set_key, shingles array<bigint>) of the given documents."""
    def make():
        known = WordHashes()

        def step(batch):
            sets = [shingle_set(known.array(words(t.as_py())), width) for t in batch.column("text")]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            return batch_of(set_key=pa.array(keys, pa.binary()),
                            shingles=pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
        return step
    return map_rows(texts(docs), "set_key binary, shingles array<bigint>", make, slice_rows=64)


def _region(order, level):
    """The subtree of an order that shares its first ``level`` coordinates."""
    read = F.concat("sig", "sig").substr(order * 16 + 1, level * 4)
    return F.xxhash64(order, level, read)


def _forest(nodes: DataFrame) -> DataFrame:
    """(set_key, n, copies, order, level, region, size): regions of two or more classes."""
    t = F.col("order")
    rooted = (nodes.select("set_key", "n", "sig", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("order"))
              .select("set_key", "order", _region(t, F.lit(LEVELS[0])).alias("region")))
    shared = rooted.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    live = rooted.join(shared, "region").select("set_key", "order").join(nodes.select("set_key", "n", "copies", "sig"), "set_key")
    opened = (live.withColumn("level", F.explode(F.array(*map(F.lit, LEVELS))))
              .select("set_key", "n", "copies", "order", "level", _region(t, F.col("level")).alias("region")))
    sizes = opened.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return opened.join(sizes, "region").select("set_key", "n", "copies", "order", "level", "region", "size")


def _upward(pairs: DataFrame) -> DataFrame:
    """(lo, hi) of pairs (x, y): the more central as ``hi``."""
    up = F.col("y") > F.col("x")
    return pairs.select(F.when(up, F.col("x")).otherwise(F.col("y")).alias("lo"),
                        F.when(up, F.col("y")).otherwise(F.col("x")).alias("hi"))


def _candidates(forest: DataFrame) -> DataFrame:
    """(lo, hi, hi_hub): pairs to confirm, the more central class as ``hi``."""
    central = forest.groupBy("set_key").agg(F.sum("size").alias("hub"))
    way = W.partitionBy("set_key", "order").orderBy("level")
    rows = (forest.withColumn("_outer", F.lag("size").over(way)).withColumn("_inner", F.lead("size").over(way))
            .join(central, "set_key")
            .withColumn("me", F.struct("hub", F.col("set_key").alias("key"), "n")))
    near = (rows.where((F.col("size") <= REGION) & (F.col("_outer").isNull() | (F.col("_outer") > REGION)))
            .groupBy("region").agg(F.array_sort(F.collect_list("me")).alias("all")))
    pairs = (near.select(F.posexplode("all").alias("k", "hi"), "all")
             .select("hi", F.explode(F.slice("all", 1, F.col("k"))).alias("lo")))
    wide = rows.where(F.col("size") > REGION)
    middle = wide.groupBy("region").agg(F.max("me").alias("hi"))
    tied = wide.join(middle, "region").select("hi", F.col("me").alias("lo"))
    # in its last large region a class also meets the most central of each third, and the one of most copies
    last = wide.where(F.coalesce(F.col("_inner"), F.lit(0)) <= REGION)
    third = F.pmod(F.xxhash64("set_key"), F.lit(3))
    heads = (wide.groupBy("region", third.alias("third")).agg(F.max("me").alias("y")).drop("third")
             .unionByName(wide.groupBy("region").agg(F.max(F.struct("copies", "me")).alias("_c"))
                          .select("region", F.col("_c.me").alias("y"))).distinct())
    heard = _upward(last.select("region", F.col("me").alias("x")).join(heads, "region"))
    # a class that no deeper region holds meets about MATES members of the last large one
    dealt = F.pmod(F.xxhash64("set_key", "region"), F.ceil(F.col("size") / MATES))
    lone = wide.where(F.col("_inner").isNull() & (F.col("level") < LEVELS[-1]))
    met = _upward(lone.select("region", dealt.alias("part"), F.col("me").alias("x"))
                  .join(wide.select("region", dealt.alias("part"), F.col("me").alias("y")), ["region", "part"]))
    alike = F.least("lo.n", "hi.n") * 100 >= F.greatest("lo.n", "hi.n") * PERCENT
    return (pairs.unionByName(tied).unionByName(heard).unionByName(met).where(alike & (F.col("lo.key") != F.col("hi.key")))
            .groupBy(F.col("lo.key").alias("lo"), F.col("hi.key").alias("hi"))
            .agg(F.max("hi.hub").alias("hi_hub")))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = sets.select(F.col("set_key").alias("lo"), F.col("shingles").alias("_s"))
    two = sets.select(F.col("set_key").alias("hi"), F.col("shingles").alias("_t"))
    both = pairs.select("lo", "hi").join(one, "lo").join(two, "hi")
    common = F.size(F.array_intersect("_s", "_t"))
    return (both.where(common * 100 >= (F.size("_s") + F.size("_t") - common) * PERCENT)
            .select(F.col("lo").alias("a"), F.col("hi").alias("b")))


def _counted(sets: DataFrame) -> np.ndarray:
    """How many sets have a shingle, by the leading ``COUNTER_BITS`` of its hash."""
    size = 1 << PAGE_BITS

    def count(batches):
        seen = np.zeros(1 << COUNTER_BITS, np.uint32)
        for batch in batches:
            for s in batch.column("shingles"):
                tokens = s.values.to_numpy(zero_copy_only=False).view(np.uint64)
                np.add.at(seen, (tokens >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), 1)
        for page in np.flatnonzero(seen.reshape(-1, size).any(axis=1)):
            yield batch_of(page=pa.array([page], pa.int32()), counts=pa.array([seen[page * size:][:size].tobytes()], pa.binary()))

    def add(batches):
        pages: dict[int, np.ndarray] = {}
        for batch in batches:
            for page, counts in zip(*(c.to_pylist() for c in batch.columns)):
                pages[page] = pages.get(page, 0) + np.frombuffer(counts, np.uint32)
        for page, counts in pages.items():
            yield batch_of(page=pa.array([page], pa.int32()), counts=pa.array([counts.tobytes()], pa.binary()))
    pages = (sets.select("shingles").mapInArrow(count, "page int, counts binary")
             .repartition(1 << (COUNTER_BITS - PAGE_BITS), "page").mapInArrow(add, "page int, counts binary"))
    out = np.zeros(1 << COUNTER_BITS, np.uint32)
    for row in pages.collect():  # at most 2 ** (COUNTER_BITS - PAGE_BITS) rows
        out[row["page"] * size:][:size] = np.frombuffer(row["counts"], np.uint32)
    return out


def _lists(sets: DataFrame) -> DataFrame:
    """(set_key, root, n, token, at): the first shingles of each set, rare ones first, with their places.

    Sets of n and m shingles at Jaccard 0.8 have 4 (n + m) / 9 in common, so the
    first common one is among the first n - ceil(0.8 n) + 1.  Shingles that no
    other set has keep their places but are not listed.
    """
    sent = sets.sparkSession.sparkContext.broadcast(_counted(sets))

    def make():
        def step(batch):
            tokens, places, rows, sizes = [], [], [], []
            for s in batch.column("shingles"):
                own = s.values.to_numpy(zero_copy_only=False)
                uses = sent.value[(own.view(np.uint64) >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
                first = np.lexsort((own, uses))[:len(own) - (len(own) * PERCENT + 99) // 100 + 1]
                at = np.flatnonzero(uses[first] > 1)
                tokens.append(own[first[at]])
                places.append(at)
                rows.append(len(at))
                sizes.append(len(own))
            of = pa.array(np.repeat(np.arange(len(rows)), rows))
            return batch_of(set_key=batch.column("set_key").take(of), root=batch.column("root").take(of),
                            n=pa.array(sizes, pa.int32()).take(of), token=pa.array(np.concatenate(tokens), pa.int64()),
                            at=pa.array(np.concatenate(places), pa.int32()))
        return step
    return map_rows(sets.select("set_key", "root", "shingles"),
                    "set_key binary, root binary, n int, token bigint, at int", make, slice_rows=64)


def _apart(sets: DataFrame) -> DataFrame:
    """(lo, hi): every pair of the sets (set_key, root, shingles) with different roots that can be similar enough."""
    lists = materialise(_lists(sets), "near-lists")
    tops = (lists.groupBy("token", "root").agg(F.count(F.lit(1)).alias("_n"))
            .groupBy("token").agg(F.sum("_n").alias("_all"), F.max(F.struct("_n", "root")).alias("_top"))
            .where("_all > _top._n")
            .select("token", F.col("_top.root").alias("_main"), F.ceil(F.col("_all") / LIST_BLOCK).alias("_ys"),
                    F.ceil((F.col("_all") - F.col("_top._n")) / LIST_BLOCK).alias("_xs")))
    live = materialise(lists.join(tops, "token"), "near-live")
    # those outside a list's largest component meet the whole list, block by block
    own = F.xxhash64("set_key")

    def every(n):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    cols = [F.col(c) for c in ("set_key", "root", "n", "at")]
    x = live.where("root != _main").select("token", F.pmod(own, "_xs").alias("_i"), every("_ys").alias("_j"),
                                           F.struct(*cols).alias("x"))
    y = live.select("token", every("_xs").alias("_i"), F.pmod(own, "_ys").alias("_j"),
                    (F.col("root") == F.col("_main")).alias("_in"), F.struct(*cols).alias("y"))

    def common(a, b):
        return F.floor((4 * (F.col(f"{a}.n") + F.col(f"{b}.n")) + 8) / 9)
    met = x.join(y, ["token", "_i", "_j"]).where(
        (F.col("x.root") != F.col("y.root")) & (F.col("_in") | (F.col("x.set_key") < F.col("y.set_key")))
        & (F.col("x.n") - F.col("x.at") >= common("x", "y")) & (F.col("y.n") - F.col("y.at") >= common("x", "y")))
    up = F.col("x.set_key") < F.col("y.set_key")
    rest = F.least(F.col("lo.n") - F.col("_l"), F.col("hi.n") - F.col("_h")) - 1
    return (met.select(F.when(up, F.col("x")).otherwise(F.col("y")).alias("p"),
                       F.when(up, F.col("y")).otherwise(F.col("x")).alias("q"))
            .groupBy(F.struct("p.set_key", "p.n").alias("lo"), F.struct("q.set_key", "q.n").alias("hi"))
            .agg(F.count(F.lit(1)).alias("_shared"), F.max("p.at").alias("_l"), F.max("q.at").alias("_h"))
            .where(F.col("_shared") + rest >= common("lo", "hi"))
            .select(F.col("lo.set_key").alias("lo"), F.col("hi.set_key").alias("hi")))


def _judged(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key, stays) for every row of ``docs``;
    ``stays`` marks one (doc_id, text) of each component."""
    with intermediate_tables(docs.sparkSession) as keep:
        rows = materialise(_documents(docs, width), "near-rows")
        nodes = materialise(rows.where("set_key IS NOT NULL").groupBy("set_key").agg(
            F.min("doc_id").alias("rep"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("head"),
            F.first("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies"),
            F.first("sig").alias("sig")), "near-classes")
        forest = materialise(_forest(nodes), "near-forest")
        pairs = materialise(_candidates(forest), "near-pairs")
        wide = materialise(forest.where(F.col("size") > REGION).select("set_key").distinct(), "near-wide")
        asked = pairs.select(F.col("lo").alias("set_key")).union(pairs.select("hi")).union(wide).distinct()
        wanted = nodes.join(asked, "set_key", "left_semi").select(F.col("rep").alias("_rep"))
        some = texts(docs)
        sets = materialise(_sets(some.join(wanted, F.col("doc_id") == F.col("_rep"), "left_semi"), width)
                           .dropDuplicates(["set_key"]), "near-sets")
        first = pairs.groupBy("lo").agg(F.max_by("hi", F.struct("hi_hub", "hi")).alias("hi"))
        tied = materialise(_confirmed(first, sets), "near-first")
        twice = tied.alias("x").join(tied.alias("y"), F.col("x.b") == F.col("y.a"), "left").select(
            F.col("x.a").alias("node"), F.coalesce("y.b", "x.b").alias("at"))
        left = (pairs.select("lo", "hi")
                .join(twice.select(F.col("node").alias("lo"), F.col("at").alias("_l")), "lo", "left")
                .join(twice.select(F.col("node").alias("hi"), F.col("at").alias("_h")), "hi", "left")
                .where(F.coalesce("_l", "lo") != F.coalesce("_h", "hi")))
        links = tied.union(_confirmed(left, sets))
        found = components(links)
        named = materialise(nodes.select("set_key", "rep", "head").join(found, F.col("set_key") == F.col("node"), "left").select(
            "set_key", "rep", "head", F.coalesce("root", "set_key").alias("root")), "near-named")
        roots = named.select("set_key", "root")
        apart = _apart(sets.join(wide, "set_key", "left_semi").join(roots, "set_key"))
        more = (_confirmed(apart, sets).join(roots.toDF("a", "_a"), "a").join(roots.toDF("b", "_b"), "b")
                .select(F.col("_a").alias("a"), F.col("_b").alias("b")))
        named = named.join(components(more).toDF("root", "_root"), "root", "left").select(
            "set_key", "rep", "head", F.coalesce("_root", "root").alias("root"))
        least = named.groupBy("root").agg(F.min("rep").alias("_least"), F.min("head").alias("_head"))
        classes = named.join(least, "root").select("set_key", "_least", "_head")
        component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("_least"))
        # copies of one text are many narrow rows on one side; AQE splits them
        out = materialise(rows.select("doc_id", "text_key", "n_shingles", "set_key").join(classes, "set_key", "left").select(
            "doc_id", "n_shingles",
            component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key",
            (F.col("set_key").isNull() | (F.col("doc_id").eqNullSafe(F.col("_head.doc_id"))
                                          & (F.col("text_key") == F.col("_head.text_key")))).alias("stays")), "near")
        keep.append(out)
    return out


def near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    return _judged(docs, width).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """``docs`` with one row of each component, all columns unchanged.

    A row goes by its doc_id and own text; rows without words all stay.
    """
    with intermediate_tables(docs.sparkSession) as keep:
        rows = _judged(docs, width).where("n_shingles > 0").groupBy("doc_id", "text_key").agg(
            F.count(F.lit(1)).alias("n"), F.first("stays").alias("fold"))
        decided = materialise(rows.where("n > 1 OR NOT fold").drop("n"), "near-decided")
        keep.append(decided)
    return without_rows(docs, decided)
