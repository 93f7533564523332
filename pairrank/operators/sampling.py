"""Training triples (user, seen item, unseen item), drawn reproducibly.

Two modes:

* ``uniform_user``: each shard makes ``samples_per_user`` draws per user it
  holds; a draw picks a user uniformly among the shard's eligible users (a
  user who has seen none or all items is never picked, and a shard without
  eligible users draws nothing), then a positive uniformly from that user's
  distinct items.
* ``per_positive``: every input row (duplicates kept) is a positive of
  eligible users, with ``negatives`` unseen items each.  Each of these draws is
  dealt to a shard by a hash of its user, item and copy, whoever the user is,
  so no user's rows are one shard's work; the draw order within a shard is
  (user, item, copy and negative).

In both, the negative is uniform over the items the user has not seen.  The
first candidate ``1 + h mod N`` is kept when unseen (one equi-join against
the seen pairs); a rejected draw takes the first unseen of ``REDRAWS`` further
candidates; what is still left is resolved exactly by unranking a fresh
``r`` in ``[0, N - n_items)`` to the r-th unseen item, one lookup in an index
built once per prepared data, so every draw ends and the result is exactly
uniform.  Draw numbers are dense per shard and every
random choice hashes (seed, purpose, iteration, shard, draw_no).

All lookups are equi-joins on unique keys: (shard, eligible rank) for the
user, whose row lists its items if they are few; for all other users (user, item
rank) for the positive and (user, item) for the candidate; and (user, block)
for the unranking, so no more than ``LISTED`` items of a user are gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.digests import number_pair, number_pairs
from ..functions.hashing import hash52_pair, uniform_below
from ..session import NUMBERS, intermediate_tables, ship_package, small_tasks, write_table
from ..session import materialise_small as materialise
from .interactions import TrainingData
from .joins import growing
from .ranking import rank_within

SAMPLE_COLUMNS = ["iteration", "shard", "draw_no", "user_idx", "pos_idx", "neg_idx"]


_DRAW = ("iteration", "shard", "draw_no")

# Tables in the ``workdir`` of ``sample_pairs`` that back its samples.
SAMPLE_TABLES = ("tried-negatives", "retried-negatives", "resolved-negatives")


# Items of a user that one row may list; the draws of users with more look them up pair by pair.
LISTED = 256


def drawn_users(data: TrainingData) -> DataFrame:
    """(shard, erank, user_idx, n_items, items): the eligible users and the items they have seen.

    ``items`` is in index order, and NULL for a user with more than ``LISTED``.
    """
    lists = (data.seen.where(F.col("n_items") <= LISTED).groupBy("user_idx")
             .agg(F.array_sort(F.collect_list("item_idx")).alias("items")))
    return (data.eligible.select("shard", "erank", "user_idx", "n_items").join(growing(lists), "user_idx", "left")
            .select("shard", "erank", "user_idx", "n_items", "items"))


# Draws that one batch of a task holds.
DRAW_ROWS = 65_536


def _numbered_draws(iteration: int, seed: int, samples_per_user: int, num_shards: int, num_items: int):
    """(shard, urank, n_eligible) of users → their draws: number, place of the drawn user
    (its rank and shard in one), number for the positive and first candidate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, urank, eligible = (batch.column(c).to_numpy() for c in ("shard", "urank", "n_eligible"))
            for at in range(0, len(shard) * samples_per_user, DRAW_ROWS):
                user, draw = np.divmod(np.arange(at, min(at + DRAW_ROWS, len(shard) * samples_per_user)), samples_per_user)
                of, draw_no = shard[user].astype(np.int64), urank[user] * samples_per_user + draw
                # one digest gives the user's and the positive's number
                (first, second), (candidate, _) = number_pairs(seed, ["draw", "cand"], iteration, of, draw_no)
                columns = (first % eligible[user] * num_shards + of, draw_no, second, candidate % num_items + 1)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_place", "draw_no", "_second", "cand"])
    return run


def uniform_user_draws(data: TrainingData, iteration: int, seed: int,
                       samples_per_user: int) -> DataFrame:
    """(iteration, shard, draw_no, user_idx, n_items, pos_idx, cand, items) for the uniform-user mode.

    A draw meets its user's row with the listed items, so its positive, and
    later its negative, need no further shuffle; ``items`` is NULL for a user
    with more than that, whose positives are looked up by (user, rank).
    ``cand`` is the draw's first candidate.
    """
    ship_package(data.users.sparkSession)
    # one row per shard: bounded by the configured shard count
    stats = F.broadcast(data.shard_stats.where("n_eligible > 0").select("shard", "n_eligible"))
    draws = data.users.select("shard", "urank").join(stats, "shard").select("shard", "urank", "n_eligible").mapInArrow(
        _numbered_draws(iteration, seed, samples_per_user, data.num_shards, data.num_items),
        "_place bigint, draw_no bigint, _second bigint, cand bigint")
    # joined by one number, which sorts several times as fast as two
    drawn = data.drawn_users().withColumn("_place", F.col("erank") * F.lit(data.num_shards) + F.col("shard"))
    draws = (draws.join(growing(drawn), "_place")
             .select(F.lit(iteration).alias("iteration"), "shard", "draw_no", "user_idx", "n_items",
                     F.pmod(F.col("_second"), F.col("n_items")).alias("item_rank"), "cand", "items"))
    listed = (draws.where("items IS NOT NULL")
              .withColumn("pos_idx", F.get("items", F.col("item_rank").cast("int"))))
    if not data.has_long_users():
        return listed.select(*_DRAW, "user_idx", "n_items", "pos_idx", "cand", "items")
    positives = data.seen.where(F.col("n_items") > LISTED).select("user_idx", "item_rank", F.col("item_idx").alias("pos_idx"))
    looked_up = draws.where("items IS NULL").join(growing(positives), ["user_idx", "item_rank"])
    return (listed.select(*_DRAW, "user_idx", "n_items", "pos_idx", "cand", "items")
            .unionByName(looked_up.select(*_DRAW, "user_idx", "n_items", "pos_idx", "cand", "items")))


def with_number(df: DataFrame, name: str, below: int, seed: int, purpose: str, *keys: str) -> DataFrame:
    """``df`` with ``name``, the number ``hashing.uniform_below`` gives for its integer ``keys``."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                first, _ = number_pair(seed, purpose, *(batch.column(c).to_numpy() for c in keys))
                yield batch.append_column(name, pa.array(first % below))
    return df.mapInArrow(run, f"{', '.join(f'{c} {kind}' for c, kind in df.dtypes)}, {name} bigint")


# Draws of one pair are expanded in blocks of this many, so that a pair with
# many copies is no single row's work.
COPY_BLOCK = 10_000


@dataclass
class PerPositivePlan:
    draws: DataFrame      # shard, draw_no, user_idx, n_items, pos_idx
    holders: DataFrame    # user_idx, shard, share: the shards a user's draws lie in, and how many


def per_positive_plan(data: TrainingData, negatives: int = 1, seed: int = 0) -> PerPositivePlan:
    """Static part of the per-positive mode: every (row copy, negative) of an
    eligible user, dealt to a shard and numbered densely within it.  Materialised once.

    The same rule holds for every user: draw c of pair (u, i) goes to shard
    ``hash(seed, u, i, c) mod P``, and each user's vector is merged from the
    shards that hold its draws.
    """
    _positive(negatives=negatives)
    with intermediate_tables(data.seen.sparkSession) as keep:
        plan = _per_positive_plan(data, negatives, seed)
        keep.extend([plan.draws, plan.holders])
    return plan


def _positive(**values) -> None:
    for name, value in values.items():
        if value < 1:
            raise ValueError(f"{name} must be positive, not {value}")


def _per_positive_plan(data: TrainingData, negatives: int, seed: int) -> PerPositivePlan:
    n = int(data.seen.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = F.col("copies") * F.lit(negatives)
    blocks = (data.seen.where(F.col("n_items") < F.lit(data.num_items))
              .select("user_idx", "n_items", F.col("item_idx").alias("pos_idx"), total.alias("_total"),
                      F.explode(F.sequence(F.lit(0).cast("bigint"),
                                           F.floor((total - 1) / F.lit(COPY_BLOCK)))).alias("_block"))
              .repartition(n, "user_idx", "pos_idx", "_block"))
    first = F.col("_block") * F.lit(COPY_BLOCK)
    rows = blocks.select("user_idx", "n_items", "pos_idx", F.explode(
        F.sequence(first, F.least(F.col("_total"), first + F.lit(COPY_BLOCK)) - 1)).alias("_c"))
    dealt = (with_number(rows, "shard", data.num_shards, seed, "shard", "user_idx", "pos_idx", "_c")
             .withColumn("shard", F.col("shard").cast("int")))
    ranked = rank_within(materialise(dealt, "dealt"), ["shard"], ["user_idx", "pos_idx", "_c"], "draw_no", few_groups=True)
    draws = materialise(ranked.select("shard", "draw_no", "user_idx", "n_items", "pos_idx")
                        .repartition(n, "shard", "draw_no"), "per-positive")
    held = materialise(draws.select("user_idx", "shard").distinct(), "held")
    holders = materialise(held.join(growing(held.groupBy("user_idx").agg(F.count(F.lit(1)).cast("int").alias("share"))),
                                    "user_idx"), "holders")
    return PerPositivePlan(draws=draws, holders=holders)


def per_positive_draws(plan: PerPositivePlan, iteration: int) -> DataFrame:
    return plan.draws.select(F.lit(iteration).alias("iteration"), "shard", "draw_no", "user_idx",
                             "n_items", "pos_idx")


# Empty blocks in a row that one row emits before they are dealt out.
EMPTY_RUN = 4096


def _block_width(n_items, num_items: int):
    """Ranks per block: as many blocks as the user has seen items, so that a user's blocks
    are no more than its pairs and no block lists more than sqrt(N) gaps."""
    return F.floor((F.lit(num_items) - 1) / n_items).cast("bigint")


def unseen_index(seen: DataFrame, num_items: int) -> DataFrame:
    """(user_idx, block, before, gaps): where the seen items stand among the ranks of the unseen.

    With a user's seen items sorted, item t (1-based index s_t) has
    ``gap_t = s_t - 1 - t`` unseen items below it.  Ranks 0 .. N - n_items - 1 of
    the unseen are cut into blocks; a block has the number of seen items below
    its first rank and, for each gap within, its offset and how many seen items
    share it.  Blocks without gaps stand too, so one equi-join finds any rank.
    """
    unseen = F.lit(num_items) - F.col("n_items")
    width = _block_width(F.col("n_items"), num_items)
    gap = F.col("item_idx") - 1 - F.col("item_rank")
    # an item above all unseen ones stands behind the last block
    last = F.floor((unseen - 1) / F.col("width"))
    rows = (seen.where(F.col("n_items") < F.lit(num_items))
            .select("user_idx", "n_items", F.col("item_rank").alias("t"), gap.alias("gap"), width.alias("width"))
            .withColumn("end", last + 1)
            .withColumn("block", F.when(F.col("gap") < unseen, F.floor(F.col("gap") / F.col("width"))).otherwise(F.col("end"))))
    filled = (rows.where((F.lit(num_items) - F.col("n_items") > F.col("gap")))
              .select("user_idx", "block", "t", (F.col("gap") % F.col("width")).alias("off"))
              .repartition("user_idx", "block").groupBy("user_idx", "block", "off")
              .agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("t"))
              .groupBy("user_idx", "block")
              .agg(F.min("t").alias("before"), F.array_sort(F.collect_list(F.struct("off", "n"))).alias("gaps")))
    following = rows.select("user_idx", (F.col("t") - 1).alias("t"), F.col("block").alias("next"))
    empty = (rows.join(growing(following), ["user_idx", "t"], "left")
             .select("user_idx", (F.col("block") + 1).alias("first"), F.coalesce("next", "end").alias("stop"),
                     (F.col("t") + 1).alias("before"))
             .unionByName(rows.where("t = 0").select("user_idx", F.lit(0).cast("bigint").alias("first"),
                                                     F.col("block").alias("stop"), F.lit(0).cast("bigint").alias("before")))
             .where("first < stop"))
    # a long run of empty blocks is dealt out in pieces
    runs = empty.select("user_idx", "before", "stop", F.explode(
        F.sequence("first", F.col("stop") - 1, F.lit(EMPTY_RUN).cast("bigint"))).alias("first")).repartition("user_idx", "first")
    none = F.array().cast("array<struct<off: bigint, n: bigint>>")
    blocks = runs.select("user_idx", F.explode(F.sequence("first", F.least(F.col("stop"), F.col("first") + EMPTY_RUN) - 1)).alias("block"),
                         "before", none.alias("gaps"))
    return filled.unionByName(blocks)


def unrank_unseen(draws: DataFrame, seen: DataFrame, num_items: int, r_col: str = "r",
                  out_col: str = "neg_idx", index: DataFrame | None = None) -> DataFrame:
    """The ``r``-th (0-based) item, in index order, that the draw's user has not seen.

    The answer is ``r + 1 + #{t : gap_t <= r}``: one lookup of the rank's block
    in ``index`` (``unseen_index`` of ``seen``, made here if not given).  Ranks
    fall evenly on a user's blocks, so a user with very many draws is no hot
    key.  A user without seen items has all items unseen.
    """
    keep = draws.columns
    if index is None or "n_items" not in keep:
        counts = seen.groupBy("user_idx").agg(F.count(F.lit(1)).alias("n_items"))
    if index is None:
        index = unseen_index(seen.drop("n_items").join(growing(counts), "user_idx"), num_items)
    asked = draws if "n_items" in keep else draws.join(growing(counts), "user_idx", "left")
    width = _block_width(F.col("n_items"), num_items)
    asked = asked.withColumn("_width", width).withColumn("_block", F.floor(F.col(r_col) / F.col("_width")))
    found = asked.join(growing(index.select("user_idx", F.col("block").alias("_block"), "before", "gaps")), ["user_idx", "_block"], "left")
    inside = F.aggregate(F.filter("gaps", lambda g: g["off"] <= F.col(r_col) % F.col("_width")), F.lit(0).cast("bigint"),
                         lambda total, g: total + g["n"])
    below = F.coalesce(F.col("before") + inside, F.lit(0))
    return found.select(*keep, (F.col(r_col) + 1 + below).cast("bigint").alias(out_col))


# Candidates a rejected draw tries before it is unranked.
REDRAWS = 8


def attach_negatives(draws: DataFrame, data: TrainingData, seed: int,
                     workdir: str | None = None) -> DataFrame:
    """Add ``neg_idx``, uniform over the items the draw's user has not seen.

    ``workdir``: folder for the intermediate table (default: a new scratch path).
    """
    n = data.num_items
    _, second = hash52_pair(seed, "cand", *_DRAW)
    pairs = growing(data.seen.select("user_idx", F.col("item_idx").alias("_cand"), F.lit(True).alias("_hit")))

    def judged(rows: DataFrame) -> DataFrame:
        # the second number is worked out for rejected draws alone
        return rows.select(*_DRAW, "user_idx", "n_items", "pos_idx",
                           F.when(F.coalesce("_hit", F.lit(False)), F.lit(None)).otherwise(F.col("_cand")).alias("neg_idx"),
                           F.when(F.col("_hit"), F.pmod(second, F.lit(n) - F.col("n_items"))).alias("r"))
    if "cand" in draws.columns:
        asked = draws.withColumnRenamed("cand", "_cand")
    else:
        asked = with_number(draws, "_cand", n, seed, "cand", *_DRAW).withColumn("_cand", F.col("_cand") + 1)
    if "items" in draws.columns:
        tried = judged(asked.where("items IS NOT NULL").withColumn("_hit", F.array_contains("items", F.col("_cand"))))
        if data.has_long_users():
            tried = tried.unionByName(judged(asked.where("items IS NULL").drop("items").join(pairs, ["user_idx", "_cand"], "left")))
    else:
        tried = judged(asked.join(pairs, ["user_idx", "_cand"], "left"))
    # read twice below (accepted, rejected): written once
    tried = _save(tried, workdir, "tried-negatives")
    accepted = tried.where(F.col("neg_idx").isNotNull()).drop("r")
    rejected = tried.where(F.col("neg_idx").isNull()).drop("neg_idx")
    again = (rejected.select(*_DRAW, "user_idx", F.explode(F.sequence(F.lit(1), F.lit(REDRAWS))).alias("_try"))
             .withColumn("_cand", (uniform_below(F.lit(n), seed, "again", *_DRAW, "_try") + 1).cast("bigint"))
             .join(pairs, ["user_idx", "_cand"], "left")
             .groupBy(*_DRAW).agg(F.min(F.when(F.col("_hit").isNull(), F.struct("_try", "_cand"))).alias("_found")))
    retried = _save(rejected.join(growing(again), list(_DRAW)).withColumn("neg_idx", F.col("_found._cand")).drop("_found"),
                    workdir, "retried-negatives")
    # all parts are files: the result has no lineage to recompute
    done = accepted.unionByName(retried.where("neg_idx IS NOT NULL").drop("r"))
    left = retried.where("neg_idx IS NULL").drop("neg_idx")
    if left.isEmpty():
        return done
    resolved = unrank_unseen(left, data.seen, n, index=data.unseen_index())
    return done.unionByName(_save(resolved.drop("r"), workdir, "resolved-negatives"))


def _save(df: DataFrame, workdir: str | None, name: str) -> DataFrame:
    if not workdir:
        return materialise(df, name)
    with small_tasks(df.sparkSession):
        return write_table(df, f"{workdir}/{name}", NUMBERS)


def sample_pairs(data: TrainingData, iteration: int, seed: int, mode: str = "uniform_user",
                 samples_per_user: int = 100, per_positive: PerPositivePlan | None = None,
                 negatives: int = 1, workdir: str | None = None) -> DataFrame:
    """samples(iteration, shard, draw_no, user_idx, pos_idx, neg_idx) for one iteration."""
    _positive(samples_per_user=samples_per_user, negatives=negatives)
    if mode == "uniform_user":
        draws = uniform_user_draws(data, iteration, seed, samples_per_user)
    elif mode == "per_positive":
        plan = per_positive if per_positive is not None else per_positive_plan(data, negatives, seed)
        draws = per_positive_draws(plan, iteration)
    else:
        raise ValueError(f"unknown sampling mode {mode!r}")
    return attach_negatives(draws, data, seed, workdir).select(*SAMPLE_COLUMNS)


def negatives_audit(samples: DataFrame, data: TrainingData) -> DataFrame:
    """One row: samples, and samples whose negative the user has in fact seen (must be 0)."""
    seen_pairs = data.seen.select("user_idx", F.col("item_idx").alias("neg_idx"), F.lit(1).alias("_hit"))
    flagged = samples.join(growing(seen_pairs), ["user_idx", "neg_idx"], "left")
    return flagged.agg(F.count(F.lit(1)).alias("n_samples"),
                       F.coalesce(F.sum("_hit"), F.lit(0)).cast("bigint").alias("n_seen_negatives"))


def unseen_items(samples: DataFrame, data: TrainingData) -> DataFrame:
    """Samples whose negative is really unseen by the user (a left-anti join
    against the seen pairs); equal to ``samples`` when sampling is correct."""
    seen_pairs = data.seen.select("user_idx", F.col("item_idx").alias("neg_idx"))
    return samples.join(growing(seen_pairs), ["user_idx", "neg_idx"], "left_anti")
