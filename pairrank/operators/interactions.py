"""From raw (user_id, item_id) rows to the static tables training reads.

``prepare`` builds, once per fit:

* ``seen``   one row per distinct (user, item): dense 1-based ``user_idx`` and
  ``item_idx``, the item's 0-based ``item_rank`` in the user's item set
  (ordered by item), the number of ``copies`` in the input, the user's
  ``n_items`` and ``shard``;
* ``users``  one row per user: shard, position in the shard, item and row
  counts, eligibility, and the position among the shard's eligible users;
* ``shard_stats`` one row per shard (bounded by the shard count).

Indexes are dense over the ids actually seen, so gaps, zero or negative ids
never create phantom rows; the shard of a user is ``user_idx mod P``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_path, intermediate_tables
from ..session import materialise_small as materialise
from .joins import growing, spread_join
from .ranking import dense_index, rank_within


def assign_shards(df: DataFrame, num_shards: int, idx_col: str = "user_idx") -> DataFrame:
    """Hash-partition key: ``pmod(user_idx, P)``, the integer-key hash partitioner's mapping."""
    return df.withColumn("shard", F.pmod(F.col(idx_col), F.lit(num_shards)).cast("int"))


def interaction_stats(interactions: DataFrame) -> DataFrame:
    """Row, pair, user and item counts and id ranges.

    Rows are folded to pairs first, then to one row per user and per item, each
    combined before its shuffle; the three totals are rows of one small table.  A pair with a NULL id is no pair and a NULL id
    no user or item.
    """
    pairs = interactions.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n"))

    def ids(side: str) -> DataFrame:
        one = pairs.where(F.col(f"{side}_id").isNotNull()).groupBy(f"{side}_id").agg(F.lit(1).alias("one"))
        return one.agg(F.count(F.lit(1)).alias(f"n_{side}s"), F.min(f"{side}_id").alias(f"min_{side}_id"),
                       F.max(f"{side}_id").alias(f"max_{side}_id"))
    whole = F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
    totals = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"), F.count_if(whole).alias("n_pairs"))
    rows = totals.unionByName(ids("user"), allowMissingColumns=True).unionByName(ids("item"), allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in ("n_rows", "n_pairs", "n_users", "n_items", "min_user_id", "max_user_id",
                                                  "min_item_id", "max_item_id")])


def folded_pairs(interactions: DataFrame) -> DataFrame:
    """(user_id, item_id, copies), one row per distinct pair, NULL ids included."""
    return interactions.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("copies"))


def ranked_pairs(pairs: DataFrame, num_parts: int | None = None,
                 item_index: DataFrame | None = None) -> DataFrame:
    """Distinct pairs (user_id, item_id, copies) with dense indexes and item rank within the user.

    The item numbers are those of ``item_index`` (item_id, item_idx; made of
    the pairs if not given), joined with the rows of a hot item dealt over
    several tasks; user numbers and ranks come from a range-partitioned pass
    (see ``ranking``), which splits a hot user.
    """
    if item_index is None:
        item_index = materialise(dense_index(pairs, "item_id", "item_idx", num_parts), "item-index")
    # written once: the range partitioning samples its input before reading it
    with_items = materialise(spread_join(pairs, item_index, "item_id"), "with-items")
    return rank_within(with_items, ["user_id"], ["item_id"], "item_rank", index_col="user_idx", count_col="n_items",
                       num_parts=num_parts or range_parts(with_items))


# Rows that one task of a range-partitioned pass sorts; more rows get more tasks.
RANGE_ROWS = 1_000_000


def range_parts(stored: DataFrame) -> int | None:
    """Partitions of a pass over a stored table; none asked for if it is small."""
    rows = stored.count()
    tasks = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(tasks, math.ceil(rows / RANGE_ROWS)) if rows > RANGE_ROWS else None


@dataclass
class TrainingData:
    seen: DataFrame
    users: DataFrame
    shard_stats: DataFrame
    item_index: DataFrame
    num_users: int
    num_items: int
    num_shards: int
    n_null_rows: int = 0      # input rows left out because an id is NULL
    _unseen: DataFrame | None = None
    _drawn: DataFrame | None = None
    _long: bool | None = None

    def unseen_index(self) -> DataFrame:
        """Where each user's seen items stand among the ranks of its unseen ones; built at the first need."""
        if self._unseen is None:
            from .sampling import unseen_index
            self._unseen = materialise(unseen_index(self.seen, self.num_items), "unseen-index")
        return self._unseen

    def drawn_users(self) -> DataFrame:
        """The eligible users with their items where they are few; built at the first need."""
        if self._drawn is None:
            from .sampling import drawn_users
            self._drawn = materialise(drawn_users(self), "drawn-users")
        return self._drawn

    def has_long_users(self) -> bool:
        """Whether some eligible user has more items than a row lists."""
        if self._long is None:
            self._long = not self.drawn_users().where("items IS NULL").isEmpty()
        return self._long

    @property
    def user_index(self) -> DataFrame:
        return self.users.select("user_id", "user_idx")

    @property
    def eligible(self) -> DataFrame:
        return self.users.where("eligible")

    def close(self) -> None:
        """Delete the prepared tables."""
        for df in (self.seen, self.users, self.shard_stats, self.item_index, self._unseen, self._drawn):
            if getattr(df, "_scratch_path", None):
                delete_path(df.sparkSession, df._scratch_path)
        self._unseen = self._drawn = self._long = None


def prepare(interactions: DataFrame, num_shards: int, num_parts: int | None = None,
            catalogue: DataFrame | None = None, strict: bool = False) -> TrainingData:
    """Build and materialise the static training tables.

    ``catalogue`` (item_id): items that exist besides the seen ones; they are
    indexed with them and can be drawn as negatives.  Rows with a NULL id are
    left out and counted in ``n_null_rows``; ``strict`` raises instead.
    Intermediate tables (pairs, tagged rows) are deleted once the results exist.
    """
    if num_shards < 1:
        raise ValueError(f"num_shards must be positive, not {num_shards}")
    spark = interactions.sparkSession
    with intermediate_tables(spark) as keep:
        folded = materialise(folded_pairs(interactions), "pairs")
        whole = F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
        n_null = folded.where(~whole).agg(F.sum("copies")).first()[0] or 0
        if strict and n_null:
            raise ValueError(f"{n_null} interaction rows have a NULL user_id or item_id")
        pairs = folded.where(whole)
        ids = pairs.select("item_id")
        if catalogue is not None:
            ids = ids.unionByName(catalogue.select(F.col("item_id").cast("bigint").alias("item_id")))
        item_index = materialise(dense_index(ids, "item_id", "item_idx", num_parts), "item-index")
        seen = materialise(
            assign_shards(ranked_pairs(pairs, num_parts, item_index), num_shards)
            .select("user_id", "user_idx", "item_id", "item_idx", "item_rank", "copies",
                    "n_items", "shard"),
            "seen")
        users, shard_stats = _user_tables(seen, item_index.count(), num_shards, num_parts)
        keep.extend([seen, item_index, users, shard_stats])
    return _training_data(seen, users, shard_stats, item_index, num_shards, int(n_null))


def _user_tables(seen: DataFrame, num_items: int, num_shards: int, num_parts: int | None) -> tuple[DataFrame, DataFrame]:
    """The users and shard_stats tables of a stored ``seen``."""
    per_user = materialise(
        seen.groupBy("user_idx", "user_id", "shard", "n_items")
        .agg(F.sum("copies").cast("bigint").alias("n_rows"))
        .withColumn("urank", F.floor((F.col("user_idx") - 1) / F.lit(num_shards)).cast("bigint"))
        .withColumn("eligible", (F.col("n_items") > 0) & (F.col("n_items") < F.lit(num_items))),
        "per-user")
    eligible = rank_within(per_user.where("eligible"), ["shard"], ["user_idx"], "erank",
                           num_parts=num_parts, few_groups=True)
    # written in as many balanced parts as shuffle partitions: every iteration
    # generates its draws from this table without a shuffle before them
    n = int(seen.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    users = materialise(
        eligible.unionByName(per_user.where("NOT eligible").withColumn("erank", F.lit(None).cast("bigint")))
        .repartition(n, "user_idx"),
        "users")
    shard_stats = materialise(
        users.groupBy("shard").agg(F.count(F.lit(1)).alias("n_users"),
                                   F.sum(F.col("eligible").cast("bigint")).alias("n_eligible")),
        "shard-stats")
    return users, shard_stats


def _training_data(seen, users, shard_stats, item_index, num_shards: int, n_null: int) -> TrainingData:
    return TrainingData(seen=seen, users=users, shard_stats=shard_stats, item_index=item_index, num_users=users.count(),
                        num_items=item_index.count(), num_shards=num_shards, n_null_rows=n_null)


def append(data: TrainingData, interactions: DataFrame, num_parts: int | None = None, strict: bool = False) -> TrainingData:
    """``data`` with more interactions, as a new TrainingData; ``data`` stays as it is.

    Known users and items keep their indexes (and users their shards); new ids
    are numbered behind them in id order.  Only the users that have new pairs get
    their item sets ranked anew, in index order; the rows of all others are
    taken over.  NULL ids are counted or refused as by ``prepare``.
    """
    spark = interactions.sparkSession
    with intermediate_tables(spark) as keep:
        folded = materialise(folded_pairs(interactions), "pairs")
        whole = F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
        n_null = folded.where(~whole).agg(F.sum("copies")).first()[0] or 0
        if strict and n_null:
            raise ValueError(f"{n_null} interaction rows have a NULL user_id or item_id")
        pairs = folded.where(whole)

        def extended(known: DataFrame, id_col: str, idx_col: str, size: int) -> DataFrame:
            new = dense_index(pairs.join(growing(known), id_col, "left_anti"), id_col, idx_col, num_parts)
            return materialise(known.select(id_col, idx_col).unionByName(
                new.select(id_col, (F.col(idx_col) + size).alias(idx_col))), f"index-{idx_col}")
        item_index = extended(data.item_index, "item_id", "item_idx", data.num_items)
        user_index = extended(data.user_index, "user_id", "user_idx", data.num_users)
        added = materialise(spread_join(spread_join(pairs, user_index, "user_id"), item_index, "item_id")
                            .select("user_id", "user_idx", "item_id", "item_idx", "copies"), "added")
        touched = added.select("user_idx").distinct()
        key = ["user_id", "user_idx", "item_id", "item_idx"]
        merged = materialise(data.seen.join(growing(touched), "user_idx", "left_semi").select(*key, "copies").unionByName(added)
                             .groupBy(*key).agg(F.sum("copies").alias("copies")), "merged")
        ranked = rank_within(merged, ["user_idx"], ["item_idx"], "item_rank", count_col="n_items", num_parts=num_parts)
        fresh = assign_shards(ranked, data.num_shards).select(*data.seen.columns)
        seen = materialise(data.seen.join(growing(touched), "user_idx", "left_anti").select(*data.seen.columns).unionByName(fresh), "seen")
        users, shard_stats = _user_tables(seen, item_index.count(), data.num_shards, num_parts)
        keep.extend([seen, item_index, users, shard_stats])
    return _training_data(seen, users, shard_stats, item_index, data.num_shards, data.n_null_rows + int(n_null))


def user_items(data: TrainingData) -> DataFrame:
    """(user_idx, shard, item_rank, item_idx, copies): each user's distinct items in
    index order, with the number of input rows per pair (the grouped form)."""
    return data.seen.select("user_idx", "shard", "item_rank", "item_idx", "copies")


def shard_users(data: TrainingData) -> DataFrame:
    """(shard, user_idx, urank, n_items, eligible, erank)."""
    return data.users.select("shard", "user_idx", "urank", "n_items", "eligible", "erank")


def eligible_users(data: TrainingData) -> DataFrame:
    """Users who can be trained: at least one seen and one unseen item."""
    return data.eligible.select("shard", "user_idx", "erank", "n_items")
