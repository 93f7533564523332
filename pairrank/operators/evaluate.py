"""Held-out evaluation: a hash-based split and pairwise AUC on sampled pairs.

Not an operator of the training job itself; it is what the learning test uses
to tell a trained model from a random one.  Every held-out positive is paired
with one unseen item drawn exactly as training draws negatives, so no
all-pairs scoring is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import uniform_below
from ..functions.vectors import pair_margin
from .joins import growing, spread_join
from .sampling import unrank_unseen


def holdout_split(interactions: DataFrame, fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) by hashing the distinct pair, so every copy of a pair lands together."""
    bucket = uniform_below(F.lit(1_000_000), seed, "holdout", "user_id", "item_id")
    tagged = interactions.withColumn("_b", bucket < F.lit(int(fraction * 1_000_000)))
    return tagged.where(~F.col("_b")).drop("_b"), tagged.where(F.col("_b")).drop("_b")


def pairwise_auc(model, test: DataFrame, seed: int = 0) -> DataFrame:
    """One row: the share of (held-out positive, random unseen item) pairs that
    the model orders correctly (ties count half), and the number of pairs."""
    data = model.data
    known = spread_join(test.select("user_id", "item_id").distinct(), data.user_index, "user_id")
    pos = (spread_join(known, data.item_index, "item_id")
           .join(growing(data.users.select("user_idx", "n_items")), "user_idx")
           .where(F.col("n_items") < F.lit(data.num_items)))
    draws = pos.withColumn("r", uniform_below(F.lit(data.num_items) - F.col("n_items"), seed, "auc",
                                              "user_idx", "item_idx"))
    with_neg = unrank_unseen(draws.select("user_idx", "item_idx", "n_items", "r"), data.seen,
                             data.num_items, out_col="neg_idx", index=data.unseen_index())
    uf = model.user_factors.select("user_idx", F.col("factors").alias("u"))
    pf = model.item_factors.select(F.col("item_idx"), F.col("factors").alias("p"))
    nf = model.item_factors.select(F.col("item_idx").alias("neg_idx"), F.col("factors").alias("n"))
    scored = (spread_join(spread_join(spread_join(with_neg, uf, "user_idx"), pf, "item_idx"), nf, "neg_idx")
              .select(pair_margin("u", "p", "n", model.config.k).alias("x")))
    return scored.agg(F.avg(F.when(F.col("x") > 0, 1.0).when(F.col("x") == 0, 0.5).otherwise(0.0)).alias("auc"),
                      F.count(F.lit(1)).alias("n_pairs"))
