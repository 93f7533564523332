"""Draw counts, eligibility, exact unseen negatives, determinism."""

import numpy as np
import pandas as pd

from pairrank.operators.interactions import prepare
from pairrank.operators.sampling import negatives_audit, sample_pairs, unrank_unseen, unseen_items
from pairrank.sources.tables import interactions_from_orders

SF_SMALL = "/root/testdata/sf0.001"


def _inter(spark, rows):
    return spark.createDataFrame(pd.DataFrame(rows, columns=["user_id", "item_id"]))


def test_saturated_users_draw_nothing(spark):
    # items 0..4; users 10 and 12 have seen everything, user 11 has not.
    rows = [(10, i) for i in range(5)] + [(12, i) for i in range(5)] + [(11, 0), (11, 3), (11, 3)]
    data = prepare(_inter(spark, rows), num_shards=2)
    users = data.users.toPandas().set_index("user_id")
    assert not users.loc[10, "eligible"] and users.loc[11, "eligible"]
    s = sample_pairs(data, 1, 3, samples_per_user=20).toPandas()
    # user_idx 1 and 3 (ids 10, 12) form shard 1, which has no eligible user
    assert set(s["shard"]) == {0}
    assert len(s) == 20 * 1  # 20 per user held by shard 0 (user 11 only)
    assert set(s["user_idx"]) == {2}
    assert set(s["neg_idx"]) <= {2, 3, 5}  # unseen items 1, 2, 4 -> idx 2, 3, 5
    pp = sample_pairs(data, 1, 3, mode="per_positive").toPandas()
    assert len(pp) == 3 and set(pp["user_idx"]) == {2}


def test_negatives_unseen_and_counts(spark):
    data = prepare(interactions_from_orders(spark, SF_SMALL), num_shards=4)
    s = sample_pairs(data, 2, 11, samples_per_user=30)
    audit = negatives_audit(s, data).collect()[0]
    assert audit.n_seen_negatives == 0
    assert unseen_items(s, data).count() == audit.n_samples
    per_shard = s.groupBy("shard").count().toPandas().set_index("shard")["count"]
    users = data.shard_stats.toPandas().set_index("shard")["n_users"]
    for shard, n in per_shard.items():
        assert n == 30 * users[shard]


def test_unrank_matches_brute_force(spark):
    rows = [(1, i) for i in (0, 1, 2, 5, 6, 9)] + [(2, 3), (2, 4)] + [(3, i) for i in range(9)]
    data = prepare(_inter(spark, rows), num_shards=1)
    n = data.num_items
    seen = data.seen.toPandas()
    sets = {u: set(g["item_idx"]) for u, g in seen.groupby("user_idx")}
    probes = [(k, u, r) for k, (u, r) in enumerate((u, r) for u in sets for r in range(n - len(sets[u])))]
    df = spark.createDataFrame(pd.DataFrame(probes, columns=["k", "user_idx", "r"]))
    got = unrank_unseen(df, data.seen, n).toPandas()
    for _, row in got.iterrows():
        unseen = [i for i in range(1, n + 1) if i not in sets[row.user_idx]]
        assert unseen[row.r] == row.neg_idx


def test_same_draws_for_other_partition_counts(spark):
    inter = interactions_from_orders(spark, SF_SMALL)
    data = prepare(inter, num_shards=3)
    a = sample_pairs(data, 1, 5, samples_per_user=10).toPandas()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        data2 = prepare(inter, num_shards=3)
        b = sample_pairs(data2, 1, 5, samples_per_user=10).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    key = ["shard", "draw_no"]
    a, b = a.sort_values(key).reset_index(drop=True), b.sort_values(key).reset_index(drop=True)
    assert a.equals(b)


def test_negatives_roughly_uniform(spark):
    rows = [(1, 0), (1, 1)] + [(2, i) for i in range(10)]
    data = prepare(_inter(spark, rows), num_shards=1)
    s = sample_pairs(data, 1, 9, samples_per_user=4000).toPandas()
    negs = s[s.user_idx == 1]["neg_idx"].value_counts()
    assert set(negs.index) == set(range(3, 11))
    assert np.abs(negs.values / negs.values.sum() - 1 / 8).max() < 0.03


def test_draws_do_not_depend_on_the_join_strategy(spark):
    inter = interactions_from_orders(spark, SF_SMALL)
    a = sample_pairs(prepare(inter, num_shards=3), 1, 5, samples_per_user=10).toPandas()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        data = prepare(inter, num_shards=3)
        b = sample_pairs(data, 1, 5, samples_per_user=10).toPandas()
        data.close()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    key = ["shard", "draw_no"]
    assert a.sort_values(key).reset_index(drop=True).equals(b.sort_values(key).reset_index(drop=True))


def test_catalogue_items_are_drawn_as_negatives(spark):
    rows = [(1, 5), (1, 7), (2, 7)]
    catalogue = spark.createDataFrame([(i,) for i in (3, 5, 9, None)], "item_id long")
    data = prepare(_inter(spark, rows), num_shards=1, catalogue=catalogue)
    index = {r.item_id: r.item_idx for r in data.item_index.collect()}
    assert index == {3: 1, 5: 2, 7: 3, 9: 4} and data.num_items == 4
    s = sample_pairs(data, 1, 9, samples_per_user=200).toPandas()
    assert set(s[s.user_idx == 1].neg_idx) == {1, 4} and set(s[s.user_idx == 2].neg_idx) == {1, 2, 4}


def test_null_ids_are_counted_or_raise(spark):
    import pytest
    df = spark.createDataFrame([(1, 5), (1, None), (None, 6), (None, 6), (2, 6)], "user_id long, item_id long")
    data = prepare(df, num_shards=1)
    assert data.n_null_rows == 3 and data.num_users == 2 and data.num_items == 2
    with pytest.raises(ValueError, match="3 interaction rows"):
        prepare(df, num_shards=1, strict=True)


def test_one_index_serves_all_ranks(spark):
    """Clustered, spread, single and nearly all items seen: every rank, by the kept index; its size is bounded."""
    rng = np.random.default_rng(6)
    n = 300
    sets = [range(100, 200), [0], [n - 1], range(n - 1), range(1, n), rng.choice(n, 40, replace=False), [*range(10), *range(290, n)]]
    rows = [(u, int(i)) for u, items in enumerate(sets) for i in items] + [(99, i) for i in range(n)]
    data = prepare(_inter(spark, rows), num_shards=2)
    assert data.num_items == n
    index = data.unseen_index()
    assert index is data.unseen_index()
    seen = data.seen.toPandas()
    mine = {u: set(g["item_idx"]) for u, g in seen.groupby("user_idx")}
    blocks = index.toPandas()
    for u, g in blocks.groupby("user_idx"):
        assert len(g) <= len(mine[u]) + 1 and g["block"].is_unique and g["gaps"].map(len).max() <= 18
    probes = [(k, u, len(s), r) for k, (u, s, r) in enumerate((u, s, r) for u, s in mine.items() for r in range(n - len(s)))]
    df = spark.createDataFrame(pd.DataFrame(probes, columns=["k", "user_idx", "n_items", "r"]))
    got = unrank_unseen(df, data.seen, n, index=index).toPandas()
    assert len(got) == len(probes)
    unseen = {u: [i for i in range(1, n + 1) if i not in s] for u, s in mine.items()}
    assert all(unseen[row.user_idx][row.r] == row.neg_idx for row in got.itertuples())


def test_index_is_built_once_and_released(spark):
    rows = [(1, i) for i in range(199)] + [(2, 5), (3, 199)]
    data = prepare(_inter(spark, rows), num_shards=1)
    a = sample_pairs(data, 1, 9, samples_per_user=60)
    kept = data._unseen
    assert kept is not None and set(a.where("user_idx = 1").select("neg_idx").toPandas()["neg_idx"]) == {200}
    sample_pairs(data, 2, 9, samples_per_user=60).count()
    assert data._unseen is kept
    data.close()
    assert data._unseen is None


def test_stats_plan_has_no_expand(spark):
    from pairrank.operators.interactions import interaction_stats
    df = spark.createDataFrame([(1, 5), (1, 5), (1, None), (None, 6), (2, 6)], "user_id long, item_id long")
    stats = interaction_stats(df)
    assert "Expand" not in stats._jdf.queryExecution().toString()
    assert tuple(stats.first()) == (5, 2, 2, 2, 1, 2, 5, 6)
    assert tuple(interaction_stats(df.where("false")).first()) == (0, 0, 0, 0, None, None, None, None)


def test_ranks_before_items_above_all_unseen_ones(spark):
    """User 1 has seen 1, 2 and 17 of 17 items: the last block of its unseen ones has no gap."""
    from pyspark.sql import functions as F
    seen = spark.createDataFrame([(1, 1, 0), (1, 2, 1), (1, 17, 2)], "user_idx bigint, item_idx bigint, item_rank bigint")
    draws = spark.range(14).select(F.lit(1).cast("bigint").alias("user_idx"), F.col("id").alias("r"))
    assert {x.r: x.neg_idx for x in unrank_unseen(draws, seen, 17).collect()} == {r: r + 3 for r in range(14)}
