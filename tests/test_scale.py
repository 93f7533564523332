"""What keeps a task and the driver small as the tables grow."""

import numpy as np
import pandas as pd
import pytest

from pairrank.operators.interactions import prepare
from pairrank.operators.sampling import sample_pairs


@pytest.fixture(scope="module")
def small_data(spark):
    rng = np.random.default_rng(4)
    rows = [(u, i) for u in range(60) for i in rng.integers(0, 80, 1 + u % 40)] + [(99, i) for i in range(80)]
    return prepare(spark.createDataFrame(pd.DataFrame(rows, columns=["user_id", "item_id"])), num_shards=3)


def test_long_and_listed_users_draw_alike(spark, small_data, monkeypatch):
    """A user's draws do not depend on whether its row lists its items or they are looked up pair by pair."""
    from dataclasses import replace

    from pairrank.operators import sampling
    got = []
    for listed in (256, 12, 0):
        monkeypatch.setattr(sampling, "LISTED", listed)
        data = replace(small_data, _unseen=None, _drawn=None, _long=None)
        lists = data.drawn_users().where("items IS NOT NULL").count()
        assert data.has_long_users() == (lists < data.eligible.count())
        rows = sample_pairs(data, 1, 5, samples_per_user=4).collect()
        got.append((lists, sorted(map(tuple, rows))))
    assert got[0][0] >= got[1][0] >= got[2][0] == 0 and got[0][0] > 0
    assert got[0][1] == got[1][1] == got[2][1] and len(got[0][1]) == len(set(r[:3] for r in got[0][1])) > 0


def test_growing_tables_are_not_sent_through_the_driver(spark, small_data):
    """However small their files, the users, pairs and vectors are joined by merges."""
    from pairrank.operators.factors import init_factors
    from pairrank.operators.merge import merge_factors
    from pairrank.operators.ranking import rank_within
    from pairrank.operators.sampling import uniform_user_draws

    def joins(df):
        df.collect()  # the final plan, after adaptive execution
        return [line for line in df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].split("\n") if "Join" in line]
    draws = joins(uniform_user_draws(small_data, 1, 5, 3))
    assert sum("SortMergeJoin" in j for j in draws) >= 1 and sum("BroadcastHashJoin" in j for j in draws) == 1  # one row per shard
    items = init_factors(small_data.item_index, "item_idx", 2, 1, "item")
    moved = items.select("item_idx", items.factors.alias("delta_sum"))
    for df in (merge_factors(items, moved, "item_idx", 2, k=2), rank_within(small_data.seen.select("user_idx", "item_idx"), ["user_idx"], ["item_idx"], "r")):
        assert not any("Broadcast" in j for j in joins(df))


def test_written_tables_restore_the_task_size(spark):
    from pairrank.session import materialise_small, small_tasks
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    with small_tasks(spark):
        assert spark.conf.get(key) == "8m"
    assert spark.conf.get(key) == before and materialise_small(spark.range(3), "three").count() == 3
    assert spark.conf.get(key) == before


def test_draws_come_with_their_numbers_and_one_join_key(spark, small_data):
    """No digest is worked out row by row, and draws meet their users by one number."""
    from pairrank.operators.sampling import uniform_user_draws
    plan = uniform_user_draws(small_data, 1, 5, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5(" not in plan and "conv(" not in plan
    assert sum("Join Inner, (_place" in line for line in plan.split("\n")) == 1


def test_rank_within_few_groups_shuffles_no_rows_to_its_summary(spark, small_data):
    """The rows of a shard are ranked where they lie; the ranks are those of the merge."""
    from pairrank.operators.ranking import rank_within
    rows = small_data.seen.select("shard", "user_idx", "item_idx")
    ranks, merges = [], []
    for few in (False, True):
        ranked = rank_within(rows, ["shard"], ["user_idx", "item_idx"], "r", num_parts=5, few_groups=few)
        ranks.append(sorted(map(tuple, ranked.collect())))
        plan = ranked._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        merges.append("SortMergeJoin" in plan)
    assert merges == [True, False]
    want, seen = [], {}
    for shard, user, item in sorted(map(tuple, rows.collect())):
        want.append((shard, user, item, seen.setdefault(shard, 0)))
        seen[shard] += 1
    assert ranks[0] == ranks[1] == want


def test_dense_samples_get_all_items_without_an_aggregate(spark, small_data):
    """With more samples than items in all shards no distinct items are looked for, and the result is the same."""
    from pairrank.operators.factors import init_factors
    from pairrank.plans import fit as plans
    from pairrank.session import materialise

    users = init_factors(small_data.users, "user_idx", 2, 1, "user", keep=("shard",))
    items = init_factors(small_data.item_index, "item_idx", 2, 1, "item")
    config = plans.BPRConfig(k=2, num_shards=3, seed=5)
    samples = materialise(sample_pairs(small_data, 1, 5, samples_per_user=9), "dense-samples")
    assert samples.count() >= 3 * small_data.num_items
    dense = plans._shard_rows(samples, users, items, 2, 3)
    assert "Aggregate" not in dense._jdf.queryExecution().optimizedPlan().toString()
    assert dense.where("tag = 1").count() == 3 * small_data.num_items
    few = samples.where("draw_no < 20")
    assert few.count() < 3 * small_data.num_items
    sparse = plans._shard_rows(few, users, items, 2, 3)
    touched = {(r.shard, i) for r in few.collect() for i in (r.pos_idx, r.neg_idx)}
    assert {(r.shard, r.a) for r in sparse.where("tag = 1").collect()} == touched
    # a row that no step touched has no delta
    for rows in (samples, few):
        touched = {(r.shard, i) for r in rows.collect() for i in (r.pos_idx, r.neg_idx)}
        out = plans.run_shards(rows, users, items, config).where("kind = 'item'").collect()
        assert {(r.shard, r.idx) for r in out} == touched and len(out) == len(touched)


def test_places_of_even_and_uneven_ids():
    import pyarrow as pa

    from pairrank.operators.kernel import _Rows
    for ids in ([4], [3, 4, 5], [2, 12, 22, 32], [1, 2, 5, 9]):
        rows = _Rows(pa.table({"a": ids, "draw_no": [0] * len(ids), "v0": [0.0] * len(ids)}), 1)
        assert rows.places(np.array(ids[::-1])).tolist() == list(range(len(ids)))[::-1]
        assert rows.places(np.zeros(0, np.int64)).tolist() == []
        for wrong in (0, 7, 40):
            with pytest.raises(ValueError, match="did not receive"):
                rows.places(np.array([ids[0], wrong]))
    assert _Rows(pa.table({"a": [2, 12], "draw_no": [0, 0], "v0": [0.0, 0.0]}), 1).step == 10
