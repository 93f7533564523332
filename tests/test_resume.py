"""Stopped runs: what is resumed ends as if it had never stopped, bit for bit."""

from dataclasses import replace

import pytest

from pairrank.operators.interactions import prepare
from pairrank.plans.fit import BPRConfig, fit
from pairrank.plans.manifest import latest_manifest
from pairrank.session import list_names, read_file, scratch_path, write_file
from pairrank.sources.tables import interactions_from_orders

SF_SMALL = "/root/testdata/sf0.001"


def factors(model):
    return ({r.user_idx: (r.shard, tuple(r.factors)) for r in model.user_factors.collect()},
            {r.item_idx: tuple(r.factors) for r in model.item_factors.collect()})


@pytest.fixture(scope="module")
def inter(spark):
    return interactions_from_orders(spark, SF_SMALL)


@pytest.mark.parametrize("options", [dict(strategy="user_sharded"), dict(strategy="full_average"),
                                     dict(strategy="user_sharded", sampling="per_positive")])
def test_resumed_equals_uninterrupted(spark, inter, options):
    cfg = BPRConfig(k=3, iterations=4, num_shards=2, samples_per_user=5, seed=9, **options)
    whole = fit(inter, cfg)
    folder = scratch_path(spark, "stopped")
    stopped = fit(inter, replace(cfg, iterations=2), workdir=folder)
    assert stopped.run_path == folder and latest_manifest(spark, folder)["iteration"] == 2
    # the iteration it was in left tables, but no manifest
    spark.range(5).write.parquet(f"{folder}/iter-3/items")
    spark.range(5).write.parquet(f"{folder}/iter-3/shards")
    spark.range(5).write.parquet(f"{folder}/iter-3/tried-negatives")
    resumed = fit(None, cfg, resume=folder)
    assert factors(resumed) == factors(whole)
    # a finished run gives its result again, whoever prepared the same interactions
    again = fit(inter, cfg, resume=folder)
    assert factors(again) == factors(whole)
    assert sorted(r.score for r in again.score(inter.distinct()).collect()) == \
        sorted(r.score for r in whole.score(inter.distinct()).collect())


def test_what_may_not_differ(spark, inter):
    cfg = BPRConfig(k=2, iterations=1, num_shards=2, samples_per_user=2, seed=1)
    folder = fit(inter, cfg).run_path
    with pytest.raises(ValueError, match="seed = 1, not 2"):
        fit(inter, replace(cfg, seed=2), resume=folder)
    with pytest.raises(ValueError, match="not those"):
        fit(inter.where("user_id % 2 = 0"), cfg, resume=folder)
    with pytest.raises(ValueError, match="holds a run"):
        fit(inter, cfg, workdir=folder)
    with pytest.raises(ValueError, match="no finished iteration"):
        fit(inter, cfg, resume=scratch_path(spark, "nothing"))
    with pytest.raises(ValueError, match="cannot be resumed"):
        fit(inter, cfg, resume=folder, trace=True)
    more = fit(None, replace(cfg, iterations=3, retain_iterations=None), data=prepare(inter, 2), resume=folder)
    assert latest_manifest(spark, folder)["iteration"] == 3 and len(more.paths) == 3


def test_files_appear_whole(spark):
    folder = scratch_path(spark, "files")
    assert list_names(spark, folder) == []
    write_file(spark, f"{folder}/a.json", "{\n \"ü\": 1\n}")
    assert list_names(spark, folder) == ["a.json"] and read_file(spark, f"{folder}/a.json") == "{\n \"ü\": 1\n}"
    with pytest.raises(OSError):
        write_file(spark, f"{folder}/a.json", "other")
    assert read_file(spark, f"{folder}/a.json").startswith("{") and list_names(spark, folder) == ["a.json"]
