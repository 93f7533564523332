"""A heavy key's rows are shared by all tasks, and the joined rows are the same."""

import pytest
from pyspark.sql import functions as F

from pairrank.operators.joins import heavy_keys, spread_join
from pairrank.operators.score import score_pairs


@pytest.fixture
def plain_joins(spark):
    """No broadcast of the lookup side, no help from adaptive execution."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": "12"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture
def rows(spark):
    """Item 7 has half of the rows, item 8 a quarter, 900 rows have none."""
    n = F.col("id")
    return spark.range(24_000).select(n.alias("user_id"), F.when(n < 900, None).when(n % 2 == 0, 7).when(n % 4 == 1, 8)
                                      .otherwise(n % 5000).alias("item_id"))


def test_heavy_key_uses_all_tasks(spark, rows, plain_joins):
    table = spark.range(4000).select(F.col("id").alias("item_id"), (F.col("id") * 2).alias("v"))
    joined = spread_join(rows, table, "item_id", "left")
    assert joined.columns == ["user_id", "item_id", "v"]
    tasks = {r.p: r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()}
    assert len(tasks) == 12 and max(tasks.values()) < 3 * 24_000 / 12
    got = sorted(map(tuple, joined.collect()), key=repr)
    assert got == sorted(map(tuple, rows.join(table, "item_id", "left").select(joined.columns).collect()), key=repr)
    inner = spread_join(rows, table, "item_id")
    assert inner.count() == rows.join(table, "item_id").count()


def test_heavy_list_is_bounded(spark, rows, plain_joins):
    found = {r.item_id: r["_parts"] for r in heavy_keys(rows, "item_id").collect()}
    assert set(found) == {7, 8} and found[7] > found[8] > 1 and sum(found.values()) <= 3 * 12
    even = spark.range(1000).select(F.col("id").alias("item_id"))
    assert heavy_keys(even, "item_id").count() == 0 and heavy_keys(even.where("false"), "item_id").count() == 0


def test_scores_with_hot_user_and_item(spark, plain_joins):
    n = F.col("id")
    pairs = spark.range(6000).select(F.when(n % 3 == 0, 1).otherwise(n % 50).alias("user_id"),
                                     F.when(n % 2 == 0, 2).otherwise(n % 70).alias("item_id"))

    def side(name, size):
        ids = spark.range(size).select(F.col("id").alias(f"{name}_id"), (F.col("id") + 1).alias(f"{name}_idx"))
        return ids, ids.select(f"{name}_idx", F.array(*[F.col(f"{name}_idx") * (d + 1.0) for d in range(3)]).alias("factors"))
    (ui, uf), (ii, jf) = side("user", 45), side("item", 66)
    got = score_pairs(pairs, ui, ii, uf, jf, k=3).collect()
    assert len(got) == 6000
    for r in got:
        known = r.user_id < 45 and r.item_id < 66
        assert r.score == ((r.user_id + 1) * (r.item_id + 1) * 14.0 if known else None)
