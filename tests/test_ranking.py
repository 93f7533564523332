"""Distributed dense indexes and within-group ranks, including a hot group."""

import pandas as pd

from pairrank.operators.ranking import dense_index, rank_within


def test_dense_index_gappy_ids(spark):
    df = spark.createDataFrame([(0,), (7,), (-3,), (7,), (None,)], "id bigint")
    got = dense_index(df, "id", "idx").toPandas().sort_values("id")
    assert got["id"].tolist() == [-3, 0, 7]
    assert got["idx"].tolist() == [1, 2, 3]


def test_rank_within_hot_group(spark):
    # one group holds a third of the rows; it must be ranked exactly
    rows = [(1, x) for x in range(0, 3000, 3)] + [(g, x) for g in range(2, 200) for x in range(10)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["g", "x"]))
    got = rank_within(df, ["g"], ["x"], "r", index_col="gi", count_col="n", num_parts=16).toPandas()
    exp = pd.DataFrame(rows, columns=["g", "x"])
    exp["r"] = exp.groupby("g")["x"].rank(method="first").astype(int) - 1
    exp["gi"] = exp["g"].rank(method="dense").astype(int)
    exp["n"] = exp.groupby("g")["x"].transform("count")
    m = got.merge(exp, on=["g", "x"], suffixes=("", "_e"))
    assert len(m) == len(exp) == len(got)
    assert (m["r"] == m["r_e"]).all()
    assert (m["gi"] == m["gi_e"]).all()
    assert (m["n"] == m["n_e"]).all()


def test_global_rank(spark):
    df = spark.range(0, 5000).selectExpr("id * 7 % 5003 AS v")
    got = rank_within(df, [], ["v"], "r", num_parts=8).toPandas().sort_values("v")
    assert got["r"].tolist() == list(range(5000))


def test_hot_group_spans_range_partitions(spark):
    # a group with a third of the rows must not land in a single range partition
    from pyspark.sql import functions as F

    from pairrank.operators.ranking import _tagged
    rows = [(7, x) for x in range(3000)] + [(g, x) for g in range(1000) if g != 7 for x in range(6)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["g", "x"]))
    tagged = _tagged(df, ["g", "x"], 8, "hot")
    parts = tagged.where("g = 7").select("_part").distinct().count()
    assert parts >= 2
    assert tagged.groupBy("_part").count().agg(F.max("count")).first()[0] < 3000
