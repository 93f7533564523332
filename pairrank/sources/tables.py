"""Interaction sources built from the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def interactions_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer, part) for every order line, duplicates kept."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return (orders.join(lines, orders.o_orderkey == lines.l_orderkey)
            .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")))


def item_key_of_props(props: str = "props"):
    """The item key ``$.k`` of an event's JSON properties, as text."""
    return F.get_json_object(F.col(props), "$.k")


def interactions_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, ``$.k`` of props) for every event, duplicates kept."""
    events = load(spark, sf_dir, "events")
    return events.select(F.col("user_id").cast("bigint").alias("user_id"),
                         item_key_of_props().cast("bigint").alias("item_id"))
