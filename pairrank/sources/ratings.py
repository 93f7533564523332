"""``user::item::...`` text ratings: read, write, and the implicit-score form.

Only fields 0 and 1 are read; whatever follows (rating, timestamp) is ignored
and every line counts as one positive with the constant score "1".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Field separator and the implicit score of every line.
SEPARATOR = "::"
IMPLICIT_SCORE = "1"


def _fields(value: Column) -> tuple[Column, Column]:
    parts = F.split(value, SEPARATOR)
    return F.get(parts, 0), F.get(parts, 1)


def ratings_behaviour(spark: SparkSession, path: str) -> DataFrame:
    """Lines as behaviour rows: user, item, bhv_amt "1"; the rest NULL."""
    user, item = _fields(F.col("value"))
    return spark.read.text(path).select(
        user.alias("user_id"), item.alias("item_id"),
        F.lit(None).cast("string").alias("bhv_type"),
        F.lit(IMPLICIT_SCORE).alias("bhv_amt"),
        F.lit(None).cast("string").alias("bhv_cnt"),
        F.lit(None).cast("string").alias("content"),
        F.lit(None).cast("string").alias("bhv_datetime"),
        F.col("value").alias("_line"))


def to_interactions(behaviour: DataFrame, strict: bool = True) -> DataFrame:
    """Integer (user_id, item_id) pairs from text ids.

    strict: a missing or non-integer id fails the job, naming the line.
    lenient: such rows are dropped.
    """
    user = F.col("user_id").try_cast("bigint")
    item = F.col("item_id").try_cast("bigint")
    if not strict:
        return (behaviour.select(user.alias("user_id"), item.alias("item_id"))
                .where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull()))
    line = F.col("_line") if "_line" in behaviour.columns else F.concat_ws(
        SEPARATOR, F.col("user_id"), F.col("item_id"))
    # a filter that can raise stays in the plan whatever columns are read, also for a count
    fail = F.raise_error(F.concat(F.lit("malformed ratings line: "), F.coalesce(line, F.lit("NULL"))))
    good = F.when(user.isNull() | item.isNull(), fail.cast("boolean")).otherwise(F.lit(True))
    return behaviour.where(good).select(user.alias("user_id"), item.alias("item_id"))


def read_ratings(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """``user::item[::...]`` lines → interactions(user_id bigint, item_id bigint)."""
    return to_interactions(ratings_behaviour(spark, path), strict=strict)


def write_ratings(interactions: DataFrame, path: str) -> None:
    """Write interactions as ``user::item::1`` lines."""
    (interactions.select(F.concat_ws(SEPARATOR, F.col("user_id").cast("string"),
                                     F.col("item_id").cast("string"),
                                     F.lit(IMPLICIT_SCORE)).alias("value"))
     .write.mode("overwrite").text(path))
