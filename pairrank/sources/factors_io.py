"""Factor tables to and from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_factors(factors: DataFrame, path: str, key: str = "user_id", fmt: str = "parquet") -> None:
    """Write (key, factors) ordered by key: a range-partitioned, sorted write."""
    ordered = factors.orderBy(key)
    if fmt == "text":
        ordered = ordered.select(F.concat(F.lit("("), F.col(key).cast("string"), F.lit(",["),
                                          F.array_join(F.col("factors").cast("array<string>"), ","),
                                          F.lit("])")).alias("value"))
        ordered.write.mode("overwrite").text(path)
    else:
        ordered.write.mode("overwrite").format(fmt).save(path)


def read_factors(spark: SparkSession, path: str, key: str = "user_id", fmt: str = "parquet") -> DataFrame:
    """(key, factors) as ``write_factors`` wrote them; a text line that is none fails the job."""
    if fmt != "text":
        return spark.read.format(fmt).load(path)
    line = F.col("value")
    shape = r"^\((-?\d+),\[(.*)\]\)$"
    body = F.regexp_extract(line, shape, 2)
    good = F.when(line.rlike(shape), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("malformed factor line: "), line)).cast("boolean"))
    return spark.read.text(path).where(good).select(
        F.regexp_extract(line, shape, 1).cast("bigint").alias(key),
        F.when(body == "", F.array().cast("array<double>")).otherwise(F.split(body, ",").cast("array<double>"))
        .alias("factors"))
