"""The trace of a run as a table in which one row's history is one short range.

A traced run returns one row per step with the three vectors it moved.  Here
each touched row's vector after a step is a row of its own, ordered by (kind,
idx, iteration, shard, step) over range partitions, so a Parquet reader skips
all row groups but those of the row asked for.  Vectors as merged at the end of
an iteration (iteration 0: as they began) have no shard and no step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import growing
from .merge import merge_factors, sum_deltas

ORDER = ["kind", "idx", "iteration", "shard", "step"]


def trace_rows(trace: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(kind, idx, iteration, shard, step, factors) of all touched rows and merged tables."""
    moved = trace.select("iteration", "shard", "step", F.explode(F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(idx).alias("idx"), F.col(after).alias("factors"))
        for kind, idx, after in (("user", "user_idx", "user_after"), ("item", "pos_idx", "pos_after"),
                                 ("item", "neg_idx", "neg_after"))])).alias("r")).select("iteration", "shard", "step", "r.*")
    merged = snapshots.where("phase IN ('init', 'mean')").select(
        "iteration", F.lit(None).cast("int").alias("shard"), F.lit(None).cast("bigint").alias("step"), "kind", "idx", "factors")
    return moved.unionByName(merged).select(*ORDER, "factors")


def write_trace_store(trace: DataFrame, snapshots: DataFrame, path: str) -> None:
    (trace_rows(trace, snapshots).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
     .write.mode("overwrite").parquet(path))


def read_trace_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def vector_at(store: DataFrame, kind: str, idx: int, iteration: int, shard: int, step: int) -> DataFrame:
    """(factors): the row's vector in a shard after a step; one row, none if the row is unknown.

    That is what the row's last step up to there left, else what the iteration before merged.
    """
    mine = store.where((F.col("kind") == kind) & (F.col("idx") == idx))
    inside = (F.col("iteration") == iteration) & (F.col("shard") == shard) & (F.col("step") <= step)
    before = F.col("shard").isNull() & (F.col("iteration") < iteration)
    when = F.struct("iteration", F.coalesce("step", F.lit(-1).cast("bigint")))
    return mine.where(inside | before).agg(F.max_by("factors", when).alias("factors")).where("factors IS NOT NULL")


def merged_from_steps(store: DataFrame, iteration: int, num_shards: int, k: int) -> DataFrame:
    """(kind, idx, factors): the mean over shards at the end of an iteration, worked out from
    each shard's last step on a row."""
    base = store.where(F.col("shard").isNull() & (F.col("iteration") == iteration - 1)).select("kind", "idx", "factors")
    last = (store.where((F.col("iteration") == iteration) & F.col("shard").isNotNull())
            .groupBy("kind", "idx", "shard").agg(F.max_by("factors", "step").alias("last")))
    moved = last.join(growing(base), ["kind", "idx"]).select(
        F.struct("kind", "idx").alias("row"), F.array(*[F.col("last")[d] - F.col("factors")[d] for d in range(k)]).alias("values"))
    old = base.select(F.struct("kind", "idx").alias("row"), "factors")
    return merge_factors(old, sum_deltas(moved, k, idx_col="row"), "row", num_shards, k=k).select("row.kind", "row.idx", "factors")
