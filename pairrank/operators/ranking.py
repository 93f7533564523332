"""Dense indexes and within-group positions without funnelling rows into one task.

``row_number()`` over an unpartitioned window sends every row to one task, and
one partitioned by a hot key sends that key's rows to one task; joining an id
→ index table back on a hot id does the same.  Here rows are range-partitioned
on (group, order) keys, so even a group holding a third of the table is split
across many tasks.  Each row is tagged with ``monotonically_increasing_id``
(partition number in the high bits, position in the partition in the low 33
bits) and the tagged rows are written once, which fixes the tags.

A summary with one row per (partition, group) then gives, per group, the rows
it has in earlier partitions and its dense index.  Those summaries hold at most
one row per group per range partition, so their windows and joins are bounded
by the number of partitions, and the join back to the rows is keyed on
(partition, group), which no group can dominate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise_small as materialise
from .joins import growing

_PART_SHIFT = 33


def _tagged(df: DataFrame, keys: list[str], n: int | None, name: str) -> DataFrame:
    # Without an explicit count the range exchange uses spark.sql.shuffle.partitions
    # and AQE may merge small neighbouring ranges; partitions stay contiguous and
    # ordered, which is all the tags rely on.
    ranged = df.repartitionByRange(n, *keys) if n else df.repartitionByRange(*keys)
    tagged = materialise(
        ranged.sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id()),
        f"tagged-{name}")
    return tagged.withColumn("_part", F.shiftright("_mid", _PART_SHIFT))


def rank_within(df: DataFrame, group_cols: list[str], order_cols: list[str],
                rank_col: str | None, index_col: str | None = None,
                count_col: str | None = None, num_parts: int | None = None, few_groups: bool = False) -> DataFrame:
    """Add ``rank_col``, the 0-based position of each row within its group in
    ``order_cols`` order (rows must then be unique on group + order columns),
    and/or ``index_col``, the 1-based dense index of the group's value among
    all groups in ascending order, and/or ``count_col``, the group's row count.

    With no group columns, ``rank_col`` is the position in the whole table.
    Group + order columns should be unique: the range partitioner can only
    split a hot group across tasks by its order columns.

    ``few_groups``: a configured number of groups, such as shards; their summary
    goes to every task, and the rows are not shuffled to it.
    """
    keys = [*group_cols, *order_cols]
    tagged = _tagged(df, keys, num_parts, rank_col or index_col or "rows")
    summary = (tagged.groupBy("_part", *group_cols)
               .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    w = w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    if count_col:
        whole = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
        summary = summary.withColumn(count_col, F.sum("_n").over(whole).cast("bigint"))
    if index_col:
        if not group_cols:
            raise ValueError("index_col needs group columns")
        summary = _with_group_index(summary, group_cols, index_col)
    if few_groups or not group_cols:
        # one row per range partition and such group: its size is bounded by n
        summary = F.broadcast(summary)
    else:
        summary = growing(summary)
    out = tagged.join(summary, ["_part", *group_cols])
    if rank_col:
        out = out.withColumn(rank_col, (F.col("_mid") - F.col("_first") + F.col("_before")).cast("bigint"))
    return out.drop("_mid", "_part", "_first", "_n", "_before")


def _with_group_index(summary: DataFrame, group_cols: list[str], index_col: str) -> DataFrame:
    """Dense 1-based index of each group value, from the (partition, group) summary.

    Range partitions hold ascending, contiguous runs of groups, so a group's
    index is its position within its partition plus the distinct groups of
    earlier partitions, counting a group that continues from the previous
    partition once.  The per-partition table has one row per partition.
    """
    group = F.struct(*group_cols)
    local = summary.withColumn(
        "_l", F.row_number().over(Window.partitionBy("_part").orderBy(*group_cols)))
    parts = (summary.groupBy("_part")
             .agg(F.count(F.lit(1)).alias("_cnt"), F.min(group).alias("_fg"), F.max(group).alias("_lg")))
    by_part = Window.partitionBy(F.lit(0)).orderBy("_part")
    parts = parts.withColumn("_dup", F.lag("_lg").over(by_part).eqNullSafe(F.col("_fg")).cast("bigint"))
    earlier = F.sum(F.col("_cnt") - F.col("_dup")).over(by_part.rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select("_part", (F.coalesce(earlier, F.lit(0)) - F.col("_dup")).alias("_off"))
    # one row per range partition: bounded by the partition count
    return (local.join(F.broadcast(offsets), "_part")
            .withColumn(index_col, (F.col("_off") + F.col("_l")).cast("bigint"))
            .drop("_l", "_off"))


def dense_index(ids: DataFrame, id_col: str, idx_col: str, num_parts: int | None = None) -> DataFrame:
    """(id, idx) with idx = 1 + rank of the id among the distinct non-NULL ids."""
    distinct = ids.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    ranked = rank_within(distinct, [], [id_col], "_r", num_parts=num_parts)
    return ranked.select(id_col, (F.col("_r") + 1).alias(idx_col))
