"""Equi-joins whose left side may hold one key in a third of its rows.

A key is heavy when it has more rows than an even share of a task.  At most as
many keys as there are tasks can be, so the list of them is small whatever the
input.  The rows of a heavy key are dealt over as many parts as its share asks
for, and only its lookup row is repeated, once a part.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def growing(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input, joined by a merge.

    Sorted tables make small files: judged by their size, millions of rows
    would be sent whole through the driver to every executor.
    """
    return df.hint("merge")


# Parts of a heavy key for each even share of a task that it holds.
PARTS_A_SHARE = 2


def _tasks(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(rows: DataFrame, key: str) -> DataFrame:
    """(key, _parts) of the keys with more rows than an even share of a task.

    No more than ``spark.sql.shuffle.partitions`` rows, whose parts add up to
    at most three times that.
    """
    tasks, total = _tasks(rows), rows.count()
    top = (rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), key).limit(tasks).collect())
    parts = [(r[key], math.ceil(PARTS_A_SHARE * r["n"] * tasks / total)) for r in top if r["n"] * tasks > total]
    return rows.sparkSession.createDataFrame(parts, f"{key} {dict(rows.dtypes)[key]}, _parts int")


def spread_join(rows: DataFrame, table: DataFrame, key: str, how: str = "inner", heavy: DataFrame | None = None) -> DataFrame:
    """``rows`` joined with ``table``, whose ``key`` is unique, on ``key``.

    Rows of a heavy key are dealt to its parts by a hash of their plain columns,
    whatever the join strategy; rows without a key to as many parts as tasks.
    ``heavy``: ``heavy_keys`` of rows with the same keys, where they are known.
    """
    tasks = _tasks(rows)
    # bounded by the number of tasks
    heavy = F.broadcast(heavy if heavy is not None else heavy_keys(rows, key))
    narrow = [name for name, kind in rows.dtypes if not kind.startswith("array")]
    parts = F.when(F.col(key).isNull(), tasks).otherwise(F.coalesce("_parts", F.lit(1)))
    dealt = rows.join(heavy, key, "left").withColumn("_part", F.pmod(F.xxhash64(*narrow), parts).cast("int")).drop("_parts")
    repeated = (table.join(heavy, key, "left")
                .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts"))
    return dealt.join(growing(repeated), [key, "_part"], how).drop("_part").select(*rows.columns, *[c for c in table.columns if c != key])
