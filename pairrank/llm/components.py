"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_path, materialise


def _toward_minimum(e: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links (a, b)."""
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("_m"))
    small = large.join(least, "a").where("b != _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return small.union(least.select("a", F.col("_m").alias("b"))).distinct()


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b) that is not its component's least.

    Rounds are logarithmic in the longest path; each is written to the shared
    folder, and only a count and a checksum reach the driver.
    """
    e = materialise(links.where("a != b").select("a", "b").distinct(), "links")
    state = _state(e)
    while state[0]:
        nxt = materialise(_toward_minimum(e), "links")
        delete_path(e.sparkSession, e._scratch_path)
        e, old, state = nxt, state, _state(nxt)
        if state == old:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
