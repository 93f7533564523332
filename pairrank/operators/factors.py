"""Factor tables: seeded Gaussian initialisation and long-form views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import gaussian


def init_factors(index: DataFrame, idx_col: str, k: int, seed: int, kind: str,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """(idx_col, *keep, factors): k standard-normal values per row, from (seed, kind, idx, dim)."""
    idx = F.col(idx_col)
    vec = F.array(*[gaussian(seed, f"init-{kind}", idx, F.lit(d)) for d in range(k)])
    return index.select(idx, *keep, vec.alias("factors"))


def factor_rows(factors: DataFrame, idx_col: str, digits: int | None = 6) -> DataFrame:
    """Long form (idx, dim, value): one row per factor value, for comparison and export."""
    exploded = factors.select(idx_col, F.posexplode("factors").alias("dim", "value"))
    value = F.round("value", digits) if digits is not None else F.col("value")
    return exploded.select(idx_col, F.col("dim").cast("bigint").alias("dim"), value.alias("value"))
