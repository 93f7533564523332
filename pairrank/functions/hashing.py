"""Seeded, recomputable randomness as column expressions.

Every random number is a hash of (seed, purpose, keys), so a retried task, a
recomputed partition or a different shuffle layout draws exactly the same
values.  ``rand(seed)`` depends on the partition layout and would not.

Fixed values (part of the output contract, shared with the SQL oracle):
  key string   concat_ws('|', seed, purpose, key1, key2, ...)
  digest       md5 of the key string, lower-case hex
  52-bit draw  the first 13 hex digits read as an unsigned integer
  2nd draw     hex digits 14 to 26 (the Gaussian's and a draw's second number)
  2**52        4503599627370496
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = 4503599627370496


def _key(seed: int, purpose: str, *keys: Column | str) -> Column:
    parts = [F.lit(str(seed)), F.lit(purpose)]
    parts += [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return F.concat_ws("|", *parts)


def _hex52(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 13), 16, 10).cast("bigint")


def hash52(seed: int, purpose: str, *keys: Column | str) -> Column:
    """Uniform integer in [0, 2**52) derived from the keys."""
    return _hex52(F.md5(_key(seed, purpose, *keys)), 1)


def hash52_pair(seed: int, purpose: str, *keys: Column | str) -> tuple[Column, Column]:
    """Two independent uniform integers in [0, 2**52) from one digest."""
    digest = F.md5(_key(seed, purpose, *keys))
    return _hex52(digest, 1), _hex52(digest, 14)


def uniform_below(n: Column | str, seed: int, purpose: str, *keys: Column | str) -> Column:
    """Uniform integer in [0, n) (n > 0); the modulo bias is below n / 2**52."""
    n = F.col(n) if isinstance(n, str) else n
    return F.pmod(hash52(seed, purpose, *keys), n)


def gaussian(seed: int, purpose: str, *keys: Column | str) -> Column:
    """Standard normal value by Box-Muller on two 52-bit draws of one digest."""
    digest = F.md5(_key(seed, purpose, *keys))
    a = _hex52(digest, 1)
    b = _hex52(digest, 14)
    radius = F.sqrt(F.lit(-2.0) * F.log((a + F.lit(1)) / F.lit(TWO_POW_52 + 1)))
    return radius * F.cos(F.lit(2.0 * math.pi) * b / F.lit(TWO_POW_52))
