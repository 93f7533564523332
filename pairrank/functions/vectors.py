"""Factor-vector arithmetic as JVM-side higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a: Column | str, b: Column | str, k: int | None = None) -> Column:
    """Sum of element-wise products, accumulated left to right.

    With the length ``k`` known the sum is written out element by element,
    which whole-stage codegen compiles; otherwise a higher-order fold over the
    arrays (same order, same result).  NULL if either array is NULL.
    """
    a, b = _c(a), _c(b)
    if k:
        total = F.lit(0.0)
        for d in range(k):
            total = total + a.getItem(d) * b.getItem(d)
        return F.when(a.isNotNull() & b.isNotNull(), total)
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0),
                       lambda acc, v: acc + v)


def pair_margin(user: Column | str, pos: Column | str, neg: Column | str,
                k: int | None = None) -> Column:
    """x_uij = <u, i> - <u, j>."""
    return dot(user, pos, k) - dot(user, neg, k)


def sigmoid_weight(x: Column | str) -> Column:
    """exp(-x) / (1 + exp(-x)) written as 1 / (1 + exp(x)).

    Equal in exact arithmetic; this form gives 1.0 at x = -800 and 0.0 at
    x = 800 where the other overflows to NaN.
    """
    return F.lit(1.0) / (F.lit(1.0) + F.exp(_c(x)))



def zeros(k: int) -> Column:
    return F.array_repeat(F.lit(0.0), k)
