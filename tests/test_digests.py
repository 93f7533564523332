"""Numbers over NumPy columns equal those of the column expressions."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairrank.functions.digests import number_pair, number_pairs
from pairrank.functions.hashing import hash52_pair, uniform_below
from pairrank.operators.merge import sum_deltas
from pairrank.operators.sampling import with_number


def _plain(*key) -> tuple[int, int]:
    digest = hashlib.md5("|".join(map(str, key)).encode()).hexdigest()
    return int(digest[:13], 16), int(digest[13:26], 16)


def test_numbers_equal_md5():
    rng = np.random.default_rng(0)
    cases = [(7, [3, rng.integers(0, 12, 9000), 10 ** rng.integers(0, 18, 9000) + rng.integers(0, 9, 9000)]),
             (-5, [2 ** 62, rng.integers(0, 2 ** 62, 300), rng.integers(0, 2 ** 62, 300)]),  # beyond one block
             (0, [np.array([0, 9, 10, 99, 100, 999_999_999, 10 ** 9, 2 ** 63 - 1])])]
    for seed, keys in cases:
        rows = list(zip(*(np.broadcast_to(k, len(keys[-1])).tolist() for k in keys)))
        for purposes in (["draw", "cand"], ["draw", "shard", ""]):
            for purpose, pair in zip(purposes, number_pairs(seed, purposes, *keys), strict=True):
                assert list(zip(*(c.tolist() for c in pair))) == [_plain(seed, purpose, *row) for row in rows]
    assert all(len(c) == 0 for c in number_pair(1, "draw", 3, np.zeros(0, np.int64)))
    with pytest.raises(ValueError, match="negative"):
        number_pair(1, "draw", np.array([3, -1]))


def test_numbers_equal_the_expressions(spark):
    rows = spark.range(0, 3000, 1, 3).select((F.col("id") % 7).cast("int").alias("shard"), (F.col("id") * 37).alias("draw_no"))
    got = with_number(rows, "n", 1000, 5, "cand", "shard", "draw_no").select(
        "n", uniform_below(F.lit(1000), 5, "cand", "shard", "draw_no"), "shard", "draw_no",
        *hash52_pair(5, "draw", "shard", "draw_no")).collect()
    assert len(got) == 3000 and all(r[0] == r[1] for r in got)
    first, second = number_pair(5, "draw", *(np.array([r[c] for r in got]) for c in (2, 3)))
    assert [r[4] for r in got] == first.tolist() and [r[5] for r in got] == second.tolist()


def test_deltas_are_rounded_halves_away_from_zero(spark):
    unit = 2.0 ** -40
    halves = [0.5, -0.5, 1.5, -2.5, 0.49999999999999994, -0.49999999999999994, 2.0 ** 51 + 0.5, 2.0 ** 52 + 1, -(2.0 ** 53 + 2), 7.0, 0.0]
    rows = spark.createDataFrame([(k, [h * unit]) for k, h in enumerate(halves)], "idx long, values array<double>")
    got = {r.idx: r.delta_sum[0] / unit for r in sum_deltas(rows, 1).collect()}
    assert [got[k] for k in range(len(halves))] == [1, -1, 2, -3, 0, 0, 2.0 ** 51 + 1, 2.0 ** 52 + 1, -(2.0 ** 53 + 2), 7, 0]
    plan = sum_deltas(rows, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan and "rint(" in plan.lower()
    with pytest.raises(Exception, match="(?i)overflow"):
        sum_deltas(spark.createDataFrame([(1, [2.0 ** 24])], "idx long, values array<double>"), 1).collect()
