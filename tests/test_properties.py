"""Randomised checks of ranking and unranking against plain Python."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pairrank.operators.ranking import rank_within
from pairrank.operators.sampling import unrank_unseen

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


@SETTINGS
@given(st.lists(st.tuples(st.integers(-5, 5), st.integers(0, 60)), min_size=1, max_size=300, unique=True),
       st.integers(1, 9))
def test_rank_within_matches_pandas(spark, rows, parts):
    pdf = pd.DataFrame(rows, columns=["g", "x"])
    got = rank_within(spark.createDataFrame(pdf), ["g"], ["x"], "r", index_col="gi", count_col="n",
                      num_parts=parts).toPandas()
    pdf["r"] = pdf.groupby("g")["x"].rank(method="first").astype(int) - 1
    pdf["gi"] = pdf["g"].rank(method="dense").astype(int)
    pdf["n"] = pdf.groupby("g")["x"].transform("count")
    m = got.merge(pdf, on=["g", "x"], suffixes=("", "_e"))
    assert len(m) == len(pdf) == len(got)
    for c in ("r", "gi", "n"):
        assert (m[c] == m[c + "_e"]).all()


@SETTINGS
@given(st.integers(2, 70).flatmap(lambda n: st.tuples(
    st.just(n), st.lists(st.sets(st.integers(1, n), max_size=n - 1), min_size=1, max_size=6))))
def test_unrank_matches_brute_force(spark, case):
    n, sets = case
    seen_rows, probes = [], []
    for u, items in enumerate(sets, start=1):
        for t, item in enumerate(sorted(items)):
            seen_rows.append((u, item, t))
        for r in range(n - len(items)):
            probes.append((len(probes), u, r))
    seen = spark.createDataFrame(pd.DataFrame(seen_rows or [(0, 1, 0)],
                                              columns=["user_idx", "item_idx", "item_rank"]))
    draws = spark.createDataFrame(pd.DataFrame(probes, columns=["k", "user_idx", "r"]))
    got = unrank_unseen(draws, seen, n).toPandas()
    assert len(got) == len(probes)
    for row in got.itertuples():
        unseen = [i for i in range(1, n + 1) if i not in sets[row.user_idx - 1]]
        assert unseen[row.r] == row.neg_idx
