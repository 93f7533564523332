"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Queries (orders ⋈ lineitem as (customer, part) interactions):
  prepare        dense indexes, ranked per-user item sets, shards, eligibility
  sample         one iteration of uniform-user draws with exact unseen negatives
  fit_user_sharded / fit_full_average
                 k=10, P=10, 100 draws per user, 3 iterations, from prepared tables
  score          every distinct pair scored with the trained model
  trace_fit      the explain run (k=3, P=2, one iteration, per-row negatives)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pairrank.operators.interactions import prepare  # noqa: E402
from pairrank.operators.sampling import sample_pairs  # noqa: E402
from pairrank.plans.fit import BPRConfig, fit, trace_fit  # noqa: E402
from pairrank.session import local_session, ship_package  # noqa: E402
from pairrank.sources.tables import interactions_from_orders  # noqa: E402

ITERATIONS = int(os.environ.get("BENCH_ITERATIONS", "3"))


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus))
    ship_package(spark)
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    inter = interactions_from_orders(spark, sf_dir)
    data = timed("prepare", lambda: prepare(inter, 10))
    timed("sample", lambda: _force(sample_pairs(data, 1, 7, samples_per_user=100)))
    cfg = BPRConfig(k=10, iterations=ITERATIONS, num_shards=10, samples_per_user=100, seed=7)
    model = timed("fit_user_sharded", lambda: fit(None, cfg, data=data))
    averaged = timed("fit_full_average",
                     lambda: fit(None, BPRConfig(**{**cfg.__dict__, "strategy": "full_average"}), data=data))
    timed("score", lambda: _force(model.score(inter.distinct())))
    small = prepare(inter, 2)
    timed("trace_fit", lambda: _force(trace_fit(None, data=small).trace))
    for table in (model, averaged, data, small):
        table.close()
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "bpr_headline_total", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "iterations": ITERATIONS, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
