"""Training: Spark fit equals an independent dense loop; strategies; learning."""

import numpy as np
import pandas as pd
import pytest

from pairrank.operators.evaluate import holdout_split, pairwise_auc
from pairrank.operators.factors import init_factors
from pairrank.operators.interactions import prepare
from pairrank.operators.sampling import sample_pairs
from pairrank.plans.fit import BPRConfig, fit, trace_fit
from pairrank.sources.tables import interactions_from_orders
from plain import plain_steps

SF_SMALL = "/root/testdata/sf0.001"


def _dense(df, idx_col, n):
    pdf = df.toPandas()
    out = np.zeros((n + 1, len(pdf["factors"].iloc[0])))
    for idx, f in zip(pdf[idx_col], pdf["factors"]):
        out[idx] = f
    return out


def _dense_fit(data, cfg):
    """P full copies of both matrices per iteration, plain loop, then merge."""
    U = _dense(init_factors(data.users, "user_idx", cfg.k, cfg.seed, "user"), "user_idx", data.num_users)
    V = _dense(init_factors(data.item_index, "item_idx", cfg.k, cfg.seed, "item"), "item_idx", data.num_items)
    shard_of = data.users.toPandas().set_index("user_idx")["shard"]
    for it in range(1, cfg.iterations + 1):
        s = sample_pairs(data, it, cfg.seed, mode=cfg.sampling,
                         samples_per_user=cfg.samples_per_user).toPandas()
        copies = []
        for p in range(cfg.num_shards):
            Up, Vp = U.copy(), V.copy()
            sp = s[s.shard == p].sort_values("draw_no")
            plain_steps(Up, Vp, sp.user_idx.tolist(), sp.pos_idx.tolist(), sp.neg_idx.tolist(), cfg.alpha, cfg.lam)
            copies.append((Up, Vp))
        V = sum(c[1] for c in copies) / cfg.num_shards
        if cfg.strategy == "full_average":
            U = sum(c[0] for c in copies) / cfg.num_shards
        else:
            newU = U.copy()
            for uidx, p in shard_of.items():
                newU[uidx] = copies[p][0][uidx]
            U = newU
    return U, V


@pytest.fixture(scope="module")
def small_data(spark):
    return prepare(interactions_from_orders(spark, SF_SMALL), num_shards=3)


@pytest.mark.parametrize("strategy", ["user_sharded", "full_average"])
def test_fit_equals_dense_loop(spark, small_data, strategy):
    cfg = BPRConfig(k=4, iterations=2, num_shards=3, samples_per_user=10, seed=3, strategy=strategy)
    model = fit(None, cfg, data=small_data)
    U, V = _dense_fit(small_data, cfg)
    gotU = _dense(model.user_factors, "user_idx", small_data.num_users)
    gotV = _dense(model.item_factors, "item_idx", small_data.num_items)
    assert np.abs(gotU - U).max() < 1e-9
    assert np.abs(gotV - V).max() < 1e-9


def test_vectors_longer_than_a_row(spark):
    """k = 37: a vector travels in three rows."""
    rows = [(u, i) for u in range(6) for i in range(9) if (u + i) % 4]
    data = prepare(spark.createDataFrame(rows, "user_id long, item_id long"), 2)
    cfg = BPRConfig(k=37, iterations=1, num_shards=2, samples_per_user=6, seed=4)
    model = fit(None, cfg, data=data)
    U, V = _dense_fit(data, cfg)
    assert np.abs(_dense(model.user_factors, "user_idx", data.num_users) - U).max() < 1e-9
    assert np.abs(_dense(model.item_factors, "item_idx", data.num_items) - V).max() < 1e-9


def test_one_shard_makes_strategies_equal(spark):
    data = prepare(interactions_from_orders(spark, SF_SMALL), num_shards=1)
    a = fit(None, BPRConfig(k=3, iterations=1, num_shards=1, samples_per_user=5, seed=1), data=data)
    b = fit(None, BPRConfig(k=3, iterations=1, num_shards=1, samples_per_user=5, seed=1,
                            strategy="full_average"), data=data)
    ua = _dense(a.user_factors, "user_idx", data.num_users)
    ub = _dense(b.user_factors, "user_idx", data.num_users)
    assert np.abs(ua - ub).max() < 1e-12


def test_trace_matches_fit(spark):
    data = prepare(interactions_from_orders(spark, SF_SMALL), num_shards=2)
    m = trace_fit(None, data=data)
    t = m.trace.toPandas()
    n_rows = interactions_from_orders(spark, SF_SMALL).count()
    assert len(t) == n_rows  # one negative per input row, all users eligible here
    # a user's vector moves by the mean of what its last step in each shard leaves
    last = t.sort_values(["shard", "step"]).groupby(["shard", "user_idx"]).tail(1)
    init = {r.idx: np.array(r.factors) for r in m.snapshots.where("phase = 'init' AND kind = 'user'").collect()}
    final = {r.user_idx: np.array(r.factors) for r in m.user_factors.collect()}
    expect = {u: v.copy() for u, v in init.items()}
    for r in last.itertuples():
        expect[r.user_idx] += (np.array(r.user_after) - init[r.user_idx]) / 2
    assert max(np.abs(final[u] - v).max() for u, v in expect.items()) < 1e-9
    chain = t.sort_values(["shard", "step"])
    for _, g in chain.groupby(["shard", "user_idx"]):
        before, after = np.stack(g.user_before.to_list()), np.stack(g.user_after.to_list())
        assert np.array_equal(before[1:], after[:-1])
    phases = {r.phase for r in m.snapshots.select("phase").distinct().collect()}
    assert phases == {"init", "sum", "mean"}


def test_learning_beats_chance(spark):
    rng = np.random.default_rng(5)
    rows = []
    for u in range(60):
        c = u % 3
        items = rng.choice(np.arange(c * 20, c * 20 + 20), size=8, replace=False)
        rows += [(u, int(i)) for i in items]
    inter = spark.createDataFrame(pd.DataFrame(rows, columns=["user_id", "item_id"]))
    train, test = holdout_split(inter, 0.2, seed=4)
    model = fit(train, BPRConfig(k=6, iterations=15, num_shards=2, samples_per_user=30, seed=2))
    auc = pairwise_auc(model, test, seed=1).collect()[0]
    assert auc.n_pairs > 30
    assert auc.auc > 0.7


def _dense_fit_spread(data, cfg, plan):
    """Dense per-shard copies; every user merges by the deltas of the shards that hold its draws."""
    U = _dense(init_factors(data.users, "user_idx", cfg.k, cfg.seed, "user"), "user_idx", data.num_users)
    V = _dense(init_factors(data.item_index, "item_idx", cfg.k, cfg.seed, "item"), "item_idx", data.num_items)
    share = plan.draws.toPandas().groupby("user_idx")["shard"].nunique().to_dict()
    for it in range(1, cfg.iterations + 1):
        s = sample_pairs(data, it, cfg.seed, mode="per_positive", per_positive=plan).toPandas()
        copies = []
        for p in range(cfg.num_shards):
            Up, Vp = U.copy(), V.copy()
            sp = s[s.shard == p].sort_values("draw_no")
            plain_steps(Up, Vp, sp.user_idx.tolist(), sp.pos_idx.tolist(), sp.neg_idx.tolist(), cfg.alpha, cfg.lam)
            copies.append((Up, Vp))
        V = sum(c[1] for c in copies) / cfg.num_shards
        newU = U.copy()
        for uidx, n in share.items():
            n = cfg.num_shards if cfg.strategy == "full_average" else n
            newU[uidx] = U[uidx] + sum(c[0][uidx] - U[uidx] for c in copies) / n
        U = newU
    return U, V


@pytest.mark.parametrize("strategy", ["user_sharded", "full_average"])
def test_every_user_is_dealt_over_shards(spark, strategy, monkeypatch):
    from pairrank.operators import sampling
    monkeypatch.setattr(sampling, "COPY_BLOCK", 16)
    # user 0 holds most rows, one pair of it 100 of them; user 99 has every item and draws nothing
    rows = ([(0, i) for i in range(140)] + [(0, 5)] * 99 + [(u, 130 + (u * 7 + j) % 30) for u in range(1, 31) for j in range(2)]
            + [(99, i) for i in range(160)])
    inter = spark.createDataFrame(pd.DataFrame(rows, columns=["user_id", "item_id"]))
    data = prepare(inter, num_shards=4)
    cfg = BPRConfig(k=3, iterations=2, num_shards=4, seed=5, strategy=strategy, sampling="per_positive")
    plan = sampling.per_positive_plan(data, 1, cfg.seed)
    d = plan.draws.toPandas()
    assert len(d) == 239 + 60
    hot = d[d.user_idx == 1].groupby("shard").size()
    assert set(hot.index) == {0, 1, 2, 3} and hot.max() < 0.4 * hot.sum()
    for _, g in d.groupby("shard"):
        assert sorted(g.draw_no) == list(range(len(g)))
    model = fit(None, cfg, data=data)
    U, V = _dense_fit_spread(data, cfg, plan)
    gotU = _dense(model.user_factors, "user_idx", data.num_users)
    gotV = _dense(model.item_factors, "item_idx", data.num_items)
    assert model.user_factors.count() == data.num_users
    assert np.abs(gotU - U).max() < 1e-9
    assert np.abs(gotV - V).max() < 1e-9


def test_bad_configurations_raise(spark, small_data):
    for name in ("k", "iterations", "num_shards", "samples_per_user", "negatives"):
        with pytest.raises(ValueError, match=name):
            BPRConfig(**{name: 0})
    with pytest.raises(ValueError):
        BPRConfig(sampling="other")
    with pytest.raises(ValueError, match="shards"):
        fit(None, BPRConfig(k=2, iterations=1, num_shards=40), data=small_data)
    with pytest.raises(ValueError, match="samples_per_user"):
        sample_pairs(small_data, 1, 1, samples_per_user=0)
    with pytest.raises(ValueError, match="negatives"):
        sample_pairs(small_data, 1, 1, mode="per_positive", negatives=0)


def test_steps_are_streamed_in_blocks(spark, small_data, monkeypatch):
    """A shard's result does not depend on how its samples are cut into blocks."""
    import pyarrow as pa

    from pairrank.operators import kernel as K
    rng = np.random.default_rng(3)
    n = 500
    vec = rng.normal(size=(20, 2))
    rows = pa.table({
        "shard": [0] * (20 + n), "tag": [0] * 8 + [1] * 12 + [2] * n, "draw_no": [0] * 20 + list(range(n)),
        "a": list(range(8)) + list(range(12)) + rng.integers(0, 8, n).tolist(),
        "b": [None] * 20 + rng.integers(0, 6, n).tolist(), "c": [None] * 20 + rng.integers(6, 12, n).tolist(),
        **{f"v{d}": vec[:, d].tolist() + [None] * n for d in range(2)}})
    out = []
    for block in (10 ** 6, 37):
        monkeypatch.setattr(K, "STEP_BLOCK", block)
        run = K.shard_kernel(2, 0.1, 0.01, 3, average_users=False)
        out.append(pa.Table.from_batches(list(run(iter(rows.to_batches(max_chunksize=50))))).to_pylist())
    for x, y in zip(*out):
        assert (x["kind"], x["idx"]) == (y["kind"], y["idx"]) and np.allclose(x["values"], y["values"], atol=1e-12)


def test_fit_is_deterministic(spark, small_data):
    cfg = BPRConfig(k=3, iterations=1, num_shards=3, samples_per_user=5, seed=8)
    a = _dense(fit(None, cfg, data=small_data).user_factors, "user_idx", small_data.num_users)
    b = _dense(fit(None, cfg, data=small_data).user_factors, "user_idx", small_data.num_users)
    assert np.array_equal(a, b)


def test_unknown_ids_score_null(spark, small_data):
    model = fit(None, BPRConfig(k=3, iterations=1, num_shards=3, samples_per_user=2, seed=1), data=small_data)
    known_user = small_data.users.first().user_id
    known_item = small_data.item_index.first().item_id
    pairs = spark.createDataFrame([(known_user, known_item), (-99, known_item), (known_user, -5)],
                                  "user_id bigint, item_id bigint")
    got = {(r.user_id, r.item_id): r.score for r in model.score(pairs).collect()}
    assert got[(known_user, known_item)] is not None
    assert got[(-99, known_item)] is None and got[(known_user, -5)] is None


def test_old_iterations_are_deleted(spark, small_data):
    import os
    cfg = BPRConfig(k=2, iterations=3, num_shards=3, samples_per_user=2, seed=4, retain_iterations=2)
    model = fit(None, cfg, data=small_data)
    base = model.paths[0].rsplit("/", 1)[0].replace("file:", "")
    assert sorted(os.listdir(base)) == ["iter-2", "iter-3"]
    assert model.user_factors.count() == small_data.num_users
    assert model.item_factors.count() == small_data.num_items


@pytest.mark.parametrize("strategy", ["user_sharded", "full_average"])
def test_job_size_queries_equal_dense_loop(spark, strategy):
    """k = 10, 10 shards, 100 draws per user: the registered queries' scores against one step at a time."""
    from pairrank.plans import queries as Q
    got = {(r.user_id, r.item_id): r.score for r in Q.queries()[f"train_score_{strategy}"](spark, SF_SMALL).collect()}
    data = Q.training_data(spark, SF_SMALL)
    cfg = Q.job_config(strategy)
    assert (cfg.k, cfg.num_shards, cfg.samples_per_user) == (10, 10, 100)
    U, V = _dense_fit(data, cfg)
    want = {(r.user_id, r.item_id): U[r.user_idx] @ V[r.item_idx] for r in data.seen.collect()}
    assert got.keys() == want.keys() and max(abs(got[p] - want[p]) for p in want) < 2e-6


def test_appended_data_trains_like_the_dense_loop(spark):
    """Known ids keep their numbers, new ones follow; training on the extended tables is the plain loop's."""
    from pairrank.operators.interactions import append
    a = spark.createDataFrame([(u, i) for u in (5, 7, 9, 20) for i in (u, u + 1, 40)] + [(7, 40)], "user_id long, item_id long")
    b = spark.createDataFrame([(7, 40), (7, 1), (8, 41), (8, 5), (8, 5), (20, 99), (None, 3)], "user_id long, item_id long")
    first = prepare(a, 3)
    data = append(first, b)
    old, new = ({r.user_id: r.user_idx for r in d.user_index.collect()} for d in (first, data))
    assert old == {u: new[u] for u in old} and new[8] == len(old) + 1
    items = {r.item_id: r.item_idx for r in data.item_index.collect()}
    assert {r.item_id: r.item_idx for r in first.item_index.collect()}.items() <= items.items()
    assert sorted(items[i] for i in (1, 41, 99)) == [first.num_items + k for k in (1, 2, 3)] == [items[i] for i in (1, 41, 99)]
    both = {}
    for r in a.collect() + b.collect():
        if r.user_id is not None:
            both[r.user_id, r.item_id] = both.get((r.user_id, r.item_id), 0) + 1
    rows = data.seen.collect()
    assert {(r.user_id, r.item_id): r.copies for r in rows} == both and data.n_null_rows == 1
    for u in new:
        mine = sorted((r.item_idx, r.item_rank, r.n_items) for r in rows if r.user_id == u)
        assert [m[1:] for m in mine] == [(t, len(mine)) for t in range(len(mine))]
    cfg = BPRConfig(k=3, iterations=2, num_shards=3, samples_per_user=8, seed=2)
    model = fit(None, cfg, data=data)
    U, V = _dense_fit(data, cfg)
    assert np.abs(_dense(model.user_factors, "user_idx", data.num_users) - U).max() < 1e-9
    assert np.abs(_dense(model.item_factors, "item_idx", data.num_items) - V).max() < 1e-9


def test_any_vector_of_a_traced_run(spark):
    """Point lookups in the stored trace against a replay of the steps."""
    from pairrank.operators.trace_store import read_trace_store, vector_at, write_trace_store
    from pairrank.session import scratch_path
    rows = [(u, i) for u in range(1, 7) for i in range(1, 13) if (u + i) % 3]
    data = prepare(spark.createDataFrame(rows, "user_id long, item_id long"), 2)
    cfg = BPRConfig(k=3, iterations=2, num_shards=2, seed=5, strategy="full_average", sampling="per_positive")
    m = trace_fit(None, cfg, data=data)
    path = scratch_path(spark, "store")
    write_trace_store(m.trace, m.snapshots, path)
    store = read_trace_store(spark, path)
    merged = {(r.kind, r.idx, r.iteration): r.factors for r in m.snapshots.where("phase IN ('init', 'mean')").collect()}
    steps = sorted(m.trace.collect(), key=lambda r: (r.iteration, r.shard, r.step))
    now, checked = {}, 0
    for n, r in enumerate(steps):
        touched = (("user", r.user_idx, r.user_after), ("item", r.pos_idx, r.pos_after), ("item", r.neg_idx, r.neg_after))
        for kind, idx, after in touched:
            now[kind, idx, r.iteration, r.shard] = after
        if n % 23 == 0:
            for kind, idx in (("user", 1), ("item", 3)):
                want = now.get((kind, idx, r.iteration, r.shard), merged[kind, idx, r.iteration - 1])
                assert [x.factors for x in vector_at(store, kind, idx, r.iteration, r.shard, r.step).collect()] == [want]
                checked += 1
    assert checked > 4 and vector_at(store, "user", 999, 1, 0, 5).count() == 0
    plan = vector_at(store, "item", 3, 1, 0, 5)._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "EqualTo(idx,3)" in plan
