"""Named queries over the driver's tables and the SQL that checks them.

Every query reads the given tables (orders ⋈ lineitem, or events) whole.
Parameters are the reference job's: k = 10, P = 10 shards, 100 draws per
user, learning rate 0.1, L2 0.01; a fixed seed makes every draw reproducible.
The fits whose SQL runs every step in order (``fit_*``, ``trace_fit``,
``factor_snapshots``) are smaller, k = 3 and 20 draws over the events; the job's
own size is trained and scored by ``train_score_*``.
Doubles in compared outputs are rounded to 6 places and arrays are emitted
in long form (idx, dim, value).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.vectors import dot
from ..operators.factors import factor_rows, init_factors
from ..operators.gradient import attach_factors, gradient_deltas, pair_gradients, pair_margins
from ..operators.interactions import TrainingData, append, interaction_stats, prepare, shard_users, user_items
from ..operators.joins import growing
from ..operators.merge import merge_factors, sum_deltas
from ..operators.sampling import negatives_audit, sample_pairs
from ..operators.score import score_pairs
from ..operators.trace_store import merged_from_steps, read_trace_store, write_trace_store
from ..session import NUMBERS, materialise, scratch_path, ship_package
from ..sources.behaviour import (DATETIME_24H, behaviour_from_events, distinct_behaviour, malformed_behaviour,
                                 normalise_behaviour, raw_behaviour_from_events, render_behaviour)
from ..sources.factors_io import read_factors, write_factors
from ..sources.ratings import ratings_behaviour, read_ratings, write_ratings
from ..sources.tables import interactions_from_events, interactions_from_orders, item_key_of_props, load
from . import oracle as O
from .fit import ALPHA, LAMBDA, BPRConfig, fit, trace_fit

K = 10
P = 10
SEED = 7
SPU = 100
JOB_ITERATIONS = 3
FIT_ITERATIONS = 2
FIT_K = 3       # the training checks' factor length and draws per user: their SQL runs every step in order
FIT_SPU = 20
DIGITS = 6

_DATA: dict = {}


COARSE = 4      # item groups of the coarse events source, in which many users have seen every item


def _interactions(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    if source == "orders":
        return interactions_from_orders(spark, sf_dir)
    events = interactions_from_events(spark, sf_dir)
    if source == "coarse":
        # users of odd id keep to two item groups, the others soon see all of them
        group = F.pmod(F.col("item_id"), F.when(F.col("user_id") % 2 == 1, 2).otherwise(COARSE))
        return events.select("user_id", group.cast("bigint").alias("item_id"))
    return events


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item ids besides the seen ones: a negative and a far one for every event type, and the seen ones again."""
    events = load(spark, sf_dir, "events")
    unseen = events.select(F.explode(F.array(-F.length("event_type"), 1000 + F.length("event_type"))).alias("item_id"))
    return unseen.unionByName(interactions_from_events(spark, sf_dir).select("item_id"))


def training_data(spark: SparkSession, sf_dir: str, source: str = "orders",
                  num_shards: int = P) -> TrainingData:
    """Prepared tables, built once per application and input."""
    key = (spark.sparkContext.applicationId, sf_dir, source, num_shards)
    if key not in _DATA:
        catalogue = _catalogue(spark, sf_dir) if source == "catalogue" else None
        _DATA[key] = prepare(_interactions(spark, sf_dir, source), num_shards, catalogue=catalogue)
    return _DATA[key]


def release() -> None:
    """Delete the prepared tables that queries share."""
    while _DATA:
        _DATA.popitem()[1].close()


def _r(c) -> F.Column:
    return F.round(c, DIGITS)


def _init(data: TrainingData, k: int = K, seed: int = SEED):
    users = init_factors(data.users, "user_idx", k, seed, "user")
    items = init_factors(data.item_index, "item_idx", k, seed, "item")
    return users, items


def _samples(spark, sf_dir, mode="uniform_user", source="orders"):
    data = training_data(spark, sf_dir, source)
    return data, sample_pairs(data, 1, SEED, mode=mode, samples_per_user=SPU)


# ---------------------------------------------------------------- queries

def interactions_orders(spark, sf_dir):
    return interactions_from_orders(spark, sf_dir)


def interactions_events(spark, sf_dir):
    return interactions_from_events(spark, sf_dir)


def stats_orders(spark, sf_dir):
    return interaction_stats(interactions_from_orders(spark, sf_dir))


def stats_events(spark, sf_dir):
    return interaction_stats(interactions_from_events(spark, sf_dir))


def behaviour_events(spark, sf_dir):
    typed = behaviour_from_events(load(spark, sf_dir, "events"))
    return typed.withColumn("bhv_datetime", F.date_format("bhv_datetime", DATETIME_24H))


def user_index(spark, sf_dir):
    return training_data(spark, sf_dir).user_index


def item_index(spark, sf_dir):
    return training_data(spark, sf_dir).item_index


def user_items_q(spark, sf_dir):
    return user_items(training_data(spark, sf_dir))


def user_item_counts(spark, sf_dir):
    return training_data(spark, sf_dir).users.select("user_idx", "shard", "n_items", "n_rows")


def shard_users_q(spark, sf_dir):
    return shard_users(training_data(spark, sf_dir))


def eligible_users(spark, sf_dir):
    return training_data(spark, sf_dir).shard_stats.select("shard", "n_users", "n_eligible")


def init_user_factors(spark, sf_dir):
    users, _ = _init(training_data(spark, sf_dir))
    return factor_rows(users, "user_idx", DIGITS)


def init_item_factors(spark, sf_dir):
    _, items = _init(training_data(spark, sf_dir))
    return factor_rows(items, "item_idx", DIGITS)


def sample_uniform_user(spark, sf_dir):
    return _samples(spark, sf_dir)[1]


def sample_per_positive(spark, sf_dir):
    return _samples(spark, sf_dir, mode="per_positive")[1]


def sample_per_positive_events(spark, sf_dir):
    return _samples(spark, sf_dir, mode="per_positive", source="events")[1]


def sample_uniform_user_events(spark, sf_dir):
    return _samples(spark, sf_dir, source="events")[1]


def negatives_audit_q(spark, sf_dir):
    data, samples = _samples(spark, sf_dir)
    return negatives_audit(samples, data)


def _margins(spark, sf_dir):
    data, samples = _samples(spark, sf_dir)
    users, items = _init(data)
    return pair_margins(attach_factors(samples, users, items, shards=P), K)


def pair_margins_q(spark, sf_dir):
    return _margins(spark, sf_dir).select("shard", "draw_no", "user_idx", "pos_idx", "neg_idx",
                                          _r("x_uij").alias("x_uij"), _r("weight").alias("weight"))


def pair_gradients_q(spark, sf_dir):
    g = pair_gradients(_margins(spark, sf_dir), ALPHA, LAMBDA, K)
    z = F.arrays_zip(F.col("du").alias("du"), F.col("dp").alias("dp"), F.col("dn").alias("dn"))
    return (g.select("shard", "draw_no", F.posexplode(z).alias("dim", "d"))
            .select("shard", "draw_no", F.col("dim").cast("bigint").alias("dim"),
                    _r("d.du").alias("du"), _r("d.dp").alias("dp"), _r("d.dn").alias("dn")))


def attach_user_factors(spark, sf_dir):
    data = training_data(spark, sf_dir)
    users, _ = _init(data)
    joined = data.users.select("user_idx", "shard", "n_items").join(growing(users), "user_idx")
    return joined.select("user_idx", "shard", "n_items",
                         _r(F.sqrt(dot("factors", "factors"))).alias("norm"))


def merge_fixed_deltas(spark, sf_dir):
    """One synchronous delta set at the initial factors, merged the user-sharded way."""
    users, items = _init(training_data(spark, sf_dir))
    # read twice below (users, items): written once
    deltas = materialise(gradient_deltas(pair_gradients(_margins(spark, sf_dir), ALPHA, LAMBDA, K), K), "deltas", NUMBERS)
    user_sum = sum_deltas(deltas.where("kind = 'user'").withColumnRenamed("idx", "user_idx"), K,
                          idx_col="user_idx")
    item_sum = sum_deltas(deltas.where("kind = 'item'").withColumnRenamed("idx", "item_idx"), K,
                          idx_col="item_idx")
    new_users = merge_factors(users, user_sum, "user_idx", P, scale=1.0, k=K)
    new_items = merge_factors(items, item_sum, "item_idx", P, k=K)
    u = factor_rows(new_users, "user_idx", DIGITS).select(F.lit("user").alias("kind"),
                                                           F.col("user_idx").alias("idx"), "dim", "value")
    i = factor_rows(new_items, "item_idx", DIGITS).select(F.lit("item").alias("kind"),
                                                           F.col("item_idx").alias("idx"), "dim", "value")
    return u.unionByName(i)


def score_pairs_init(spark, sf_dir):
    data = training_data(spark, sf_dir)
    users, items = _init(data)
    pairs = interactions_from_orders(spark, sf_dir).distinct()
    scored = score_pairs(pairs, data.user_index, data.item_index, users, items, k=K)
    return scored.select("user_id", "item_id", _r("score").alias("score"))


def _long(df: DataFrame, *keep: str) -> DataFrame:
    """(…, kind, idx, dim, value), one row per factor value."""
    return (df.select(*keep, "kind", "idx", F.posexplode("factors").alias("dim", "value"))
            .select(*keep, "kind", "idx", F.col("dim").cast("bigint").alias("dim"), _r("value").alias("value")))


def _model_factors(model) -> DataFrame:
    users = model.user_factors.select(F.lit("user").alias("kind"), F.col("user_idx").alias("idx"), "factors")
    items = model.item_factors.select(F.lit("item").alias("kind"), F.col("item_idx").alias("idx"), "factors")
    return _long(users.unionByName(items))


def _fit_factors(spark, sf_dir, strategy, sampling="uniform_user"):
    """The factors after two iterations over all events."""
    data = training_data(spark, sf_dir, "events")
    model = fit(None, BPRConfig(k=FIT_K, iterations=FIT_ITERATIONS, num_shards=P, samples_per_user=FIT_SPU,
                                seed=SEED, strategy=strategy, sampling=sampling), data=data)
    out = materialise(_model_factors(model), "fit-factors")
    model.close()
    return out


def fit_resumed(spark, sf_dir):
    """``fit_user_sharded`` stopped after its first iteration and resumed from the run's folder alone."""
    config = BPRConfig(k=FIT_K, iterations=FIT_ITERATIONS, num_shards=P, samples_per_user=FIT_SPU, seed=SEED)
    stopped = fit(None, replace(config, iterations=1), data=training_data(spark, sf_dir, "events"))
    model = fit(None, config, resume=stopped.run_path)
    out = materialise(_model_factors(model), "fit-resumed")
    stopped.close()
    model.close()
    return out


def job_config(strategy: str) -> BPRConfig:
    """The reference job's own size: k = 10, 10 shards, 100 draws per user."""
    return BPRConfig(k=K, iterations=JOB_ITERATIONS, num_shards=P, samples_per_user=SPU, seed=SEED, strategy=strategy)


def _trained_scores(spark, sf_dir, strategy):
    """Every distinct (customer, part) pair of the orders, scored by a model trained on all of them."""
    data = training_data(spark, sf_dir)
    model = fit(None, job_config(strategy), data=data)
    out = materialise(model.score(data.seen.select("user_id", "item_id")).withColumn("score", _r("score")), "trained-scores")
    model.close()
    return out


def train_score_user_sharded(spark, sf_dir):
    return _trained_scores(spark, sf_dir, "user_sharded")


def train_score_full_average(spark, sf_dir):
    return _trained_scores(spark, sf_dir, "full_average")


def fit_user_sharded(spark, sf_dir):
    return _fit_factors(spark, sf_dir, "user_sharded")


def fit_full_average(spark, sf_dir):
    return _fit_factors(spark, sf_dir, "full_average")


def fit_per_positive(spark, sf_dir):
    return _fit_factors(spark, sf_dir, "user_sharded", sampling="per_positive")


def _trace_config() -> BPRConfig:
    return BPRConfig(k=FIT_K, iterations=1, num_shards=2, strategy="full_average", sampling="per_positive",
                     negatives=1, seed=SEED)


def _trace_model(spark, sf_dir, source="events"):
    return trace_fit(None, _trace_config(), data=training_data(spark, sf_dir, source, num_shards=2))


def trace_fit_q(spark, sf_dir):
    t = _trace_model(spark, sf_dir).trace
    return t.select("iteration", "shard", "draw_no", "step", "user_idx", "pos_idx", "neg_idx",
                    _r("x_uij").alias("x_uij"), _r("weight").alias("weight"))


def factor_snapshots(spark, sf_dir):
    return _long(_trace_model(spark, sf_dir).snapshots, "phase", "iteration")


def trace_store_last(spark, sf_dir):
    """The merged factors after the traced iteration, worked out from the stored trace's last steps."""
    model = _trace_model(spark, sf_dir)
    path = scratch_path(spark, "trace-store")
    write_trace_store(model.trace, model.snapshots, path)
    model.close()
    return _long(merged_from_steps(read_trace_store(spark, path), 1, 2, FIT_K))


def appended_items(spark, sf_dir):
    """User item sets after the events of odd id were appended to the prepared even ones."""
    events = load(spark, sf_dir, "events")
    both = [events.select((F.col("event_id") % 2).alias("odd"), F.col("user_id").cast("bigint").alias("user_id"),
                          item_key_of_props().cast("bigint").alias("item_id")).where(F.col("odd") == odd).drop("odd")
            for odd in (0, 1)]
    first = prepare(both[0], P)
    data = append(first, both[1])
    first.close()
    return data.seen.select("user_id", "user_idx", "item_id", "item_idx", "item_rank", "copies", "n_items", "shard")


def _touched(trace: DataFrame) -> DataFrame:
    """(shard, step, kind, idx, before, after): the rows of every step, their vectors
    told apart by 64-bit hashes, a third of what the values would move."""
    return trace.select("shard", "step", F.explode(F.array(*[
        F.struct(F.lit(kind).cast("tinyint").alias("kind"), F.col(idx).alias("idx"), F.xxhash64(f"{name}_before").alias("before"),
                 F.xxhash64(f"{name}_after").alias("after"))
        for kind, idx, name in ((0, "user_idx", "user"), (1, "pos_idx", "pos"), (1, "neg_idx", "neg"))
    ])).alias("r")).select("shard", "step", "r.*")


def trace_audit_orders(spark, sf_dir):
    """One row over a traced run on all orders: steps, and how many of them are wrong.

    A step is wrong if its margin or weight is not that of the vectors it
    started from, or if a vector is not what the row's previous step in the
    shard left.
    """
    model = _trace_model(spark, sf_dir, "orders")
    t = model.trace
    margin = dot("user_before", "pos_before", FIT_K) - dot("user_before", "neg_before", FIT_K)
    off = ((F.abs(F.col("x_uij") - margin) > 1e-9)
           | (F.abs(F.col("weight") - 1 / (1 + F.exp(margin))) > 1e-9))
    rows = _touched(t)
    w = Window.partitionBy("shard", "kind", "idx").orderBy("step")
    broken = rows.withColumn("_was", F.lag("after").over(w)).where("_was IS NOT NULL AND _was != before")
    return (t.agg(F.count(F.lit(1)).alias("n_steps"), F.count_if(off).alias("n_wrong_margins"))
            .crossJoin(broken.agg(F.count(F.lit(1)).alias("n_broken_chains"))))


def read_ratings_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "ratings-text")
    write_ratings(interactions_from_orders(spark, sf_dir), path)
    return read_ratings(spark, path, strict=True)


def sample_negatives_3(spark, sf_dir):
    """Three negatives for every event."""
    return sample_pairs(training_data(spark, sf_dir, "events"), 1, SEED, mode="per_positive", negatives=3)


def saturated_users(spark, sf_dir):
    """Users of the coarse source: those who have seen every item are not eligible."""
    return training_data(spark, sf_dir, "coarse").users.select(
        "user_idx", "shard", "n_items", "eligible", F.coalesce("erank", F.lit(-1)).alias("erank"))


def sample_saturated(spark, sf_dir):
    """Draws over the coarse source: none falls on a saturated user."""
    return sample_pairs(training_data(spark, sf_dir, "coarse"), 1, SEED, samples_per_user=SPU)


def catalogue_items(spark, sf_dir):
    return training_data(spark, sf_dir, "catalogue").item_index


def sample_catalogue(spark, sf_dir):
    """Draws whose negatives include catalogue items nobody has seen."""
    return sample_pairs(training_data(spark, sf_dir, "catalogue"), 1, SEED, samples_per_user=SPU)


def score_unknown_ids(spark, sf_dir):
    """Every event's pair with its ids shifted, so that some users or items are unknown (NULL score)."""
    data = training_data(spark, sf_dir, "events")
    users, items = _init(data)
    pairs = interactions_from_events(spark, sf_dir).distinct().select(
        (F.col("user_id") + 3).alias("user_id"), (F.col("item_id") - 2).alias("item_id"))
    scored = score_pairs(pairs, data.user_index, data.item_index, users, items, k=K)
    return scored.select("user_id", "item_id", _r("score").alias("score"))


def ratings_scores(spark, sf_dir):
    """Ratings text as behaviour rows with their constant score."""
    path = scratch_path(spark, "ratings-scores")
    write_ratings(interactions_from_orders(spark, sf_dir), path)
    return ratings_behaviour(spark, path).select(
        F.col("user_id").cast("bigint").alias("user_id"), F.col("item_id").cast("bigint").alias("item_id"), "bhv_amt")


def _uneven_events(spark, sf_dir) -> DataFrame:
    """Upload rows of all events with counts other than 1, missing and malformed ones."""
    e = F.col("event_id")
    count = (F.when(e % 11 == 0, "many").when(e % 13 == 0, "").when(e % 17 == 0, "null")
             .otherwise((e % 7).cast("string")))
    score = F.when(e % 19 == 0, "high").otherwise(F.round("value", 3).cast("string"))
    return load(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"), F.get_json_object("props", "$.k").alias("item_id"),
        F.col("event_type").alias("bhv_type"), score.alias("bhv_amt"), count.alias("bhv_cnt"),
        F.lit("null").alias("content"), F.lit("null").alias("bhv_datetime"))


def behaviour_counts(spark, sf_dir):
    typed = normalise_behaviour(_uneven_events(spark, sf_dir))
    return typed.groupBy("bhv_type", F.coalesce("bhv_cnt", F.lit(-1)).alias("bhv_cnt")).agg(F.count(F.lit(1)).alias("n"), F.count("bhv_amt").alias("n_scores"))


def behaviour_malformed(spark, sf_dir):
    return malformed_behaviour(_uneven_events(spark, sf_dir))


def behaviour_duplicates(spark, sf_dir):
    """Whole-row dedup of rows without their score and time, so that many are equal."""
    raw = _uneven_events(spark, sf_dir).withColumn("bhv_amt", F.lit("null"))
    return distinct_behaviour(normalise_behaviour(raw)).select(
        "user_id", "item_id", "bhv_type", F.coalesce("bhv_cnt", F.lit(-1)).alias("bhv_cnt"))


def write_factors_text(spark, sf_dir):
    """User vectors written as text and read back."""
    data = training_data(spark, sf_dir)
    users, _ = _init(data)
    path = scratch_path(spark, "user-factors-text")
    write_factors(data.user_index.join(growing(users), "user_idx").select("user_id", "factors"), path, key="user_id", fmt="text")
    return (read_factors(spark, path, fmt="text").select("user_id", F.posexplode("factors").alias("dim", "value"))
            .select("user_id", F.col("dim").cast("bigint").alias("dim"), _r("value").alias("value")))


def write_factors_order(spark, sf_dir):
    """The position of each user in the written files."""
    data = training_data(spark, sf_dir)
    users, _ = _init(data)
    path = scratch_path(spark, "user-factors-order")
    write_factors(data.user_index.join(growing(users), "user_idx").select("user_id", "factors"), path, key="user_id")
    rows = spark.read.parquet(path).select("user_id", F.col("_metadata.file_name").alias("file"),
                                           F.col("_metadata.row_index").alias("row"))
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = files.select("file", F.coalesce(F.sum("n").over(  # one row per file
        Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(before, "file").select("user_id", (F.col("before") + F.col("row")).cast("bigint").alias("position"))


def normalise_behaviour_q(spark, sf_dir):
    typed = normalise_behaviour(raw_behaviour_from_events(load(spark, sf_dir, "events")))
    return typed.withColumn("bhv_datetime", F.date_format("bhv_datetime", DATETIME_24H))


def behaviour_rows(spark, sf_dir):
    typed = normalise_behaviour(raw_behaviour_from_events(load(spark, sf_dir, "events")))
    return render_behaviour(distinct_behaviour(typed)).select("line")


def write_factors_roundtrip(spark, sf_dir):
    data = training_data(spark, sf_dir)
    users, _ = _init(data)
    path = scratch_path(spark, "user-factors")
    write_factors(data.user_index.join(growing(users), "user_idx").select("user_id", "factors"), path, key="user_id")
    back = read_factors(spark, path)
    return (back.select("user_id", F.posexplode("factors").alias("dim", "value"))
            .select("user_id", F.col("dim").cast("bigint").alias("dim"), _r("value").alias("value")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "interactions_orders": interactions_orders,
    "interactions_events": interactions_events,
    "interaction_stats": stats_orders,
    "interaction_stats_events": stats_events,
    "behaviour_events": behaviour_events,
    "user_index": user_index,
    "item_index": item_index,
    "user_items": user_items_q,
    "user_item_counts": user_item_counts,
    "shard_users": shard_users_q,
    "eligible_users": eligible_users,
    "init_user_factors": init_user_factors,
    "init_item_factors": init_item_factors,
    "sample_uniform_user": sample_uniform_user,
    "sample_per_positive": sample_per_positive,
    "sample_uniform_user_events": sample_uniform_user_events,
    "sample_per_positive_events": sample_per_positive_events,
    "negatives_audit": negatives_audit_q,
    "pair_margins": pair_margins_q,
    "pair_gradients": pair_gradients_q,
    "attach_user_factors": attach_user_factors,
    "merge_fixed_deltas": merge_fixed_deltas,
    "score_pairs_init": score_pairs_init,
    "fit_user_sharded": fit_user_sharded,
    "fit_full_average": fit_full_average,
    "fit_per_positive": fit_per_positive,
    "fit_resumed": fit_resumed,
    "train_score_user_sharded": train_score_user_sharded,
    "train_score_full_average": train_score_full_average,
    "trace_fit": trace_fit_q,
    "factor_snapshots": factor_snapshots,
    "trace_audit_orders": trace_audit_orders,
    "trace_store_last": trace_store_last,
    "appended_items": appended_items,
    "sample_negatives_3": sample_negatives_3,
    "saturated_users": saturated_users,
    "sample_saturated": sample_saturated,
    "catalogue_items": catalogue_items,
    "sample_catalogue": sample_catalogue,
    "score_unknown_ids": score_unknown_ids,
    "ratings_scores": ratings_scores,
    "behaviour_counts": behaviour_counts,
    "behaviour_malformed": behaviour_malformed,
    "behaviour_duplicates": behaviour_duplicates,
    "write_factors_text": write_factors_text,
    "write_factors_order": write_factors_order,
    "read_ratings_roundtrip": read_ratings_roundtrip,
    "normalise_behaviour": normalise_behaviour_q,
    "behaviour_rows": behaviour_rows,
    "write_factors_roundtrip": write_factors_roundtrip,
}


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _wrap(fn) for name, fn in QUERIES.items()}


# ---------------------------------------------------------------- oracle SQL

def _factor_ctes(k=K, seed=SEED) -> list[str]:
    return [O.factor_cte("uf", "users", "user_idx", k, seed, "user"),
            O.factor_cte("vf", "seen", "item_idx", k, seed, "item")]


def _margin_sql_ctes() -> list[str]:
    return [
        "m AS (SELECT s.shard, s.draw_no, s.user_idx, s.pos_idx, s.neg_idx, "
        "sum(u.v * i.v) - sum(u.v * j.v) AS x "
        "FROM samples s JOIN uf u ON u.idx = s.user_idx "
        "JOIN vf i ON i.idx = s.pos_idx AND i.dim = u.dim "
        "JOIN vf j ON j.idx = s.neg_idx AND j.dim = u.dim "
        "GROUP BY s.shard, s.draw_no, s.user_idx, s.pos_idx, s.neg_idx)",
        "g AS (SELECT m.shard, m.draw_no, m.user_idx, m.pos_idx, m.neg_idx, u.dim, "
        f"{ALPHA} * ((1.0 / (1.0 + exp(m.x))) * (i.v - j.v) - {LAMBDA} * u.v) AS du, "
        f"{ALPHA} * ((1.0 / (1.0 + exp(m.x))) * u.v - {LAMBDA} * i.v) AS dp, "
        f"{ALPHA} * (-(1.0 / (1.0 + exp(m.x))) * u.v - {LAMBDA} * j.v) AS dn "
        "FROM m JOIN uf u ON u.idx = m.user_idx "
        "JOIN vf i ON i.idx = m.pos_idx AND i.dim = u.dim "
        "JOIN vf j ON j.idx = m.neg_idx AND j.dim = u.dim)",
    ]


def oracle_sql() -> dict[str, str]:
    orders = O.interactions_orders()
    events = O.interactions_events()
    base = O.with_ctes(orders, P)
    uni = O.with_ctes(orders, P, O.uniform_user_samples_cte(SEED, 1, SPU), O.negatives_cte(SEED))
    uni_ev = O.with_ctes(events, P, O.uniform_user_samples_cte(SEED, 1, SPU), O.negatives_cte(SEED))
    pp = O.with_ctes(orders, P, O.per_positive_samples_cte(P, 1, 1, SEED), O.negatives_cte(SEED))
    pp_ev = O.with_ctes(events, P, O.per_positive_samples_cte(P, 1, 1, SEED), O.negatives_cte(SEED))
    uni_f = O.with_ctes(orders, P, O.uniform_user_samples_cte(SEED, 1, SPU), O.negatives_cte(SEED),
                        *_factor_ctes(), *_margin_sql_ctes())
    base_f = O.with_ctes(orders, P, *_factor_ctes())
    sample_cols = "SELECT iteration, shard, draw_no, user_idx, pos_idx, neg_idx FROM samples"
    raw_typed = (
        "SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS item_id, "
        "event_type AS bhv_type, "
        "CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE value END AS bhv_amt, "
        "CAST(1 AS BIGINT) AS bhv_cnt, "
        "CASE WHEN event_type = 'click' THEN props END AS content, "
        "strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS bhv_datetime FROM events")

    def q(s: str) -> str:
        return f"'{s}=''' || coalesce(CAST({{}} AS VARCHAR), 'null') || ''''"

    fields = [("userId", "user_id"), ("itemId", "item_id"), ("bhvType", "bhv_type"),
              ("bhvAmt", "bhv_amt"), ("bhvCnt", "bhv_cnt"), ("content", "content"),
              ("bhvDatetime", "bhv_datetime")]
    rendered = " || ', ' || ".join(q(a).format(b) for a, b in fields)
    def stats(src: str) -> str:
        return (f"WITH inter AS ({src}) SELECT CAST(count(*) AS BIGINT) AS n_rows, "
                "(SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT user_id, item_id FROM inter)) AS n_pairs, "
                "CAST(count(DISTINCT user_id) AS BIGINT) AS n_users, "
                "CAST(count(DISTINCT item_id) AS BIGINT) AS n_items, "
                "min(user_id) AS min_user_id, max(user_id) AS max_user_id, "
                "min(item_id) AS min_item_id, max(item_id) AS max_item_id FROM inter")

    coarse = (f"SELECT user_id, item_id % (CASE WHEN user_id % 2 = 1 THEN 2 ELSE {COARSE} END) AS item_id FROM ({events})")
    catalogue = ("SELECT CAST(-length(event_type) AS BIGINT) AS item_id FROM events "
                 "UNION ALL SELECT CAST(1000 + length(event_type) AS BIGINT) FROM events")
    uneven = (
        "SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS item_id, event_type AS bhv_type, "
        "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN 1 "
        "ELSE event_id % 7 END AS bhv_cnt, CASE WHEN event_id % 19 <> 0 THEN value END AS score FROM events")

    def fitted(strategy: str, mode: str = "uniform_user") -> str:
        return O.fit_ctes(events, P, FIT_K, SEED, FIT_SPU, FIT_ITERATIONS, strategy, mode, ALPHA, LAMBDA) \
            + O.factors_of(f"uf_{FIT_ITERATIONS}", f"vf_{FIT_ITERATIONS}")

    traced = O.fit_ctes(events, 2, FIT_K, SEED, FIT_SPU, 1, "full_average", "per_positive", ALPHA, LAMBDA, keep_steps=True)

    def phase(name: str, it: int) -> str:
        return f"'{name}' AS phase, CAST({it} AS INTEGER) AS iteration, "

    return {
        "sample_negatives_3": O.with_ctes(events, P, O.per_positive_samples_cte(P, 1, 3, SEED), O.negatives_cte(SEED))
        + sample_cols,
        "saturated_users": O.with_ctes(coarse, P) + "SELECT user_idx, shard, n_items, eligible, coalesce(erank, -1) AS erank FROM users",
        "sample_saturated": O.with_ctes(coarse, P, O.uniform_user_samples_cte(SEED, 1, SPU), O.negatives_cte(SEED))
        + sample_cols,
        "catalogue_items": O.with_ctes(events, P, catalogue=catalogue) + "SELECT item_id, item_idx FROM items",
        "sample_catalogue": O.with_ctes(events, P, O.uniform_user_samples_cte(SEED, 1, SPU), O.negatives_cte(SEED),
                                        catalogue=catalogue) + sample_cols,
        "score_unknown_ids": O.with_ctes(events, P, *_factor_ctes()) + (
            ", dp AS (SELECT DISTINCT user_id + 3 AS user_id, item_id - 2 AS item_id FROM inter) "
            "SELECT dp.user_id, dp.item_id, round(sum(u.v * i.v), 6) + 0.0 AS score FROM dp "
            "LEFT JOIN (SELECT DISTINCT user_id, user_idx FROM seen) su ON su.user_id = dp.user_id "
            "LEFT JOIN (SELECT DISTINCT item_id, item_idx FROM seen) si ON si.item_id = dp.item_id "
            "LEFT JOIN uf u ON u.idx = su.user_idx LEFT JOIN vf i ON i.idx = si.item_idx AND i.dim = u.dim "
            "GROUP BY dp.user_id, dp.item_id"),
        "ratings_scores": f"SELECT user_id, item_id, '1' AS bhv_amt FROM ({orders})",
        "behaviour_counts": (
            f"SELECT bhv_type, coalesce(bhv_cnt, -1) AS bhv_cnt, CAST(count(*) AS BIGINT) AS n, CAST(count(score) AS BIGINT) AS n_scores "
            f"FROM ({uneven}) GROUP BY 1, 2"),
        "behaviour_malformed": (
            "SELECT CAST(count(*) FILTER (WHERE event_id % 19 = 0) AS BIGINT) AS bhv_amt, "
            "CAST(count(*) FILTER (WHERE event_id % 11 = 0) AS BIGINT) AS bhv_cnt, CAST(0 AS BIGINT) AS bhv_datetime FROM events"),
        "behaviour_duplicates": f"SELECT DISTINCT user_id, item_id, bhv_type, coalesce(bhv_cnt, -1) AS bhv_cnt FROM ({uneven})",
        "write_factors_text": base_f + (
            "SELECT su.user_id, uf.dim, round(uf.v, 6) + 0.0 AS value FROM uf "
            "JOIN (SELECT DISTINCT user_id, user_idx FROM seen) su ON su.user_idx = uf.idx"),
        "write_factors_order": base + "SELECT DISTINCT user_id, user_idx - 1 AS position FROM seen",
        "fit_user_sharded": fitted("user_sharded"),
        "fit_full_average": fitted("full_average"),
        "fit_per_positive": fitted("user_sharded", "per_positive"),
        "fit_resumed": fitted("user_sharded"),
        "trace_fit": traced + (
            "SELECT CAST(1 AS INTEGER) AS iteration, r.shard, s.draw_no, r.n - 1 AS step, s.user_idx, s.b AS pos_idx, "
            "s.c AS neg_idx, round(r.x, 6) + 0.0 AS x_uij, round(r.w, 6) + 0.0 AS weight "
            "FROM run_1 r JOIN steps_1 s ON s.shard = r.shard AND s.n = r.n"),
        "factor_snapshots": traced + " UNION ALL ".join([
            O.factors_of("uf_0", "vf_0", phase("init", 0)), O.factors_of("uf_1", "vf_1", phase("mean", 1)),
            O.factors_of("uf_1", "vf_1", phase("sum", 1), " * 2")]),
        "trace_store_last": traced + O.factors_of("uf_1", "vf_1"),
        "appended_items": (
            f"WITH e AS (SELECT event_id % 2 AS odd, * FROM ({events.replace(' FROM events', ', event_id FROM events')})), "
            "p AS (SELECT user_id, item_id, min(odd) AS odd, CAST(count(*) AS BIGINT) AS copies FROM e "
            "WHERE user_id IS NOT NULL AND item_id IS NOT NULL GROUP BY user_id, item_id), "
            "u AS (SELECT user_id, row_number() OVER (ORDER BY min(odd), user_id) AS user_idx FROM p GROUP BY user_id), "
            "i AS (SELECT item_id, row_number() OVER (ORDER BY min(odd), item_id) AS item_idx FROM p GROUP BY item_id) "
            "SELECT user_id, user_idx, item_id, item_idx, row_number() OVER (PARTITION BY user_idx ORDER BY item_idx) - 1 AS item_rank, "
            f"copies, count(*) OVER (PARTITION BY user_idx) AS n_items, CAST(user_idx % {P} AS INTEGER) AS shard "
            "FROM p JOIN u USING (user_id) JOIN i USING (item_id)"),
        "trace_audit_orders": O.with_ctes(orders, 2) + (
            "SELECT CAST(sum(copies) AS BIGINT) AS n_steps, CAST(0 AS BIGINT) AS n_wrong_margins, "
            "CAST(0 AS BIGINT) AS n_broken_chains FROM seen WHERE n_items < (SELECT n FROM nitems)"),
        "interactions_orders": orders,
        "interactions_events": events,
        "interaction_stats_events": stats(events),
        "behaviour_events": (
            "SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS item_id, "
            "event_type AS bhv_type, value AS bhv_amt, CAST(1 AS BIGINT) AS bhv_cnt, "
            "CAST(NULL AS VARCHAR) AS content, strftime(ts, '%Y-%m-%d %H:%M:%S') AS bhv_datetime FROM events"),
        "interaction_stats": stats(orders),
        "user_index": base + "SELECT DISTINCT user_id, user_idx FROM seen",
        "item_index": base + "SELECT DISTINCT item_id, item_idx FROM seen",
        "user_items": base + (f"SELECT user_idx, CAST(user_idx % {P} AS INTEGER) AS shard, item_rank, "
                              "item_idx, copies FROM seen"),
        "user_item_counts": base + "SELECT user_idx, shard, n_items, n_rows FROM users",
        "shard_users": base + "SELECT shard, user_idx, urank, n_items, eligible, erank FROM users",
        "eligible_users": base + "SELECT shard, n_users, n_eligible FROM shard_stats",
        "init_user_factors": base_f + "SELECT idx AS user_idx, dim, round(v, 6) + 0.0 AS value FROM uf",
        "init_item_factors": base_f + "SELECT idx AS item_idx, dim, round(v, 6) + 0.0 AS value FROM vf",
        "sample_uniform_user": uni + sample_cols,
        "sample_per_positive": pp + sample_cols,
        "sample_uniform_user_events": uni_ev + sample_cols,
        "sample_per_positive_events": pp_ev + sample_cols,
        "negatives_audit": uni + (
            "SELECT CAST(count(*) AS BIGINT) AS n_samples, "
            "CAST(count(*) FILTER (WHERE EXISTS (SELECT 1 FROM seen x WHERE x.user_idx = samples.user_idx "
            "AND x.item_idx = samples.neg_idx)) AS BIGINT) AS n_seen_negatives FROM samples"),
        "pair_margins": uni_f + ("SELECT shard, draw_no, user_idx, pos_idx, neg_idx, round(x, 6) + 0.0 AS x_uij, "
                                 "round(1.0 / (1.0 + exp(x)), 6) + 0.0 AS weight FROM m"),
        "pair_gradients": uni_f + ("SELECT shard, draw_no, dim, round(du, 6) + 0.0 AS du, round(dp, 6) + 0.0 AS dp, "
                                   "round(dn, 6) + 0.0 AS dn FROM g"),
        "attach_user_factors": base_f + (
            "SELECT u.user_idx, u.shard, u.n_items, round(sqrt(sum(f.v * f.v)), 6) + 0.0 AS norm "
            "FROM users u JOIN uf f ON f.idx = u.user_idx GROUP BY u.user_idx, u.shard, u.n_items"),
        "merge_fixed_deltas": uni_f + (
            ", ud AS (SELECT user_idx AS idx, dim, sum(du) AS s FROM g GROUP BY 1, 2), "
            "idl AS (SELECT idx, dim, sum(d) AS s FROM (SELECT pos_idx AS idx, dim, dp AS d FROM g "
            "UNION ALL SELECT neg_idx AS idx, dim, dn AS d FROM g) GROUP BY 1, 2) "
            "SELECT 'user' AS kind, uf.idx, uf.dim, round(uf.v + coalesce(ud.s, 0.0), 6) + 0.0 AS value "
            "FROM uf LEFT JOIN ud ON ud.idx = uf.idx AND ud.dim = uf.dim "
            "UNION ALL "
            f"SELECT 'item' AS kind, vf.idx, vf.dim, round(vf.v + coalesce(idl.s, 0.0) / {P}, 6) + 0.0 AS value "
            "FROM vf LEFT JOIN idl ON idl.idx = vf.idx AND idl.dim = vf.dim"),
        "score_pairs_init": base_f + (
            ", dp AS (SELECT DISTINCT user_id, item_id FROM inter) "
            "SELECT dp.user_id, dp.item_id, round(sum(u.v * i.v), 6) + 0.0 AS score FROM dp "
            "JOIN (SELECT DISTINCT user_id, user_idx FROM seen) su ON su.user_id = dp.user_id "
            "JOIN (SELECT DISTINCT item_id, item_idx FROM seen) si ON si.item_id = dp.item_id "
            "JOIN uf u ON u.idx = su.user_idx JOIN vf i ON i.idx = si.item_idx AND i.dim = u.dim "
            "GROUP BY dp.user_id, dp.item_id"),
        "read_ratings_roundtrip": orders,
        "normalise_behaviour": raw_typed,
        "behaviour_rows": (f"SELECT DISTINCT 'User_Behavior{{' || {rendered} || '}}' AS line "
                           f"FROM ({raw_typed})"),
        "write_factors_roundtrip": base_f + (
            "SELECT su.user_id, uf.dim, round(uf.v, 6) + 0.0 AS value FROM uf "
            "JOIN (SELECT DISTINCT user_id, user_idx FROM seen) su ON su.user_idx = uf.idx"),
    }
