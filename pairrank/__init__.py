"""Pairwise ranking (BPR) from implicit feedback on Spark DataFrames.

Typical use::

    from pairrank import BPRConfig, fit, read_ratings
    model = fit(read_ratings(spark, "hdfs:///ratings"), BPRConfig(iterations=20))
    model.score(pairs)                      # (user_id, item_id, score)
"""

from .functions import dot, gaussian, hash52, pair_margin, sigmoid_weight, uniform_below
from .operators.evaluate import holdout_split, pairwise_auc
from .operators.factors import factor_rows, init_factors
from .operators.gradient import attach_factors, gradient_deltas, pair_gradients, pair_margins
from .operators.interactions import (TrainingData, append, assign_shards, eligible_users, folded_pairs, interaction_stats,
                                     prepare, ranked_pairs, shard_users, user_items)
from .operators.joins import heavy_keys, spread_join
from .operators.merge import merge_factors, sum_deltas
from .operators.ranking import dense_index, rank_within
from .operators.sampling import (negatives_audit, per_positive_plan, sample_pairs, unrank_unseen,
                                 unseen_index, unseen_items)
from .operators.score import score_pairs
from .operators.trace_store import merged_from_steps, read_trace_store, vector_at, write_trace_store
from .plans.fit import ALPHA, LAMBDA, BPRConfig, Model, fit, trace_fit
from .session import checkpoint_root, local_session, materialise
from .sources import (behaviour_from_events, distinct_behaviour, interactions_from_events, malformed_behaviour,
                      interactions_from_orders, normalise_behaviour, raw_behaviour_from_events,
                      read_factors, read_ratings, render_behaviour, to_behaviour, to_interactions,
                      write_behaviour, write_factors, write_ratings)

__all__ = [
    "dot", "gaussian", "hash52", "pair_margin", "sigmoid_weight", "uniform_below",
    "holdout_split", "pairwise_auc", "factor_rows", "init_factors",
    "attach_factors", "gradient_deltas", "pair_gradients", "pair_margins",
    "TrainingData", "append", "assign_shards", "heavy_keys", "spread_join", "eligible_users", "folded_pairs",
    "interaction_stats", "prepare", "ranked_pairs",
    "shard_users", "user_items", "merge_factors", "sum_deltas", "dense_index", "rank_within",
    "negatives_audit", "per_positive_plan", "sample_pairs", "unrank_unseen", "unseen_index", "unseen_items",
    "merged_from_steps", "read_trace_store", "vector_at", "write_trace_store",
    "score_pairs", "ALPHA", "LAMBDA", "BPRConfig", "Model", "fit", "trace_fit",
    "checkpoint_root", "local_session", "materialise",
    "behaviour_from_events", "distinct_behaviour", "malformed_behaviour", "interactions_from_events",
    "interactions_from_orders", "normalise_behaviour", "raw_behaviour_from_events", "read_factors",
    "read_ratings", "render_behaviour", "to_behaviour", "to_interactions", "write_behaviour",
    "write_factors", "write_ratings",
]
