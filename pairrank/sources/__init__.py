"""Sources and sinks: driver tables, ratings text, behaviour rows, factor files."""

from .behaviour import (behaviour_from_events, distinct_behaviour, malformed_behaviour, normalise_behaviour,
                        raw_behaviour_from_events, render_behaviour, to_behaviour,
                        write_behaviour)
from .factors_io import read_factors, write_factors
from .ratings import ratings_behaviour, read_ratings, to_interactions, write_ratings
from .tables import interactions_from_events, interactions_from_orders, load

__all__ = [
    "behaviour_from_events", "distinct_behaviour", "malformed_behaviour", "normalise_behaviour",
    "raw_behaviour_from_events", "render_behaviour", "to_behaviour", "write_behaviour",
    "read_factors", "write_factors", "ratings_behaviour", "read_ratings", "to_interactions",
    "write_ratings", "interactions_from_events", "interactions_from_orders", "load",
]
