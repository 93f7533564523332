"""Column expressions: seeded hashing and vector arithmetic."""

from .hashing import gaussian, hash52, hash52_pair, uniform_below
from .vectors import dot, pair_margin, sigmoid_weight, zeros

__all__ = ["gaussian", "hash52", "hash52_pair", "uniform_below", "dot", "pair_margin", "sigmoid_weight", "zeros"]
