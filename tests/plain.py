"""An independent form of the training step, for checking: one step at a time, in vectors."""

import numpy as np


def plain_steps(U, V, users, positives, negatives, rate, decay):
    """The formula of each step applied in order, in place."""
    for a, b, c in zip(users, positives, negatives):
        user, good, bad = U[a].copy(), V[b].copy(), V[c].copy()
        pull = 0.5 * (1.0 - np.tanh(0.5 * (user @ (good - bad))))  # the logistic function of the negative margin
        U[a] += rate * (pull * (good - bad) - decay * user)
        V[b] += rate * (pull * user - decay * good)
        V[c] -= rate * (pull * user + decay * bad)
