"""Context-tree weighting in numpy: what a block of counted contexts says of each next bit.

A byte is eight binary decisions, each of which has a context tree of its own
for every way the byte can have begun. The tree of a decision branches by the
bits of the bytes before, nearest byte first. A node's weighted probability is
``STOP`` times its Krichevsky-Trofimov estimate plus the rest times the product
of its children's; so the posterior weight of stopping at a node is its
estimate's share of that sum, and a prediction is mixed from the deepest node up.

A context that was never seen is estimated at its longest seen suffix.
"""

from __future__ import annotations

import numpy as np

BITS = 8
# Weight of stopping at a node before anything is seen. A byte of context is
# eight levels, so a half each would favour short contexts.
STOP = 0.1
# Logarithms of gamma(n + 1/2) and gamma(n + 1) for small n; Stirling's series above.
_SMALL = 4096
_STEPS = np.arange(_SMALL - 1)
_HALF = np.append(0, np.cumsum(np.log(_STEPS + 0.5))) + 0.5 * np.log(np.pi)
_WHOLE = np.append(0, np.cumsum(np.log(_STEPS + 1.0)))


def _log_gamma(n: np.ndarray, plus: float, small: np.ndarray) -> np.ndarray:
    x = np.maximum(n, _SMALL) + plus
    large = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n < _SMALL, small[np.minimum(n, _SMALL - 1).astype(np.int64)], large)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov probability, as a logarithm, of a sequence of so many zeros and ones."""
    both = _log_gamma(zeros, 0.5, _HALF) + _log_gamma(ones, 0.5, _HALF)
    return both - _log_gamma(zeros + ones, 1.0, _WHOLE) - np.log(np.pi)


class Climb:
    """Nodes of equal depth in many trees, and the mixed prediction of rows below them as ``fixed + share * p``.

    ``key`` is sorted; dropping its last bit gives the parent. ``node`` is the
    node each row lies below.
    """

    def __init__(self, key, zeros, ones, log_weighted, node, fixed, share):
        self.key, self.zeros, self.ones, self.log_weighted = key, zeros, ones, log_weighted
        self.node, self.fixed, self.share = node, fixed, share

    @classmethod
    def from_leaves(cls, key: np.ndarray, count: np.ndarray, bit: np.ndarray) -> Climb:
        """Rows are leaves: contexts of full length with a count of each next bit."""
        key, node = np.unique(key, return_inverse=True)
        ones = np.bincount(node, count * bit, len(key))
        zeros = np.bincount(node, count * (1 - bit), len(key))
        prediction = (ones + 0.5) / (zeros + ones + 1)
        return cls(key, zeros, ones, log_estimate(zeros, ones), node, prediction[node], np.zeros(len(node)))

    def up(self, levels: int) -> Climb:
        for _ in range(levels):
            self._step()
        return self

    def _step(self) -> None:
        parent = self.key >> np.uint64(1)
        new = np.ones(len(parent), bool)
        new[1:] = parent[1:] != parent[:-1]
        begins = np.flatnonzero(new)
        seen = (self.zeros + self.ones > 0)[self.node]
        self.node = (np.cumsum(new) - 1)[self.node]
        self.key = parent[begins]
        self.zeros, self.ones = np.add.reduceat(self.zeros, begins), np.add.reduceat(self.ones, begins)
        children = np.add.reduceat(self.log_weighted, begins)
        own = log_estimate(self.zeros, self.ones)
        self.log_weighted = np.logaddexp(np.log(STOP) + own, np.log1p(-STOP) + children)
        stop = STOP * np.exp(own - self.log_weighted)
        estimate = (self.ones + 0.5) / (self.zeros + self.ones + 1)
        stop, estimate = stop[self.node], estimate[self.node]
        self.fixed = np.where(seen, stop * estimate + (1 - stop) * self.fixed, estimate)
        self.share = np.where(seen, (1 - stop) * self.share, 0)
