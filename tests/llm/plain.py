"""Plain versions of what tests compare with."""

import numpy as np


def area_under_curve(scores, labels):
    """Share of (1, 0) pairs in which the 1 has the higher score; ties count half."""
    good = np.array([s for s, y in zip(scores, labels) if y == 1])
    bad = np.array([s for s, y in zip(scores, labels) if y == 0])
    gap = good[:, None] - bad[None]
    return ((gap > 0) + 0.5 * (gap == 0)).mean()


def pool_adjacent(places, values):
    """Isotonic fit by the max-min formula, at each place."""
    order = np.argsort(places, kind="stable")
    v = np.asarray(values, float)[order]
    sums = np.concatenate([[0], np.cumsum(v)])
    n = len(v)
    means = np.full((n, n), np.nan)
    for i in range(n):
        means[i, i:] = (sums[i + 1 :] - sums[i]) / np.arange(1, n - i + 1)
    fit = [np.nanmax(np.nanmin(means[: k + 1, k:], axis=1)) for k in range(n)]
    out = np.empty(n)
    out[order] = fit
    return out
