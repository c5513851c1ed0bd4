"""Lock-step Kalman filters over many series at once (numpy).

A source has one level per *bin* (for instance the hour of the day), each a
random walk.  All sources of a block advance together, one reading per step, so
the Python loop runs over the longest series and not over readings.
"""

from __future__ import annotations

import warnings

import numpy as np


def start_levels(y: np.ndarray, bins: np.ndarray, mask: np.ndarray, n_bins: int, first: int = 9) -> np.ndarray:
    """Median of the first readings of every bin; of the whole series where a bin is empty."""
    s, t = y.shape
    out = np.full((s, n_bins), np.nan)
    order = np.where(mask, bins, n_bins) + np.arange(s)[:, None] * (n_bins + 1)
    flat, vals = order.ravel(), y.ravel()
    idx = np.argsort(flat, kind="stable")
    cell = flat[idx]
    rank = np.arange(len(cell)) - np.searchsorted(cell, cell)
    use = idx[(rank < first) & (cell % (n_bins + 1) < n_bins)]
    if len(use):
        cells = flat[use]
        by = np.lexsort((vals[use], cells))
        cells, v = cells[by], vals[use][by]
        starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
        n = np.diff(np.r_[starts, len(cells)])
        med = (v[starts + (n - 1) // 2] + v[starts + n // 2]) / 2
        out[cells[starts] // (n_bins + 1), cells[starts] % (n_bins + 1)] = med
    whole = np.array([np.median(r[m]) if m.any() else 0.0 for r, m in zip(y, mask)])
    return np.where(np.isnan(out), whole[:, None], out)


def innovations(y, bins, days, mask, sigma_floor, sigma_share, drift, z_low, z_high, n_bins, first=9, noise_factor=None):
    """Standardised innovations of a forward pass, and what was withheld.

    y, bins, days, mask: arrays sources x steps (``mask``: readings that may
    update the state; others are only judged where finite).  The measurement
    noise is ``max(sigma_floor, sigma_share * |level|)`` times the source's
    ``noise_factor``; a level's variance grows by ``drift**2`` a day; it starts
    at the median of the ``first`` readings.  Readings beyond the thresholds do
    not update.
    """
    s, t = y.shape
    rows = np.arange(s)
    factor = np.ones(s) if noise_factor is None else noise_factor
    x = start_levels(y, bins, mask, n_bins, first)
    p = (factor[:, None] * np.maximum(sigma_floor, sigma_share * np.abs(x))) ** 2 / 4
    seen = np.full((s, n_bins), days[:, :1] if t else 0.0)
    z = np.zeros((s, t))
    for k in range(t):
        b = bins[:, k]
        level, var = x[rows, b], p[rows, b] + drift**2 * np.maximum(0.0, days[:, k] - seen[rows, b])
        noise = (factor * np.maximum(sigma_floor, sigma_share * np.abs(level))) ** 2
        total = var + noise
        nu = y[:, k] - level
        zk = nu / np.sqrt(total)
        z[:, k] = zk
        update = mask[:, k] & (zk <= z_high) & (zk >= z_low)
        gain = np.where(update, var / total, 0.0)
        x[rows, b] = level + gain * np.where(update, nu, 0.0)
        p[rows, b] = np.where(update, (1 - gain) * var, p[rows, b])
        seen[rows, b] = np.where(update, days[:, k], seen[rows, b])
    return z


#: Standard errors that a source's own noise must be above the prior one, and the most it may be above it.
CERTAIN, MOST_FACTOR = 4.0, 4.0


def noise_factors(z: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Each source's own noise over the prior one, from its innovations.

    The median of the squared innovations over that of a unit normal is a
    robust variance, which spikes do not move; its relative standard error is
    about 2.3 / sqrt(n).  A source that is certainly noisier than its kind is
    judged by its own noise; a quieter one keeps the kind's, which is what a
    logger's resolution and the weather allow.
    """
    n = np.maximum(mask.sum(axis=1), 1)
    z2 = np.where(mask, z * z, np.nan)
    with np.errstate(all="ignore"), warnings.catch_warnings():
        warnings.simplefilter("ignore")  # rows without any reading
        own = np.nan_to_num(np.nanmedian(z2, axis=1) / 0.4549, nan=1.0)
    return np.sqrt(np.clip(own * (1 - CERTAIN * 2.3 / np.sqrt(n)), 1.0, MOST_FACTOR**2))


def both_ways(y, bins, days, mask, z_low, z_high, **kw) -> np.ndarray:
    """True where the forward and the backward forecast both reject a reading.

    The noise of each source is estimated from a first forward pass; sources
    whose own noise differs from the prior one are filtered again with it."""
    f = innovations(y, bins, days, mask, z_low=z_low, z_high=z_high, **kw)
    factor = noise_factors(f, mask)
    again = np.flatnonzero(factor > 1.0)
    if len(again):
        f[again] = innovations(y[again], bins[again], days[again], mask[again], z_low=z_low, z_high=z_high, noise_factor=factor[again], **kw)
    lengths = np.where(np.isfinite(y), np.arange(1, y.shape[1] + 1), 0).max(axis=1, initial=0)
    back = np.where(np.arange(y.shape[1]) < lengths[:, None], lengths[:, None] - 1 - np.arange(y.shape[1]), np.arange(y.shape[1]))
    take = lambda a: np.take_along_axis(a, back, axis=1)
    b = take(innovations(take(y), take(bins), -take(days), take(mask), z_low=z_low, z_high=z_high, noise_factor=factor, **kw))
    return ((f > z_high) & (b > z_high)) | ((f < z_low) & (b < z_low))


def innovation_variance(step: np.ndarray, y: np.ndarray, least: int) -> np.ndarray:
    """Variance of the ``least - 1`` innovations of the persistence forecast up
    to each reading, along a chain of readings (one row a time); infinite where
    the chain is shorter or leaves out a time."""
    out = np.full(len(y), np.inf)
    m = least - 1
    if len(y) > m:
        nu = np.diff(y)
        whole = step[m:] - step[:-m] == m
        windows = np.lib.stride_tricks.sliding_window_view(nu, m)
        out[m:] = np.where(whole, (windows * windows).mean(axis=1), np.inf)
    return out


def stuck(source: np.ndarray, t: np.ndarray, y: np.ndarray, least: int) -> np.ndarray:
    """Readings in runs of at least ``least`` distinct successive times of a
    source at which the innovation variance vanishes: exactly one value.

    The arrays hold distinct (source, time, value) triples, sorted by source
    and time; several values may share a time.  Zeros are never stuck.
    """
    n = len(y)
    if not n:
        return np.zeros(0, bool)
    y = y.astype(np.float32).astype(np.float64)  # one value may come through two conversions
    new = np.r_[True, (source[1:] != source[:-1]) | (t[1:] != t[:-1])]
    step = np.cumsum(new)
    step = step + np.cumsum(np.r_[False, source[1:] != source[:-1]])  # a gap between sources
    # Deliveries may give a time several values: readings are chained by value, a chain leaves out no time.
    order = np.lexsort((step, y, source))
    so, yo, ko = source[order], y[order], step[order]
    chain = np.cumsum(np.r_[True, (so[1:] != so[:-1]) | (yo[1:] != yo[:-1]) | (ko[1:] != ko[:-1] + 1)])
    variance = innovation_variance(ko + 2 * chain, yo, least)  # no window over two chains
    ends = np.flatnonzero((variance == 0) & (yo != 0))
    inside = np.zeros(n + 1, np.int64)
    np.add.at(inside, ends - (least - 1), 1)
    np.add.at(inside, ends + 1, -1)
    out = np.zeros(n, bool)
    out[order] = np.cumsum(inside[:-1]) > 0
    return out


def repeated(source: np.ndarray, t: np.ndarray, y: np.ndarray, flag: np.ndarray, tolerance: float = 0.001) -> np.ndarray:
    """Flags, with those of other deliveries of a flagged reading: the same
    source and time, and a value within ``tolerance`` of the larger.

    The arrays are sorted by source, time and value."""
    flag = flag.copy()
    if len(y) < 2:
        return flag
    near = (source[1:] == source[:-1]) & (t[1:] == t[:-1]) & (np.abs(y[1:] - y[:-1]) <= tolerance * np.maximum(np.abs(y[1:]), np.abs(y[:-1])))
    first = np.flatnonzero(np.r_[True, ~near])
    return np.repeat(np.logical_or.reduceat(flag, first), np.diff(np.r_[first, len(y)]))
