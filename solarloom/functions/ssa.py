"""Iterative singular-spectrum imputation of many daily series at once."""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

#: A guard against endless work, far above what a series needs to rest.
MOST_ROUNDS = 5_000


def impute(block: np.ndarray, lengths: np.ndarray, window: int = 14, rank: int = 3, rounds: int = MOST_ROUNDS, tolerance: float = 1e-3) -> np.ndarray:
    """Fill the NaNs of the first ``lengths[r]`` days of each row.

    Each series is embedded in a Hankel trajectory matrix with its leading
    ``rank`` singular vectors.  Missing entries start on the line between their
    neighbours and are replaced by what fits the vectors best, in turns, until
    each series rests: what its own entries still have to move, judged by the
    rate of the last moves, is less than ``tolerance`` standard deviations.
    An entry may leave the range of its series' values by half that range at
    most, as a hole near the ends of a short series can otherwise grow for ever
    into a singular vector of its own.  ``rounds`` stops earlier.  Series shorter than twice the window use a
    shorter one; rows without any value stay NaN.
    """
    out = block.copy()
    s, n = block.shape
    inside = np.arange(n) < lengths[:, None]
    missing = np.isnan(block) & inside
    known = ~np.isnan(block) & inside
    count = known.sum(axis=1)
    todo = np.flatnonzero(missing.any(axis=1) & (count > 0))
    for w in np.unique(np.clip(lengths[todo] // 2, 1, window)):
        rows = todo[np.clip(lengths[todo] // 2, 1, window) == w]
        order = rows[np.lexsort((lengths[rows], missing[rows].sum(axis=1)))]
        at, size = 0, missing[order].sum(axis=1).astype(np.int64) ** 2
        while at < len(order):  # the systems of a block are padded to its largest number of holes
            ahead = size[at : at + 256]
            r = order[at : at + max(1, int((ahead * np.arange(1, len(ahead) + 1) <= 2_000_000).sum()))]
            at += len(r)
            m = int(lengths[r].max())
            out[r, :m] = _impute_block(block[r, :m], lengths[r], int(w), min(rank, int(w)), rounds, tolerance)
    return out


def _forms(v: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Bands (series x n x w) of the form that sums, over all windows of a
    series, the squared distance to the span of ``v``: days i and i + l."""
    s, w, _ = v.shape
    apart = np.eye(w) - np.matmul(v, v.transpose(0, 2, 1))
    at, last = np.arange(n), (lengths - w)[:, None]
    bands = np.zeros((s, n, w))
    for lag in range(w):
        sums = np.zeros((s, w - lag + 1))
        np.cumsum(np.diagonal(apart, lag, 1, 2), axis=1, out=sums[:, 1:])
        z = np.minimum(w - lag, at + 1)[None, :]
        a = np.clip(at - last, 0, z)  # places of day i in the windows that hold both days
        bands[:, :, lag] = np.take_along_axis(sums, np.broadcast_to(z, a.shape), 1) - np.take_along_axis(sums, a, 1)
        bands[:, :, lag] *= at + lag < lengths[:, None]
    return bands


def _replaced(y: np.ndarray, hole: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """The entries of the holes for which the form is least, the others given.
    Plain replacing by the reconstruction tends to the same entries, slowly."""
    s, n, w = bands.shape
    pull = bands[:, :, 0] * y
    for lag in range(1, w):
        pull[:, :-lag] += bands[:, :-lag, lag] * y[:, lag:]
        pull[:, lag:] += bands[:, :-lag, lag] * y[:, :-lag]
    m = int(hole.sum(axis=1).max())
    days = np.argsort(~hole, axis=1, kind="stable")[:, :m]
    real = np.take_along_axis(hole, days, 1)
    lag = days[:, None, :] - days[:, :, None]
    low = np.minimum(days[:, None, :], days[:, :, None])
    both = real[:, None, :] & real[:, :, None] & (np.abs(lag) < w)
    form = np.where(both, bands[np.arange(s)[:, None, None], low, np.minimum(np.abs(lag), w - 1)], 0.0)
    # The small diagonal keeps an undetermined entry where it is, so that every series comes to rest.
    form[:, np.arange(m), np.arange(m)] += np.where(real, 1e-6, 1.0)
    step = np.linalg.solve(form, np.where(real, -np.take_along_axis(pull, days, 1), 0.0)[:, :, None])[:, :, 0]
    out = y.copy()
    np.put_along_axis(out, days, np.take_along_axis(y, days, 1) + np.where(real, step, 0.0), 1)
    return out


def _impute_block(x: np.ndarray, lengths: np.ndarray, w: int, rank: int, rounds: int, tolerance: float) -> np.ndarray:
    n = x.shape[1]
    inside = np.arange(n) < lengths[:, None]
    known = ~np.isnan(x) & inside
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = np.where(known, x, 0).sum(axis=1) / known.sum(axis=1)
        spread = np.sqrt(np.where(known, (x - mean[:, None]) ** 2, 0).sum(axis=1) / known.sum(axis=1))
    spread = np.where(spread > 0, spread, 1.0)
    y = np.where(known, (x - mean[:, None]) / spread[:, None], 0.0)
    hole = ~known & inside
    for i in range(len(y)):
        y[i, hole[i]] = np.interp(np.flatnonzero(hole[i]), np.flatnonzero(known[i]), y[i, known[i]])
    low, high = (f(np.where(known, y, e), axis=1)[:, None] for f, e in ((np.min, np.inf), (np.max, -np.inf)))
    low, high = low - (high - low) / 2, high + (high - low) / 2
    use = (np.arange(n - w + 1) + w <= lengths[:, None])[:, :, None]
    busy, before, done = np.arange(len(y)), np.full(len(y), np.inf), 0
    while len(busy) and done < rounds:
        t = np.where(use[busy], sliding_window_view(y[busy], w, axis=1), 0.0)  # series x windows x w
        _, v = np.linalg.eigh(np.matmul(t.transpose(0, 2, 1), t))
        new = _replaced(y[busy], hole[busy], _forms(v[:, :, -rank:], lengths[busy], n))
        new = np.where(hole[busy], np.clip(new, low[busy], high[busy]), new)
        moved = np.abs(new - y[busy]).max(axis=1)
        y[busy] = new
        rate = np.clip(moved / np.maximum(before[busy], 1e-300), 0, 1)
        before[busy] = moved
        busy = busy[moved > tolerance * np.clip(1 - rate, 1e-3, 1)]
        done += 1
    return np.where(hole, y * spread[:, None] + mean[:, None], x)
