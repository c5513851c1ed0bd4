"""Seasonal-trend decomposition by LOESS, and autocorrelation, in numpy.

The decomposition follows the published algorithm (Cleveland, Cleveland,
McRae and Terpenning 1990): cycle-subseries smoothing, low-pass filtering, trend
smoothing, robustness weights.  A series is one row with arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _tricube(d: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Weights of distances ``d`` in a neighbourhood of radius ``h``."""
    r = np.abs(d) / np.maximum(h, 1e-12)
    return np.where(r <= 0.001, 1.0, np.where(r < 0.999, (1 - r**3) ** 3, 0.0))


@lru_cache(maxsize=256)
def _neighbours(n: int, span: int, ahead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions -ahead .. n-1+ahead, their nearest points and weights; series of one length share them."""
    at = np.arange(-ahead, n + ahead, dtype=float)
    q = min(span, n)
    left = np.clip(np.floor(at - (q - 1) / 2), 0, n - q).astype(int)
    idx = left[:, None] + np.arange(q)
    d = idx - at[:, None]
    return at, idx, _tricube(d, (np.abs(d).max(axis=1) + max(0, (span - n) // 2))[:, None])


def loess(y: np.ndarray, span: int, weights: np.ndarray | None = None, ahead: int = 0) -> np.ndarray:
    """Local linear fit at positions -ahead .. n-1+ahead with tricube weights.

    The last axis is time; series before it are smoothed at once.  A point whose
    neighbours have no weight keeps its value."""
    n = y.shape[-1]
    w = np.ones(n) if weights is None else weights
    at, idx, near = _neighbours(n, span, ahead)
    k = near * w[..., idx]
    total = k.sum(axis=-1)
    ok = total > 0
    k = np.where(ok[..., None], k / np.where(ok, total, 1)[..., None], 1.0 / idx.shape[1])
    mean = (k * idx).sum(axis=-1)
    off, v = k * (idx - mean[..., None]), y[..., idx]
    var = (off * (idx - mean[..., None])).sum(axis=-1)
    slope = np.where(var > 1e-9, (off * v).sum(axis=-1) / np.maximum(var, 1e-9), 0.0)
    return np.where(ok, (k * v).sum(axis=-1) + slope * (at - mean), y[..., np.clip(at, 0, n - 1).astype(int)])


@lru_cache(maxsize=8)
def _wide_kernels(size: int, span: int) -> tuple:
    """Transforms of the inner kernel times 1, d, d**2, and the weights of the
    edges; they depend on the padded size and the span, not on the series."""
    half = (span - 1) // 2
    d = np.arange(-half, half + 1.0)
    inner = _tricube(d, np.array(float(half)))
    # Correlation with the kernel is convolution with the reversed one.
    kernels = [np.fft.rfft((inner * d**p)[::-1], size) for p in range(3)]
    at = np.arange(half)[:, None]
    d = np.arange(span)[None, :] - at
    edge = _tricube(d, span - 1.0 - at)
    return kernels, [edge * d**p for p in range(3)]


def loess_wide(y: np.ndarray, span: int, weights: np.ndarray | None = None) -> np.ndarray:
    """``loess`` of one series over a wide odd span: the five moments of all inner
    neighbourhoods by fast Fourier transforms, those of the edges by two products."""
    n = len(y)
    if span >= n or span < 64 or span % 2 == 0:
        return loess(y, span, weights)
    size = 1 << (n + span).bit_length()
    kernels, edges = _wide_kernels(size, span)
    w = np.ones(n) if weights is None else weights
    shift = y.mean()
    v = w * (y - shift)
    spectra = np.fft.rfft(np.stack([w, v]), size)
    inner = [np.fft.irfft(spectra[: 2 - p // 2] * kernels[p], size)[:, span - 1 : n] for p in range(3)]
    # Both ends and both series at once, so that each table of weights is read once.
    ends = np.ascontiguousarray(np.stack([w[:span], w[::-1][:span], v[:span], v[::-1][:span]], axis=1))
    outer = [edges[p] @ ends[:, : 4 - 2 * (p // 2)] for p in range(3)]
    whole = lambda p, k: np.concatenate([outer[p][:, 2 * k], inner[p][k], outer[p][::-1, 2 * k + 1] * (-1) ** p])
    s0, s1, s2, y0, y1 = whole(0, 0), whole(1, 0), whole(2, 0), whole(0, 1), whole(1, 1)
    ok = s0 > 1e-9 * max(1.0, s0.max())
    s0 = np.where(ok, s0, 1.0)
    mean = s1 / s0
    var = s2 / s0 - mean**2
    slope = np.where(var > 1e-6, (y1 / s0 - mean * y0 / s0) / np.maximum(var, 1e-6), 0.0)
    return np.where(ok, y0 / s0 - slope * mean + shift, y)


def average(v: np.ndarray, k: int) -> np.ndarray:
    """Means of all ``k`` successive values."""
    sums = np.r_[0.0, np.cumsum(v)]
    return (sums[k:] - sums[:-k]) / k


def stl(y: np.ndarray, period: int, robust: bool = True, seasonal: int = 7, outer: int = 15) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trend, seasonal part and remainder of a series of at least two periods.

    The spans are the usual ones: the trend's the least odd number from
    1.5 period / (1 - 1.5 / seasonal), the low pass's the least odd number above
    the period; two inner rounds under robustness weights, else five."""
    n = len(y)
    odd = lambda v: int(np.ceil(v)) // 2 * 2 + 1
    span_t, span_l = odd(1.5 * period / (1 - 1.5 / seasonal)), period + 1 + period % 2
    trend, weights, season = np.zeros(n), np.ones(n), np.zeros(n)
    for _ in range(outer if robust else 1):
        before = trend + season
        for _ in range(2 if robust else 5):
            cycle = np.empty(n + 2 * period)
            for a, z, m in ((0, n % period, n // period + 1), (n % period, period, n // period)):  # subseries of equal length
                at = np.arange(a, z)[:, None] + period * np.arange(m + 2)
                cycle[at] = loess((y - trend)[at[:, :m]], seasonal, weights[at[:, :m]], ahead=1)
            low = loess_wide(average(average(average(cycle, period), period), 3), span_l)
            season = cycle[period : period + n] - low
            trend = loess_wide(y - season, span_t, weights)
        if not robust:
            break
        r = np.abs(y - trend - season)
        h = 6 * np.median(r)
        ratio = r / h if h > 0 else np.zeros(n)
        weights = np.where(ratio <= 0.001, 1.0, np.where(ratio <= 0.999, (1 - ratio**2) ** 2, 0.0))
        if np.abs(trend + season - before).max() < 1e-5 * (np.std(y) or 1):
            break
    return trend, season, y - trend - season


def acf(y: np.ndarray, lags: int) -> np.ndarray:
    d = y - y.mean()
    c0 = (d * d).sum()
    return np.array([(d[k:] * d[: len(d) - k]).sum() / c0 if c0 > 0 else float(k == 0) for k in range(lags + 1)])


def pacf(y: np.ndarray, lags: int) -> np.ndarray:
    """Levinson-Durbin recursion on the autocorrelations."""
    r = acf(y, lags)
    out, phi = [1.0], np.zeros(0)
    for k in range(1, lags + 1):
        rest = 1 - (phi * r[1:k]).sum()
        last = (r[k] - (phi * r[k - 1 : 0 : -1]).sum()) / rest if abs(rest) > 1e-12 else 0.0
        phi = np.r_[phi - last * phi[::-1], last]
        out.append(last)
    return np.array(out)


def series(daily: DataFrame, keys: list[str], value: str = "kwh", order: str = "day") -> DataFrame:
    """One row per series: ``days`` and ``values`` in time order (nulls left out).
    A series has one value a day, so its length is bounded by time, not by rows."""
    cell = F.struct(F.unix_date(order).alias("d"), F.col(value).alias("v"))
    out = daily.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    return out.select(*keys, F.col("cells.d").alias("days"), F.col("cells.v").alias("values"))


def decomposed(daily: DataFrame, keys: list[str], period: int = 365, robust: bool = True, log: bool = False, value: str = "kwh") -> DataFrame:
    """``keys, day, value, trend, seasonal, remainder`` of the series with at
    least two periods of values; shorter ones give no rows."""
    # Few bytes, much work: by a hash of their own, as else the shuffle is dropped for the grouping's, which AQE coalesces.
    tasks = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = series(daily, keys, value).filter(F.size("values") >= 2 * period).repartition(tasks, F.xxhash64(*keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                days, v = (np.array(b.column(c)[i].as_py()) for c in ("days", "values"))
                t, s, r = stl(np.log(v + 1e-6) if log else v, period, robust)
                point = pa.StructArray.from_arrays([pa.array(x) for x in (days.astype(np.int32), v, t, s, r)], ["d", "v", "t", "s", "r"])
                lists = pa.ListArray.from_arrays(np.array([0, len(v)], np.int32), point)
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, 1) for k in keys), lists], [*keys, "points"])

    kinds = ", ".join(f"{k} {t}" for k, t in rows.select(*keys).dtypes)
    out = rows.mapInArrow(run, f"{kinds}, points array<struct<d:int,v:double,t:double,s:double,r:double>>")
    out = out.select(*keys, F.explode("points").alias("p"))
    return out.select(*keys, F.date_from_unix_date("p.d").alias("day"), F.col("p.v").alias("value"), F.col("p.t").alias("trend"), F.col("p.s").alias("seasonal"), F.col("p.r").alias("remainder"))


def correlations(daily: DataFrame, keys: list[str], most_lags: int = 20, value: str = "kwh", order: str = "day") -> DataFrame:
    """``keys, lag, acf, pacf`` up to min(most_lags, n // 2) lags of each series."""
    rows = series(daily, keys, value, order).filter(F.size("values") >= 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, p = [], []
            for v in b.column("values").to_pylist():
                lags = min(most_lags, len(v) // 2)
                a.append(acf(np.array(v), lags).tolist())
                p.append(pacf(np.array(v), lags).tolist())
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.array(a, pa.list_(pa.float64())), pa.array(p, pa.list_(pa.float64()))], [*keys, "a", "p"])

    kinds = ", ".join(f"{k} {t}" for k, t in rows.select(*keys).dtypes)
    out = rows.mapInArrow(run, f"{kinds}, a array<double>, p array<double>")
    return out.select(*keys, F.posexplode(F.arrays_zip("a", "p")).alias("lag", "x")).select(*keys, "lag", F.col("x.a").alias("acf"), F.col("x.p").alias("pacf"))
