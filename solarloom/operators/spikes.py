"""Problem 4: implausible spikes, stuck stretches and impossible readings.

Every source (park and signal) is forecast by a Kalman filter over its own
readings in time order, forwards and backwards; a reading is flagged when both
forecasts reject its standardised innovation, and flagged readings do not
update the state.  Limits of physics hold besides, and stretches in which the
innovation variance vanishes (one value at five successive times) are flagged.

Sources are packed into buckets of about ``ROWS`` readings.  A source is cut
into time tiles with a halo on both sides, the shorter the more readings it
has, so that no source, however hot, is gathered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.kalman import both_ways, repeated, stuck
from .instants import lag_of, with_instants
from .readings import CommonUnits, Profile, capacity_in_name, described_rows
from .sizing import bucket_count, bucket_of, checked_side

#: Readings per bucket, readings of one source per tile, and days of tile and halo.
ROWS, TILE_ROWS, TILE_DAYS, HALO_DAYS = 40_000, 30_000, 180, 20
STUCK = 5
INF = float("inf")


@dataclass(frozen=True)
class Normal:
    """What is normal for a kind of signal, on its own scale.

    ``log``: the filter runs on the logarithm (readings of 0 are then not
    judged); ``per_kwp``: readings are divided by the park's capacity;
    ``bins``: levels per day of wall time; ``floor`` and ``share``: measurement
    noise, absolute and as a share of the level; ``drift``: of a level, a day;
    ``start``: readings whose median a level starts from;
    ``low`` and ``high``: thresholds of standardised innovations; ``least`` and
    ``most``: limits of physics.
    """

    pattern: str
    log: bool = False
    per_kwp: bool = False
    bins: int = 1
    floor: float = 1.0
    share: float = 0.0
    drift: float = 0.01
    low: float = -INF
    high: float = INF
    least: float = -INF
    most: float = INF
    stuck: bool = True
    start: int = 9


KINDS = (
    Normal("energy_import$", log=True, per_kwp=True, floor=0.26, drift=0.005, low=-15, high=3.85, least=0.0, most=24.0),
    Normal("energy$|energy_export$", log=True, floor=0.165, drift=0.015, low=-15, high=4.1, least=0.0),
    Normal("irradiance", log=True, floor=0.165, drift=0.015, low=-15, high=4.1, least=0.0, most=1500.0),
    Normal("^active_power$", per_kwp=True, bins=24, floor=0.02, share=0.75, drift=0.004, high=4.5, low=-8.0, least=-0.02, most=0.95),
    Normal("temperature", bins=12, floor=4.0, drift=0.25, low=-7.0, high=6.0, least=-40.0, most=110.0),
    Normal("wind_speed", share=0.6, floor=0.5, drift=0.01, high=5.0, least=0.0, most=75.0, start=31),
    Normal("^availability$", floor=1.0, least=0.0, most=1.0005, stuck=False),
    Normal("^fault_count$", floor=1.0, share=0.2, drift=0.02, high=6.0, least=0.0, stuck=False),
)


def kind_of(signal: Column) -> Column:
    out = F.lit(None).cast("byte")
    for k in reversed(range(len(KINDS))):
        out = F.when(signal.rlike(KINDS[k].pattern), F.lit(k).cast("byte")).otherwise(out)
    return out


def judge(kind: Normal, source, t, hour, y, kwp) -> np.ndarray:
    """Flags of distinct readings of one kind, sorted by source, time and value."""
    size = np.where(kwp > 0, kwp, np.nan) if kind.per_kwp else np.ones(len(y))
    v = y / size
    flag = (v < kind.least) | (v > kind.most)  # false where the capacity is unknown
    if kind.per_kwp:
        v = np.where(np.isnan(size), y, v)
    w = np.log(np.where(v > 0, v, 1.0)) if kind.log else v
    usable = ~flag & ((v > 0) if kind.log else np.isfinite(v))
    starts = np.flatnonzero(np.r_[True, source[1:] != source[:-1]])
    lengths = np.diff(np.r_[starts, len(source)])
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        longest = max(64, int(lengths[order[at]] * 1.5))
        end = at + int(np.searchsorted(lengths[order[at:]], longest, side="right"))
        block = order[at:end]
        at = end
        n = lengths[block].max()
        cells = starts[block][:, None] + np.minimum(np.arange(n), lengths[block][:, None] - 1)
        real = np.arange(n) < lengths[block][:, None]
        yy = np.where(real, w[cells], np.nan)
        ok = real & usable[cells]
        bins = (hour[cells] * kind.bins // 24).astype(np.int64)
        with np.errstate(invalid="ignore"):
            bad = both_ways(yy, bins, t[cells] / 86400.0, ok, kind.low, kind.high, sigma_floor=kind.floor, sigma_share=kind.share, drift=kind.drift, n_bins=kind.bins, first=kind.start)
        judged = ok & bad
        flag[cells[judged]] = True
    if kind.stuck:
        flag |= stuck(source, t, y, STUCK)
    return repeated(source, t, y, flag)


def judge_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """Keys of the flagged core readings of a bucket of tiles."""
    tile = pdf["tile"].to_numpy(np.int64)
    source, t, y = pdf["source"].to_numpy(np.int64), pdf["t"].to_numpy(np.int64), pdf["y"].to_numpy(np.float64)
    hour, kwp, kind = pdf["hour"].to_numpy(np.int64), pdf["kwp"].to_numpy(np.float64), pdf["kind"].to_numpy(np.int64)
    order = np.lexsort((y, t, tile, source, kind))
    same = lambda a: a[order][1:] == a[order][:-1]
    first = np.r_[True, ~(same(kind) & same(source) & same(tile) & same(t) & same(y))]
    one = order[first]  # distinct readings
    group = np.cumsum(np.r_[True, (source[one][1:] != source[one][:-1]) | (tile[one][1:] != tile[one][:-1]) | (kind[one][1:] != kind[one][:-1])]) if len(one) else one
    flags = np.zeros(len(one), bool)
    for k in np.unique(kind):
        w = np.flatnonzero(kind[one] == k)
        flags[w] = judge(KINDS[k], group[w], t[one[w]], hour[one[w]], y[one[w]], kwp[one[w]])
    flagged = np.zeros(len(pdf), bool)
    flagged[order] = flags[np.cumsum(first) - 1]
    return pd.DataFrame({"ingest_key": pdf["key"].to_numpy()[flagged & pdf["core"].to_numpy(bool)]})


def dense_sources(profile: Profile) -> DataFrame:
    """source -> ``_len``: tile length (s) of the sources whose busiest month
    would put more than ``TILE_ROWS`` readings into a tile of ``TILE_DAYS``.

    Taken from the profile's counts; the table is not read again."""
    groups = described_rows(profile.groups.filter("park_id is not null and _month is not null"), profile.names, profile.n_names)
    months = groups.groupBy(F.xxhash64("park_id", "signal").alias("source"), "_month").agg(F.sum("_rows").alias("_n"))
    most = months.groupBy("source").agg(F.max("_n").alias("_n"))
    length = F.lit(30 * 86400.0 * TILE_ROWS) / F.col("_n")
    return most.filter(length < TILE_DAYS * 86400).select("source", F.greatest(F.lit(3600), length).cast("long").alias("_len"))


def tiled(rows: DataFrame, dense: DataFrame) -> DataFrame:
    """Rows of ``source`` and ``t`` (seconds) with ``tile`` and ``core``; each
    row is the core of one tile and, near an edge, the halo of its neighbour.
    A tile spans ``TILE_DAYS``, for sources in ``dense`` their ``_len``."""
    rows = rows.join(dense, "source", "left")
    length = F.coalesce("_len", F.lit(TILE_DAYS * 86400))
    rows = rows.withColumn("_len", length)
    halo = F.least(F.lit(HALO_DAYS * 86400), F.floor(F.col("_len") / 4))
    at = lambda c: F.floor(c / F.col("_len"))
    t = F.col("t")
    tiles = F.array_distinct(F.array(at(t), at(t - halo), at(t + halo)))
    return rows.withColumn("tile", F.explode(tiles)).withColumn("core", F.col("tile") == at(t)).drop("_len")


def implausible_keys(silver: DataFrame, park_metadata: DataFrame) -> DataFrame:
    """``ingest_key`` of each implausible reading, repeated deliveries included.

    Rows that are no readings, signals of no kind above, and null keys give no
    row; a text that is no time counts as the end of its day.
    """
    judged = F.col("is_reading") & F.col("kind").isNotNull() & F.col("ingest_key").isNotNull()
    columns = ["ingest_key", "park_id", "interval_start_date", "ts_local", "park_capacity_kwp"]
    units = CommonUnits(silver)
    rows = units.rows(columns, keep=judged, kind=kind_of(F.col("signal")), lag=lag_of(F.col("signal")))
    dense = checked_side(dense_sources(units.profile))
    rows = with_instants(rows, park_metadata, "lag")
    us = F.coalesce("instant.first_us", (F.unix_date("interval_start_date") + 1) * F.lit(86_400_000_000))
    kwp = F.coalesce(F.when(F.col("park_capacity_kwp") > 0, F.col("park_capacity_kwp")), capacity_in_name(), F.lit(0.0))
    rows = rows.select(
        F.xxhash64("park_id", "signal").alias("source"),
        F.floor(us / F.lit(1_000_000)).cast("long").alias("t"),
        F.hour(F.from_utc_timestamp(F.timestamp_micros(us.cast("long")), F.col("_zone"))).cast("byte").alias("hour"),
        F.col("common").alias("y"),
        kwp.alias("kwp"),
        "kind",
        F.col("ingest_key").alias("key"),
    )
    n = bucket_count(units.profile.n_rows, ROWS)
    rows = tiled(rows, dense)
    # A task a bucket: as many tasks as the rows ask for, whatever the session's number of partitions.
    rows = rows.withColumn("bucket", bucket_of(n, "source", "tile")).repartition(n, "bucket")
    return rows.groupBy("bucket").applyInPandas(lambda pdf: judge_bucket(pdf), "ingest_key string").distinct()
