"""Composed loaders and the frames behind reports and plots."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import in_year
from . import metrics, profile, reshape, selecting
from .sizing import checked_side

TRUE = ("true", "yes", "1", "active")


def load_wide(df: DataFrame, parks: DataFrame, signals: list[str], status: str | None = None, rows: list[str] = ("park_id", "ts_local"), how: str = "mean", **conditions) -> DataFrame:
    """Load, keep active parks, and pivot: one row per ``rows``, a column per
    signal.  ``conditions`` are those of ``selecting.load``."""
    if status:
        parks = parks.filter(F.lower(F.trim(status)).isin(*TRUE))
    part = selecting.members(selecting.load(df, signals=signals, groups=("all",), **conditions), parks)
    part = part.withColumn("_signal", F.lower(F.trim("signal_name")))
    return reshape.to_wide(part, list(rows), "_signal", signals, how=how)


def incomplete_parks(parks: DataFrame) -> DataFrame:
    """Parks without coordinates (own or the station's) or capacity."""
    lat, lon = F.coalesce("latitude", "nearest_meteo_station_lat"), F.coalesce("longitude", "nearest_meteo_station_lon")
    return parks.filter(lat.isNull() | lon.isNull() | (F.coalesce("capacity_kwp", F.lit(0.0)) <= 0)).select("park_id")


def known_or_null(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """The key where the dimension has it, else null."""
    ids = checked_side(dim.select(F.col(key).alias("_known")).filter("_known is not null").distinct())
    return df.join(ids, F.col(key) == F.col("_known"), "left").withColumn(key, F.col("_known")).drop("_known")


def unique(dim: DataFrame, key: str) -> DataFrame:
    """The dimension, if its key tells one row; raises where a join would multiply rows."""
    twice = dim.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").first()
    if twice is not None:
        raise ValueError(f"{key} {twice[key]!r} has {twice['n']} rows")
    return dim


def focus(df: DataFrame, n_pairs: int, n_parks: int) -> DataFrame:
    """Statistics of the busiest parks of the most frequent signals and units;
    reports of top items, ties by name."""
    pairs = checked_side(profile.top(df, n_pairs, "signal_name", "unit").select("signal_name", "unit"))
    g = df.join(pairs, ["signal_name", "unit"]).groupBy("signal_name", "unit", "park_id")
    g = g.agg(F.count("*").alias("n_rows"), F.min("value").alias("v_min"), F.max("value").alias("v_max"), F.avg("value").alias("v_mean"))
    rank = F.row_number().over(W.partitionBy("signal_name", "unit").orderBy(F.desc("n_rows"), "park_id"))
    return g.withColumn("_rank", rank).filter(F.col("_rank") <= n_parks).drop("_rank")


def inspection(df: DataFrame, columns: list[str]) -> DataFrame:
    """``item, amount``: one pass over the fact, for a first look."""
    v = F.col("value")
    valid = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    items = {
        "rows": F.count("*"), "parks": F.countDistinct("park_id"), "signals": F.countDistinct("signal_name"), "runs": F.countDistinct("run_id"),
        "months": F.countDistinct("year", "month"), "invalid values": F.count_if(~F.coalesce(valid, F.lit(False))),
        "null cells": F.sum(reduce(Column.__add__, [F.col(c).isNull().cast("int") for c in columns])),
    }
    wide = df.agg(*[c.cast("double").alias(k) for k, c in items.items()])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(k).alias("item"), F.col(k).alias("amount")) for k in items])).alias("x")).select("x.*")


def technical_report(daily: DataFrame) -> DataFrame:
    """``park_id, section, at, kwh``: total, best and worst year, change from
    the first to the last year, and the last seven days."""
    years = metrics.yearly(daily)
    ends = metrics.best_and_worst(years, ["park_id"], "year")
    row = lambda df, section, at, kwh: df.select("park_id", F.lit(section).alias("section"), at.cast("string").alias("at"), kwh.cast("double").alias("kwh"))
    none = F.lit(None)
    last = daily.withColumn("_last", F.max("day").over(W.partitionBy("park_id"))).filter(F.col("day") > F.date_sub("_last", 7))
    return reduce(DataFrame.unionByName, [
        row(years.groupBy("park_id").agg(F.sum("kwh").alias("kwh")), "total", none, F.col("kwh")),
        row(ends, "best year", F.col("best"), F.col("best_kwh")), row(ends, "worst year", F.col("worst"), F.col("worst_kwh")),
        row(metrics.overall_change(years, ["park_id"], "year"), "change %", none, F.col("change_pct")),
        row(last.groupBy("park_id").agg(F.max("day").alias("at"), F.sum("kwh").alias("kwh")), "last 7 days", F.col("at"), F.col("kwh")),
    ])


def heatmap(daily: DataFrame) -> DataFrame:
    months = [f"m{m:02d}" for m in range(1, 13)]
    rows = daily.select("park_id", F.year("day").alias("year"), F.format_string("m%02d", F.month("day")).alias("month"), "kwh")
    return rows.groupBy("park_id", "year").pivot("month", months).agg(F.sum("kwh"))


def lines(daily: DataFrame, start: dt.date, end: dt.date, most: int, window: int = 21) -> DataFrame:
    """Days of a range with a centred average, thinned to about ``most`` points a series."""
    half = window // 2
    rows = selecting.day_range(daily, start, end, day="day")
    rows = rows.withColumn("smooth", metrics.moving_average("kwh", ["park_id"], "day", half, half, half))
    return profile.thinned(rows, ["park_id"], ["day"], most)


def dashboard(daily: DataFrame, months: DataFrame) -> DataFrame:
    """``panel, park_id, at, amount``: the energy panels of a dashboard in one long frame."""
    panel = lambda df, name, at, amount: df.select(F.lit(name).alias("panel"), "park_id", F.col(at).cast("string").alias("at"), amount.cast("double").alias("amount"))
    return reduce(DataFrame.unionByName, [
        panel(months, "monthly", "period", F.col("kwh")), panel(months, "cumulative", "period", metrics.cumulative("kwh", ["park_id"], "period")),
        panel(metrics.yearly(daily), "yearly", "year", F.col("kwh")), panel(metrics.seasonal(daily), "season", "month", F.col("kwh")),
        panel(months, "mean of 3 months", "period", metrics.moving_average("kwh", ["park_id"], "period", 2, 0, 3)),
    ])


def against_years(measured: DataFrame, reference: DataFrame, first: int, last: int) -> DataFrame:
    """Add ``pi``: energy over that of the same day in the reference years
    ``first`` to ``last``, which later (and earlier) years take in turn."""
    n = last - first + 1
    year = F.lit(first) + F.pmod(F.year("day") - first, F.lit(n))
    other = reference.filter(F.year("day").between(first, last)).select("park_id", F.col("day").alias("_day"), F.col("kwh").alias("expected"))
    rows = measured.withColumn("_day", in_year(F.col("day"), year)).join(other, ["park_id", "_day"], "left").drop("_day")
    return rows.withColumn("pi", F.try_divide("kwh", "expected"))
