"""Measured against a typical year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def daily_from_hourly(hourly: DataFrame, zone: str, watts: str = "p_w", ts: str = "ts_utc") -> DataFrame:
    """Daily kWh per park from hourly watts, by local day; days without rows
    inside a park's period come out as 0."""
    day = F.to_date(F.from_utc_timestamp(ts, zone))
    sums = hourly.groupBy("park_id", day.alias("day")).agg(F.sum(F.col(watts) / 1000.0).alias("kwh"))
    spine = sums.groupBy("park_id").agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    return spine.join(sums, ["park_id", "day"], "left").withColumn("kwh", F.coalesce("kwh", F.lit(0.0)))


def typical_day(daily: DataFrame, value: str = "kwh", day: str = "day", drop_leap_day: bool = True) -> DataFrame:
    """Mean over the years of each calendar day."""
    rows = daily.filter(~((F.month(day) == 2) & (F.dayofmonth(day) == 29))) if drop_leap_day else daily
    return rows.groupBy("park_id", F.month(day).alias("month"), F.dayofmonth(day).alias("dom")).agg(F.avg(value).alias("expected"))


def aligned(measured: DataFrame, typical: DataFrame, day: str = "day", leap_day: str = "null", how: str = "left") -> DataFrame:
    """Join on park and calendar day.  29 February has no reference (``null``)
    or that of the day before (``ffill``)."""
    month, dom = F.month(day), F.dayofmonth(day)
    if leap_day == "ffill":
        dom = F.when((month == 2) & (dom == 29), 28).otherwise(dom)
    keyed = measured.withColumns({"month": month, "dom": dom})
    return keyed.join(typical, ["park_id", "month", "dom"], how).drop("month", "dom")


def ratio(numerator: Column, denominator: Column, least: float | None = None, keep: tuple[float, float] | None = None, clip: bool = False, scale: float = 100.0) -> Column:
    """Ratio times ``scale``; null where the reference is 0, null or below
    ``least``; outside ``keep`` null, or clipped to it."""
    ref = F.when(denominator >= least, denominator) if least is not None else denominator
    out = F.try_divide(numerator, ref) * scale
    if keep is None:
        return out
    lo, hi = map(F.lit, keep)
    return F.when(out.isNotNull(), F.greatest(lo, F.least(hi, out))) if clip else F.when(out.between(lo, hi), out)


def forward_filled(value: str, keys: list[str], order: str) -> Column:
    """Last non-null value up to the row."""
    return F.last(value, ignorenulls=True).over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0))
