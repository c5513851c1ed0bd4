"""Calendar aggregates and curves of daily energy (``park_id, day, kwh``)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .quantiles import with_quantiles

AGGREGATES: dict[str, Callable[[str], Column]] = {
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0.0)),
    "mean": F.avg, "avg": F.avg, "average": F.avg, "min": F.min, "max": F.max, "count": F.count,
    "median": lambda c: F.percentile(c, F.lit(0.5)), "std": F.stddev_samp,
}


def month_to_date(day: str, at: dt.date) -> Column:
    """Days 1 to ``at.day`` of the month of ``at``, in any year."""
    return (F.month(day) == at.month) & (F.dayofmonth(day) <= at.day)


def annual_mtd(daily: DataFrame, at: dt.date, how: str | Callable = "sum", per_park: bool = True) -> DataFrame:
    """Month-to-date of each year; with ``per_park`` off the parks' days are
    summed first.  ``how`` may be any function of a column name."""
    f = AGGREGATES[how] if isinstance(how, str) else how
    rows = daily.filter(month_to_date("day", at))
    year = F.year("day").alias("year")
    if per_park:
        return rows.groupBy("park_id", year).agg(f("kwh").alias("kwh"))
    days = rows.groupBy("day").agg(AGGREGATES["sum"]("kwh").alias("kwh"))
    return days.groupBy(year).agg(f("kwh").alias("kwh"))


def current_mtd(daily: DataFrame, at: dt.date, how: str = "sum") -> DataFrame:
    """Month-to-date of the year of ``at`` for every park; null where it has no rows."""
    now = daily.filter((F.year("day") == at.year) & month_to_date("day", at)).groupBy("park_id").agg(AGGREGATES[how]("kwh").alias("kwh"))
    return daily.select("park_id").distinct().join(now, "park_id", "left")


def periods(daily: DataFrame, unit: str = "month", per_park: bool = True) -> DataFrame:
    """Sums by month or year, empty periods inside the span as 0."""
    keys = ["park_id"] if per_park else []
    at = F.to_date("day") if unit == "day" else F.trunc("day", unit)
    sums = daily.groupBy(*keys, at.alias("period")).agg(F.sum("kwh").alias("kwh"))
    step = F.expr(f"interval 1 {unit}")
    spine = sums.groupBy(*keys).agg(F.explode(F.sequence(F.min("period"), F.max("period"), step)).alias("period"))
    return spine.join(sums, [*keys, "period"], "left").withColumn("kwh", F.coalesce("kwh", F.lit(0.0)))


def seasonal(daily: DataFrame) -> DataFrame:
    return daily.groupBy("park_id", F.month("day").alias("month")).agg(F.sum("kwh").alias("kwh"))


def yearly(daily: DataFrame) -> DataFrame:
    return daily.groupBy("park_id", F.year("day").alias("year")).agg(F.sum("kwh").alias("kwh"))


def moving_average(value: str, keys: list[str], order: str, before: int, after: int, least: int = 1) -> Column:
    frame = W.partitionBy(*keys).orderBy(order).rowsBetween(-before, after)
    return F.when(F.count(value).over(frame) >= least, F.avg(value).over(frame))


def cumulative(value: str, keys: list[str], order: str) -> Column:
    return F.sum(value).over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0))


def growth_percent(value: str, keys: list[str], order: str) -> Column:
    last = F.lag(value).over(W.partitionBy(*keys).orderBy(order))
    return (F.try_divide(F.col(value), last) - 1) * 100


def best_and_worst(sums: DataFrame, keys: list[str], at: str, value: str = "kwh") -> DataFrame:
    """Where the value is greatest and least; ties go to the earliest."""
    early = -F.col(at).cast("long")
    return sums.groupBy(*keys).agg(F.max_by(at, F.struct(value, early)).alias("best"), F.min_by(at, F.struct(value, at)).alias("worst"), F.max(value).alias("best_kwh"), F.min(value).alias("worst_kwh"))


def overall_change(sums: DataFrame, keys: list[str], at: str, value: str = "kwh") -> DataFrame:
    """Percentage from the first to the last period."""
    first, last = F.min_by(value, at), F.max_by(value, at)
    return sums.groupBy(*keys).agg(first.alias("first_kwh"), last.alias("last_kwh"), ((F.try_divide(last, first) - 1) * 100).alias("change_pct"))


def summary(df: DataFrame, keys: list[str], value: str = "kwh") -> DataFrame:
    """Count, mean, median, sample deviation, extremes and variation (%)."""
    mean, std = F.avg(value), F.stddev_samp(value)
    out = df.groupBy(*keys).agg(F.count(value).alias("n"), mean.alias("mean"), std.alias("std"), F.min(value).alias("least"), F.max(value).alias("most"), (F.try_divide(std, mean) * 100).alias("cv_pct"))
    out = with_quantiles(out, df, keys, value, (0.5,)).withColumn("median", F.col("q")[0])
    return out.select(*keys, "n", "mean", "median", "std", "least", "most", "cv_pct")


def average_band(value: str, keys: list[str]) -> Column:
    """3, 2, 1 or 0: at least 110 %, 100 %, 90 % of the series' mean, or less."""
    share = F.try_divide(F.col(value), F.avg(value).over(W.partitionBy(*keys)))
    return F.when(share >= 1.1, 3).when(share >= 1.0, 2).when(share >= 0.9, 1).when(share.isNotNull(), 0)


def trend(daily: DataFrame, keys: list[str], value: str = "kwh", log: bool = False) -> DataFrame:
    """Least-squares line over days: slope a day, share of the mean a month and
    a year (%), and R2.  Of a logarithm (``log``) the slope is a share itself."""
    x = F.unix_date("day").cast("double")
    slope = F.regr_slope(value, x)
    g = daily.groupBy(*keys).agg(slope.alias("slope"), F.regr_r2(value, x).alias("r2"), F.avg(value).alias("mean"))
    share = (F.col("slope") if log else F.coalesce(F.try_divide(F.col("slope"), F.col("mean")), F.lit(0.0))) * 100
    return g.select(*keys, "slope", "r2", (share * 30.44).alias("monthly_pct"), (share * 365.25).alias("annual_pct"))


def monthly_median(daily: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Median of a daily value in each calendar month of a series."""
    month = F.trunc("day", "month").alias("month")
    return daily.groupBy(*keys, month).agg(F.percentile(value, F.lit(0.5)).alias("median"))  # at most 31 values


