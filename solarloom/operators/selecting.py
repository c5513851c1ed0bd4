"""Reading part of the fact: filters that reach the scan, column groups, ranges."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import any_flag

# The fact's columns, by what they tell.
MEASUREMENT = ["ts_local", "ts_utc", "interval_start_date", "park_id", "park_capacity_kwp", "signal_name", "unit", "value"]
QUALITY = ["flag_missing_required", "flag_invalid_value", "flag_invalid_unit_range", "flag_duplicate"]
LINEAGE = ["source_file", "source_file_hash", "run_id", "ingested_at_utc", "ingest_key", "prepared_at_utc"]
GROUPS = {"measurement": MEASUREMENT, "quality": QUALITY, "lineage": LINEAGE, "all": MEASUREMENT + QUALITY + LINEAGE}


def months_between(start: dt.date | None, end: dt.date | None, year: str = "year", month: str = "month") -> Column:
    """Partition predicate for a range of days; an open side is open.  The two
    dates may come in either order."""
    if start and end and start > end:
        start, end = end, start
    at = F.col(year) * 12 + F.col(month)
    out = F.lit(True)
    if start:
        out &= (F.col(year) >= start.year) & (at >= start.year * 12 + start.month)
    if end:
        out &= (F.col(year) <= end.year) & (at <= end.year * 12 + end.month)
    return out


def day_range(df: DataFrame, start: dt.date | None = None, end: dt.date | None = None, day: str = "interval_start_date") -> DataFrame:
    """Inclusive range of days; prunes month partitions where the table has them."""
    if start and end and start > end:
        start, end = end, start
    if {"year", "month"} <= set(df.columns):
        df = df.filter(months_between(start, end))
    if start:
        df = df.filter(F.col(day) >= F.lit(start))
    return df.filter(F.col(day) <= F.lit(end)) if end else df


def columns_of(df: DataFrame, *groups: str) -> DataFrame:
    """The columns of the named groups that the table has."""
    wanted = dict.fromkeys(c for g in groups for c in GROUPS[g])
    return df.select(*[c for c in wanted if c in df.columns])


def one_of(column: str, values: list[str] | None) -> Column:
    """Membership without regard to case; None is everything, an empty list nothing."""
    if values is None:
        return F.lit(True)
    return F.lower(F.trim(column)).isin([v.strip().lower() for v in values]) if values else F.lit(False)


def like(column: str, pattern: str | None) -> Column:
    """Regular-expression search without regard to case; "" and "all" are everything."""
    return F.lit(True) if pattern in (None, "", "all") else F.lower(column).rlike(pattern.lower())


def by_flags(df: DataFrame, which: str = "valid") -> DataFrame:
    """``valid``, ``flagged`` or ``all`` rows; null flags count as false."""
    return df if which == "all" else df.filter(any_flag() if which == "flagged" else ~any_flag())


def load(df: DataFrame, start=None, end=None, parks=None, signals=None, units=None, flags="all", kwp=(None, None), groups=("measurement",)) -> DataFrame:
    """Long loader: every condition is a predicate on the scan."""
    rows = by_flags(day_range(df, start, end), flags).filter(one_of("park_id", parks) & one_of("signal_name", signals) & one_of("unit", units))
    for bound, side in zip(kwp, (Column.__ge__, Column.__le__)):
        if bound is not None:
            rows = rows.filter(side(F.col("park_capacity_kwp"), bound))
    return columns_of(rows, *groups)


def last_days(df: DataFrame, n: int, day: str = "interval_start_date") -> DataFrame:
    """Rows of the last n days of the table; the last day is one scalar."""
    top = df.agg(F.max(day).alias("_top"))
    return df.join(F.broadcast(top), F.col(day) >= F.date_sub("_top", n)).drop("_top")


def members(df: DataFrame, dim: DataFrame, key: str = "park_id") -> DataFrame:
    """Rows whose key is in the dimension; Spark picks the join by the side's size."""
    return df.join(dim.select(key).distinct(), key, "left_semi")


def in_season(day: str, start: tuple[int, int], end: tuple[int, int]) -> Column:
    """Days from (month, day) to (month, day) of any year, both in; a season may
    run over the turn of the year.  So a range meets a reference of one year."""
    at, a, z = F.month(day) * 100 + F.dayofmonth(day), start[0] * 100 + start[1], end[0] * 100 + end[1]
    return at.between(a, z) if a <= z else (at >= a) | (at <= z)


def with_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exactly these columns with these types; those that the table lacks are null."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    """Names of the columns that match, in the table's order."""
    return [c for c in df.columns if re.search(pattern, c)]
