"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_year(day: Column, year: Column | int) -> Column:
    """The same day of another year; 29 February becomes the 28th where there is none."""
    y = F.lit(year) if isinstance(year, int) else year
    month_end = F.dayofmonth(F.last_day(F.make_date(y, F.month(day), F.lit(1))))
    return F.make_date(y, F.month(day), F.least(F.dayofmonth(day), month_end))


def clamped_years(first: int, last: int, least: int = 2005, most: int = 2023) -> tuple[int, int]:
    """A range of years inside the years that a source has."""
    a, b = max(first, least), min(last, most)
    if a > b:
        raise ValueError(f"no year of {first} to {last} lies in {least} to {most}")
    return a, b


def params_key(params: Column) -> Column:
    """Short content hash of a struct of parameters, for cache names."""
    return F.substring(F.sha2(F.to_json(params), 256), 1, 12)
