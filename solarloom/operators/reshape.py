"""Long to wide and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flat_key(*parts: str) -> Column:
    """Name of a wide column: parts joined by two underscores."""
    return F.concat_ws("__", *[F.coalesce(F.col(p).cast("string"), F.lit("none")) for p in parts])


def to_wide(df: DataFrame, rows: list[str], key: str, values: list[str], value: str = "value", how: str = "mean", order: list[str] | None = None) -> DataFrame:
    """Pivot with an explicit list of values (no extra job, a stable schema).

    ``how``: ``mean`` or ``first``; the first is by ``order`` (ties by value).
    """
    cell = F.avg(value) if how == "mean" else F.min_by(value, F.struct(*(order or []), value))
    return df.groupBy(*rows).pivot(key, values).agg(cell)


def to_long(df: DataFrame, rows: list[str], key: str = "key", value: str = "value") -> DataFrame:
    """Unpivot all other columns; null cells give no row."""
    return df.unpivot(rows, [c for c in df.columns if c not in rows], key, value).filter(F.col(value).isNotNull())
