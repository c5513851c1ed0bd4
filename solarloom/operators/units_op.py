"""Problem 3: quantities recorded in different units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .readings import in_common_units


def converted(silver: DataFrame) -> DataFrame:
    """Every row under its plain signal name with ``common``, the value in the
    common unit (null for rows that are no readings)."""
    return in_common_units(silver, ["ingest_key", "park_id", "interval_start_date", "value"])


def rescaled_keys(silver: DataFrame) -> DataFrame:
    """``ingest_key`` of each reading whose recorded value is another number
    than the quantity in the common unit.  Copies give one row; null keys none."""
    rows = converted(silver).filter(F.col("is_reading") & (F.col("common") != F.col("value")) & F.col("ingest_key").isNotNull())
    return rows.select("ingest_key").distinct()
