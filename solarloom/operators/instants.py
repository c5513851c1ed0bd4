"""Problem 5: mixed timestamp formats and time zones.

The texts are parsed by ``functions.timeparse`` (shape masks, one parser per
distinct mask, zone transition tables), in Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeparse import NONE, by_width, shape_masks, to_instants
from ..functions.zones import DEFAULT_ZONE, ZoneTables, compiled, resolve_zone
from ..sources.tables import latest_lines
from .sizing import checked_side


INSTANT = T.StructType([T.StructField("first_us", T.LongType()), T.StructField("last_us", T.LongType())])


def _instants(tables: ZoneTables):
    """The conversion, with the zone tables that travel with it."""

    @F.pandas_udf(INSTANT)
    def convert(texts: pd.Series, day: pd.Series, lag: pd.Series, zone: pd.Series) -> pd.DataFrame:
        expected = np.where(day.isna(), NONE, day.fillna(0).to_numpy(np.int64))
        return to_instants(texts, expected, lag.fillna(0).to_numpy(np.int64), zone, tables=tables)

    return convert


@F.pandas_udf(T.StringType())
def _mask(texts: pd.Series) -> pd.Series:
    out = pd.Series([None] * len(texts), dtype=object)
    for rows, data in by_width(texts):
        out.iloc[rows] = [m.decode("latin-1") for m in shape_masks(data)] if len(data) else []
    return out


@F.pandas_udf(T.StringType())
def _resolved(zone: pd.Series) -> pd.Series:
    names = {z: resolve_zone(z) for z in zone.unique()}
    return zone.map(names) if len(zone) else zone


def within_day(signal: Column) -> Column:
    """Signals stamped within the day; all others at the midnight that ends it."""
    return signal.rlike("^(active.power|module.temperature|wind.speed)")


def lag_of(signal: Column) -> Column:
    return F.when(within_day(signal), F.lit(0)).otherwise(F.lit(1))


def with_instants(df: DataFrame, park_metadata: DataFrame | None, lag: str | None = None, zones: DataFrame | None = None) -> DataFrame:
    """Add ``_zone`` and ``instant``: struct of ``first_us`` and ``last_us`` (UTC microseconds).

    They differ only for a wall time that occurs twice; both are null for a
    text that is null or no time.  ``df`` needs ``ts_local``,
    ``interval_start_date``, ``park_id`` and ``lag``, a column that is 0 for
    signals stamped within the day and else 1, or ``signal_name``.  A text without
    zone is wall time in the park's zone, of the park's last metadata line;
    ``zones`` (of ``park_zones``) saves finding these again.
    """
    zones = checked_side(park_zones(park_metadata)) if zones is None else zones
    names = [r[0] for r in zones.select("_zone").distinct().collect()]  # resolved names: at most the existing zones
    tables = compiled([*names, DEFAULT_ZONE])
    df = df.join(zones, "park_id", "left")
    zone = F.coalesce("_zone", F.lit(DEFAULT_ZONE))
    day = F.unix_date(F.col("interval_start_date"))
    lag = F.col(lag) if lag else lag_of(F.lower(F.trim("signal_name")))
    df = df.withColumn("_zone", zone)
    return df.withColumn("instant", _instants(tables)("ts_local", day, lag, "_zone").alias("instant")).withMetadata("instant", {"zone_tables": tables.version})


def park_zones(park_metadata: DataFrame) -> DataFrame:
    """park_id -> ``_zone``, the IANA zone of the park's last metadata line."""
    lines = latest_lines(park_metadata.select("park_id", "line_no", "timezone"))
    return lines.select("park_id", _resolved(F.coalesce("timezone", F.lit(""))).alias("_zone"))


def corrected_instants(silver: DataFrame, park_metadata: DataFrame) -> DataFrame:
    """``ingest_key`` and right ``utc_s`` of each row of a park whose ``ts_utc``
    is null or more than a second off.  Texts that denote no time give no row."""
    rows = silver.filter(F.col("park_id").isNotNull()).select("ingest_key", "park_id", "ts_local", "ts_utc", "interval_start_date", "signal_name")
    rows = with_instants(rows, park_metadata)
    us = F.unix_micros(F.col("ts_utc"))
    off = lambda c: F.abs(us - F.col(c)) > 1_000_000
    wrong = F.col("ts_utc").isNull() | (off("instant.first_us") & off("instant.last_us"))
    found = rows.filter(F.col("instant.first_us").isNotNull() & wrong)
    return found.select("ingest_key", F.floor(F.col("instant.first_us") / F.lit(1_000_000)).cast("long").alias("utc_s")).distinct()


def unreadable(silver: DataFrame, park_metadata: DataFrame) -> DataFrame:
    """``mask, n``: shapes of the time texts that denote no time, with their rows."""
    rows = silver.filter(F.col("park_id").isNotNull() & F.col("ts_local").isNotNull()).select("park_id", "ts_local", "interval_start_date", "signal_name")
    bad = with_instants(rows, park_metadata).filter(F.col("instant.first_us").isNull())
    return bad.groupBy(_mask("ts_local").alias("mask")).agg(F.count("*").alias("n"))


def instant_of(text: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Struct of ``first_us`` and ``last_us`` of a time text whose wall times are
    those of one zone."""
    none = F.lit(None).cast("int")
    return _instants(compiled([zone]))(text, none, F.lit(0), F.lit(zone))
