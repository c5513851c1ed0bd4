"""Problem 2: irregular readings onto a regular grid of days.

Readings are bucketed by source and day (mean in the common unit); missing days
between a source's first and last day are filled by singular-spectrum
imputation and marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ssa import impute
from .readings import in_common_units
from .tiles import day_number, packed

TILE_DAYS, HALO_DAYS = 512, 64


def gridded(cells: DataFrame, keys: list[str], only_filled: bool = False, tile_days: int = TILE_DAYS, halo: int = HALO_DAYS) -> DataFrame:
    """``keys, day, value, filled`` of every day of each source's period.

    ``filled`` marks days without a cell.  A tile whose halo holds no cell at
    all (an outage longer than tile and halo) has null values, marked too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tile, first, last = (b.column(c).to_numpy().astype(np.int64) for c in ("tile", "first", "last"))
            a = np.maximum(first, tile * tile_days - halo)
            z = np.minimum(last, (tile + 1) * tile_days - 1 + halo)
            length = z - a + 1
            days, values = b.column("days"), b.column("values")
            n = np.diff(days.offsets.to_numpy())
            rows, at = np.repeat(np.arange(len(n)), n), days.flatten().to_numpy(zero_copy_only=False) - np.repeat(a, n)
            block = np.full((len(n), int(length.max()) if len(n) else 0), np.nan)
            ok = (at >= 0) & (at < block.shape[1])
            block[rows[ok], at[ok]] = values.flatten().to_numpy(zero_copy_only=False)[ok]
            full = impute(block, length)
            day = a[:, None] + np.arange(block.shape[1])
            core = (day >= np.maximum(first, tile * tile_days)[:, None]) & (day <= np.minimum(last, (tile + 1) * tile_days - 1)[:, None])
            missing = np.isnan(block)
            keep = core & missing if only_filled else core
            offsets = np.r_[0, np.cumsum(keep.sum(axis=1))].astype(np.int32)
            v = full[keep]
            points = pa.StructArray.from_arrays([pa.array(day[keep].astype(np.int32)), pa.array(v, mask=np.isnan(v)), pa.array(missing[keep])], ["day", "value", "filled"])
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.ListArray.from_arrays(offsets, points)], [*keys, "points"])

    rows = packed(cells, keys, tile_days, before=halo, after=halo)
    kinds = ", ".join(f"{k} {t}" for k, t in rows.select(*keys).dtypes)
    out = rows.mapInArrow(run, f"{kinds}, points array<struct<day:int,value:double,filled:boolean>>")
    return out.select(*keys, F.explode("points").alias("p")).select(*keys, "p.day", "p.value", "p.filled")


def daily_cells(silver: DataFrame) -> DataFrame:
    """Mean of the readings of each park, plain signal and day."""
    rows = in_common_units(silver, ["park_id", "interval_start_date"]).filter("is_reading")
    return rows.groupBy("park_id", F.col("signal").alias("signal_name"), day_number("interval_start_date").alias("day")).agg(F.avg("common").alias("v"))


def regular_series(silver: DataFrame) -> DataFrame:
    """One row per source and day of its period, filled days marked."""
    out = gridded(daily_cells(silver), ["park_id", "signal_name"])
    return out.select("park_id", "signal_name", F.date_from_unix_date("day").cast("string").alias("interval_day"), "value", "filled")


def missing_days(silver: DataFrame) -> DataFrame:
    """The days of ``regular_series`` that were filled."""
    out = gridded(daily_cells(silver), ["park_id", "signal_name"], only_filled=True)
    return out.select("park_id", "signal_name", F.date_from_unix_date("day").cast("string").alias("interval_day"))
