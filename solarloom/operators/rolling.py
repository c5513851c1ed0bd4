"""Problem 1: rolling totals over trailing periods, days without activity included.

Entities are packed by days into dense numpy blocks (entities x days of a time
tile, with a halo of the preceding days) and multiplied by banded window
operators, one band per trailing period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .readings import in_common_units, with_signals
from .tiles import day_number, packed

TILE_DAYS = 64
PERIODS = (7, 30)


def band(tile_days: int, halo: int, period: int) -> np.ndarray:
    """Window operator: column i sums the ``period`` days that end with tile day i."""
    j, i = np.arange(tile_days + halo)[:, None], np.arange(tile_days)[None, :] + halo
    return ((i - j >= 0) & (i - j < period)).astype(np.float64)


def dense_block(first_day: np.ndarray, width: int, days: pa.ListArray, values: pa.ListArray) -> np.ndarray:
    """Sparse cells to a dense block whose row r starts at ``first_day[r]``."""
    n = np.diff(days.offsets.to_numpy())
    rows = np.repeat(np.arange(len(n)), n)
    at = days.flatten().to_numpy(zero_copy_only=False) - np.repeat(first_day, n)
    v = values.flatten().to_numpy(zero_copy_only=False)
    block = np.zeros((len(n), width))
    ok = (at >= 0) & (at < width)
    np.add.at(block, (rows[ok], at[ok]), v[ok])
    return block


def rolled(cells: DataFrame, keys: list[str], periods: tuple[int, ...] = PERIODS, tile_days: int = TILE_DAYS) -> DataFrame:
    """``keys, day, period_days, total, days_in_period`` of every day of each
    entity's period, from cells ``keys, day (number), v``.

    ``days_in_period`` is how many of the window's days lie in the entity's
    period (less than ``period_days`` at its beginning).  No cells give no rows.
    """
    halo = max(periods) - 1
    bands = np.concatenate([band(tile_days, halo, p) for p in periods], axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start = b.column("tile").to_numpy().astype(np.int64) * tile_days
            block = dense_block(start - halo, tile_days + halo, b.column("days"), b.column("values"))
            sums = (block @ bands).reshape(-1)
            totals = pa.ListArray.from_arrays(np.arange(b.num_rows + 1, dtype=np.int32) * bands.shape[1], pa.array(sums))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), b.column("tile"), b.column("first"), b.column("last"), totals], [*keys, "tile", "first", "last", "totals"])

    rows = packed(cells, keys, tile_days, before=halo)
    kinds = ", ".join(f"{k} {t}" for k, t in rows.select(*keys).dtypes)
    out = rows.mapInArrow(run, f"{kinds}, tile int, first int, last int, totals array<double>")
    out = out.select(*keys, "tile", "first", "last", F.posexplode("totals").alias("at", "total"))
    out = out.withColumn("day", (F.col("tile") * tile_days + F.col("at") % tile_days).cast("int")).filter(F.col("day").between(F.col("first"), F.col("last")))
    period = F.get(F.array(*[F.lit(p) for p in periods]), F.floor(F.col("at") / tile_days).cast("int"))
    out = out.withColumn("period_days", period)
    return out.select(*keys, "day", "period_days", "total", F.least("period_days", F.col("day") - F.col("first") + 1).alias("days_in_period"))


def energy_cells(silver: DataFrame, signal: str) -> DataFrame:
    """One cell per park and day: the value of the latest run in the common
    unit (ties: the greatest key), where a day was delivered more than once."""
    rows = in_common_units(silver, ["ingest_key", "park_id", "interval_start_date", "run_id"], keep=F.col("is_reading") & (F.col("signal") == signal))
    version = F.struct("run_id", "ingest_key", "common")
    return rows.groupBy("park_id", day_number("interval_start_date").alias("day")).agg(F.max_by("common", version).alias("v"))


def rolling_energy(silver: DataFrame, signal: str = "pcc_active_energy_export") -> DataFrame:
    """Totals (to the watt hour) and daily averages of each park, day and trailing period."""
    out = rolled(energy_cells(silver, signal), ["park_id"]).withColumn("total", F.round("total", 3))
    return out.select("park_id", F.date_from_unix_date("day").cast("string").alias("interval_day"), "period_days", "total", "days_in_period", (F.col("total") / F.col("days_in_period")).alias("daily_average"))


def idle_windows(silver: DataFrame, signal: str = "pcc_active_energy_export") -> DataFrame:
    """Days and periods whose window lies wholly in the park's period and holds
    no reading other than 0: rolling totals over the number of such readings."""
    rows = with_signals(silver.select("park_id", "signal_name", "unit", "value", "interval_start_date")).filter(F.col("is_reading") & (F.col("signal") == signal))
    cells = rows.groupBy("park_id", day_number("interval_start_date").alias("day")).agg(F.sum(F.when(F.col("value") != 0, 1.0).otherwise(0.0)).alias("v"))
    out = rolled(cells, ["park_id"]).filter((F.col("total") == 0) & (F.col("days_in_period") == F.col("period_days")))
    return out.select("park_id", F.date_from_unix_date("day").cast("string").alias("interval_day"), "period_days")
