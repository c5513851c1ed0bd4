"""Problem 6: attribute-value rows into wide rows, as log-structured upserts.

A batch of readings becomes a *delta*: one sparse wide row per park and day,
whose cells (in the order of their signals) have a version (the greatest run of
the batch), the value of that version and the range of all values seen.  Deltas are
sorted runs in a shared folder; ``fanout`` runs of a level are *compacted* into
one of the next: the latest version of each cell wins, ranges are united.
Compaction is associative and idempotent for disjoint batches, so runs can be
merged in any order, a few at a time, and a new batch never rewrites history.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .readings import CommonUnits
from .sizing import remove_folder, shared_folder

#: Differences of at most this share of the larger value are no contradiction.
TOLERANCE = 0.001
DAILY = r"^(pcc_active_energy_export|pcc_active_energy_import|average_irradiance|availability|soiling_ratio|fault_count|breaker_state|inverter_\d+_energy)$"
ENTITY = ["park_id", "interval_start_date"]
CELL = [*ENTITY, "signal"]
INTEGRAL = ("fault_count", "breaker_state")
#: Batches (ranges of runs) in which a whole table is upserted, and runs of a level.
BATCHES, FANOUT = 4, 4


def daily_readings(silver: DataFrame, only: Column | None = None, units: CommonUnits | None = None) -> DataFrame:
    columns = ["ingest_key", "park_id", "interval_start_date", "run_id"]
    rows = (units or CommonUnits(silver)).rows(columns, only=only, keep=F.col("is_reading") & F.col("_daily"), _daily=F.col("signal").rlike(DAILY))
    return rows.drop("_daily")


def delta(batch: DataFrame) -> DataFrame:
    """Cells of a batch: ``CELL, version, low, high, n``.

    Ties inside a run are broken by key (hexadecimal ones as their bytes) and
    value; a null run is the oldest.
    """
    key = F.coalesce(F.unhex("ingest_key"), F.encode("ingest_key", "UTF-8"), F.lit(b"")).alias("key")
    version = F.struct(F.coalesce("run_id", F.lit("")).alias("run_id"), key, F.col("common").alias("value"))
    return batch.groupBy(*CELL).agg(F.max(version).alias("version"), F.min("common").alias("low"), F.max("common").alias("high"), F.count("*").alias("n"))


def sparse(cells: DataFrame) -> DataFrame:
    """Sparse wide rows: one per park and day, its cells in the order of their
    signals.  A park's day has as many cells as the park has signals."""
    return cells.groupBy(*ENTITY).agg(F.sort_array(F.collect_list(F.struct("signal", "version", "low", "high", "n"))).alias("cells"))


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.select(*ENTITY, F.explode("cells").alias("c")).select(*ENTITY, "c.*")


def latest(cells: DataFrame) -> DataFrame:
    """Cells of several runs to one each: the latest version wins."""
    return cells.groupBy(*CELL).agg(F.max("version").alias("version"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))


def compact(runs: list[DataFrame]) -> DataFrame:
    """Merge runs of sparse rows into cells.  A run has one row for a park's day,
    so the rows meet in one shuffle by park and day, which serves the merge of
    their cells and the sparse rows made of these."""
    return latest(cells_of(reduce(DataFrame.unionByName, runs).repartition(*ENTITY)))


def differs() -> Column:
    return F.col("high") - F.col("low") > TOLERANCE * F.greatest(F.abs("low"), F.abs("high"))


def contradictory(cells: DataFrame) -> DataFrame:
    """Cells whose values differ by more than the tolerance."""
    return cells.filter(differs())


def to_wide(cells: DataFrame) -> DataFrame:
    """One row per park and day, one typed column per daily signal (counts and
    states as integers), and ``contradictory``, the sorted names of the cells
    with contradictory values.

    The columns are the table's signals.  A park's day is gathered as a list of
    its own cells with the numbers of their columns, and a batch of days is
    scattered to dense columns at once, so a row costs its cells."""
    names = sorted(r[0] for r in cells.select("signal").distinct().collect())  # they become the schema
    marked = cells.select("park_id", F.col("interval_start_date").cast("string").alias("interval_day"), "signal", F.col("version.value").alias("value"), differs().alias("differs"))
    marks = F.sort_array(F.collect_set(F.when(F.col("differs"), F.col("signal")))).alias("contradictory")
    if not names:
        return marked.groupBy("park_id", "interval_day").agg(marks).select("park_id", "interval_day", "contradictory")
    spark = cells.sparkSession
    at = spark.createDataFrame(list(enumerate(names)), "at int, signal string")
    # The schema's own names: as many rows as the result has columns.
    placed = marked.join(F.broadcast(at), "signal")
    pairs = F.collect_list(F.struct("at", "value")).alias("pairs")
    rows = placed.groupBy("park_id", "interval_day").agg(marks, pairs)

    kinds = ", ".join(f"`{n}` {'bigint' if n in INTEGRAL else 'double'}" for n in names)
    return rows.mapInArrow(_spread(names), f"park_id string, interval_day string, {kinds}, contradictory array<string>")


def _spread(names: list[str]):
    """Batches of sparse rows to dense columns, one scatter a batch."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for start in range(0, b.num_rows, 2_000):
                part = b.slice(start, 2_000)
                pairs = part.column(part.schema.get_field_index("pairs"))
                n = np.diff(pairs.offsets.to_numpy())
                flat = pairs.flatten()
                row, at = np.repeat(np.arange(part.num_rows), n), flat.field("at").to_numpy(zero_copy_only=False)
                value = flat.field("value").to_numpy(zero_copy_only=False)
                by = np.argsort(at, kind="stable")
                bounds = np.searchsorted(at[by], np.arange(len(names) + 1))
                columns = []
                for k, name in enumerate(names):
                    w = by[bounds[k] : bounds[k + 1]]
                    dense, there = np.zeros(part.num_rows), np.zeros(part.num_rows, bool)
                    dense[row[w]], there[row[w]] = value[w], True
                    columns.append(pa.array(dense.astype(np.int64) if name in INTEGRAL else dense, mask=~there))
                marks = part.column(part.schema.get_field_index("contradictory"))
                keys = [part.column(part.schema.get_field_index(c)) for c in ("park_id", "interval_day")]
                yield pa.RecordBatch.from_arrays([*keys, *columns, marks], ["park_id", "interval_day", *names, "contradictory"])

    return run


class WideStore:
    """Levels of sorted runs in a folder; every ``fanout`` runs of a level are
    compacted into one run of the next.  Runs are immutable Parquet folders of
    sparse wide rows; ``levels`` (their paths) is the whole state and resumes a
    store."""

    def __init__(self, spark, folder: str, fanout: int = 4, levels: list[list[str]] | None = None):
        self.spark, self.folder, self.fanout = spark, folder.rstrip("/"), fanout
        self.levels = [list(x) for x in levels or [[]]]
        self._n = max([int(p[-6:]) for x in self.levels for p in x], default=0)

    def _write(self, cells: DataFrame, level: int) -> str:
        self._n += 1
        path = f"{self.folder}/level={level}/run-{self._n:06d}"
        sparse(cells).sortWithinPartitions(*ENTITY).write.parquet(path)
        return path

    def upsert(self, batch: DataFrame) -> None:
        """Append one batch of ``daily_readings`` rows; history is not read
        unless a level is full."""
        self.levels[0].append(self._write(delta(batch), 0))
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._write(compact([self.spark.read.parquet(p) for p in self.levels[level]]), level + 1))
                for path in self.levels[level]:
                    remove_folder(self.spark, path)
                self.levels[level] = []

    def cells(self) -> DataFrame:
        """All cells: the few runs left are merged as they are read."""
        runs = [self.spark.read.parquet(p) for level in self.levels for p in level]
        return compact(runs) if len(runs) > 1 else cells_of(runs[0])


def stored(silver: DataFrame, batches: int = BATCHES) -> WideStore:
    """A store into which the table was upserted, run range by run range; rows
    without a run are the oldest."""
    spark = silver.sparkSession
    units = CommonUnits(silver)
    store = WideStore(spark, f"{shared_folder(spark)}/wide-{uuid.uuid4().hex}", FANOUT)
    ranges = units.run_ranges(batches)
    for k, (a, z) in enumerate(ranges or [("", "")]):
        only = F.col("run_id").between(a, z)
        store.upsert(daily_readings(silver, only | F.col("run_id").isNull() if k == 0 else only, units))
    return store


def contradictions(silver: DataFrame) -> DataFrame:
    """Park, day and daily signal of each cell with contradictory values."""
    found = contradictory(stored(silver).cells())
    return found.select("park_id", F.col("interval_start_date").cast("string").alias("interval_day"), F.col("signal").alias("signal_name"))


def wide_days(silver: DataFrame) -> DataFrame:
    return to_wide(stored(silver).cells())
