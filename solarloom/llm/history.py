"""Problem 7: deduplicating new batches against all history.

Every row has up to two texts: its key, and, if it is a reading, the words
(park, plain signal, true second) with its value.  A row repeats an earlier
run's row if one text of it is wholly covered by a match in the suffix array of
an earlier batch (or of its own), and, for readings, the exact check finds the
values within 0.1 % and the run earlier.

``AcceptedHistory`` keeps the accepted batches in a shared folder: texts belong
to shards by hash, and a batch adds one immutable suffix array to each shard it
touches (``suffix``).  A new batch is shuffled to its shards once, searches the
arrays there by binary search over mapped files, and becomes an array itself;
arrays of equal level are merged, so that n batches leave log n arrays.  Neither
dates nor file hashes decide where a text lies, so a copy that is booked on
another day, or delivered in another file, is found all the same.

Hot texts: shards are counted first, and one that holds more than ``HOT`` rows
of a batch is not gathered: its copies collapse in a map-side aggregate to one
record per text and value with first and last run, records are split by value
cells (those near an edge visit the neighbour as well), and the rows are joined
back.  The result is the same.

Defined results: rows with null ``run_id`` are never new and give no row; null
keys have no key text, and a row without key is never named; a null value,
park, name, date or time leaves only the key.  Copies inside one run alone are
no case.  Ids of runs sort by their bytes.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.instants import lag_of, park_zones, with_instants
from ..operators.readings import CommonUnits
from ..operators.sizing import bucket_count, bucket_of, checked_side, checkpointed, remove_folder, shared_folder
from ..sinks.shared import remove
from . import suffix
from .suffix import SuffixArray

TOLERANCE = 0.001
#: Rows of a batch per shard, and from how many on a shard is split instead of gathered.
ROWS, HOT = 60_000, 240_000
#: Batches in which a whole table is replayed.
BATCHES = 4
WORDS = ["w1", "w2", "w3"]
TEXT = [*WORDS, "value"]


def packed_key(key: Column) -> Column:
    """The key as bytes; hexadecimal keys take half the room in the shuffle."""
    raw = F.unhex(key)
    return F.when(F.lower(F.hex(raw)) == key, F.concat(F.lit(b"\x01"), raw)).otherwise(F.concat(F.lit(b"\x00"), F.encode(key, "UTF-8")))


def plain_key(packed: Column) -> Column:
    body = F.substring(packed, 2, 2_000_000_000)
    return F.when(F.substring(packed, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(body))).otherwise(F.decode(body, "UTF-8"))


class Texts:
    """Texts of a table's rows; what the table needs once is found once."""

    def __init__(self, silver: DataFrame, park_metadata: DataFrame):
        self.units, self.zones = CommonUnits(silver), checked_side(park_zones(park_metadata))

    def rows(self, n_shards: int, only: Column | None = None) -> DataFrame:
        """``shard, key (packed), run, w1, w2, w3, value``: a row per row and text."""
        rows = self.units.rows(["ingest_key", "run_id", "park_id", "interval_start_date", "ts_local"], only=only, keep=F.col("run_id").isNotNull(), lag=lag_of(F.col("signal")))
        rows = with_instants(rows, None, "lag", zones=self.zones)
        second = F.floor(F.col("instant.first_us") / F.lit(1_000_000)).cast("long")
        text = lambda a, b, c, v: F.struct(a.alias("w1"), b.alias("w2"), c.alias("w3"), v.alias("value"))
        key = F.when(F.col("ingest_key").isNotNull(), text(F.xxhash64("ingest_key", F.lit("key")), F.xxhash64("ingest_key", F.lit("more")), F.lit(0).cast("long"), F.lit(0.0)))
        reading = F.when(F.col("is_reading") & second.isNotNull(), text(F.xxhash64("park_id"), F.xxhash64("signal"), second, F.col("common")))
        rows = rows.select(packed_key(F.col("ingest_key")).alias("key"), F.col("run_id").alias("run"), F.explode(F.array_compact(F.array(key, reading))).alias("t"))
        return rows.select(bucket_of(n_shards, "t.w1", "t.w2", "t.w3").alias("shard"), "key", "run", "t.*")


def value_cell(v: Column) -> Column:
    """Cells of 10 % width; values within the tolerance lie in one cell or in neighbours."""
    return (F.signum(v) * F.floor(F.log(F.greatest(F.abs(v), F.lit(1e-9))) / F.lit(0.1) + 1000)).cast("int")


def run_bytes(column: pa.ChunkedArray) -> np.ndarray:
    """Runs as byte strings that sort like Spark's."""
    coded = column.combine_chunks().dictionary_encode()
    names = np.array([r.encode("utf-8") for r in coded.dictionary.to_pylist()] or [b""])
    return names[coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)]


def words_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return np.stack([table[w].to_numpy() for w in WORDS], axis=1).astype(np.int64), table["value"].to_numpy().astype(np.float64)


class Shard:
    """What a task does with one shard: search the live arrays, add one."""

    def __init__(self, folder: str, live: set[int], folded: set[int], segment: int):
        self.folder, self.live, self.folded, self.segment = folder, live, folded, segment

    def _at(self, shard: int) -> str:
        return f"{self.folder}/{shard:06d}"

    def earlier(self, shard: int, own: SuffixArray, words: np.ndarray, value: np.ndarray, run: np.ndarray) -> np.ndarray:
        """Whether each record has a match with an earlier run than its own;
        and the first such run."""
        keys, first = suffix.suffix_keys(words, value), run.copy()
        for array in [own, *map(suffix.read, suffix.files_of(self._at(shard), self.live))]:
            # Equal words are needed whatever the value: coverage first, then the exact check.
            like = np.flatnonzero(array.covered(keys) >= 1.0)
            seen = array.earliest(words[like], value[like], TOLERANCE)
            there = seen != b""
            at, seen = like[there], seen[there]
            width = f"S{max(first.dtype.itemsize, seen.dtype.itemsize)}"
            first = first.astype(width)
            first[at] = np.where(seen.astype(width) < first[at], seen, first[at])
        return first

    def add(self, shard: int, own: SuffixArray, part: int) -> None:
        old = [suffix.read(p) for p in suffix.files_of(self._at(shard), self.folded)] if part == 0 else []
        path = f"{self._at(shard)}/{self.segment:06d}.{part}.sa"
        if old:
            suffix.write_merged(path, [own, *old])
        elif len(own):
            own.write(path)

    def judge(self, table: pa.Table) -> pa.Table:
        """Rows of a shard that repeat an earlier run's (``key, run``)."""
        shard = table["shard"][0].as_py()
        table = table.filter(table["run"].is_valid())
        words, value = words_of(table)
        run = run_bytes(table["run"])
        own = SuffixArray.of(suffix.suffix_keys(words, value), run)
        late = run > self.earlier(shard, own, words, value, run)
        self.add(shard, own, 0)
        return table.filter(pa.array(late)).filter(pa.compute.field("key").is_valid()).select(["key", "run"])

    def judge_records(self, table: pa.Table) -> pa.Table:
        """Texts of a part of a hot shard with the first run they repeat
        (``since``), where some run of theirs is later."""
        shard, part = table["shard"][0].as_py(), table["part"][0].as_py()
        words, value = words_of(table)
        first, last = run_bytes(table["first_run"]), run_bytes(table["last_run"])
        core = table["core"].to_numpy(zero_copy_only=False).astype(bool)
        own = SuffixArray.of(suffix.suffix_keys(words[core], value[core]), first[core])
        since = self.earlier(shard, own, words, value, first)
        self.add(shard, own, 1 + part)
        late = last > since
        found = table.select(TEXT).filter(pa.array(late))
        return found.append_column("since", pa.array([s.decode("utf-8") for s in since[late]], pa.string()))


class AcceptedHistory:
    """History of accepted batches in a shared folder, for batches as they come.

    Batches must come in the order of their runs.  ``shards`` is fixed for the
    life of a history; ``live`` (number and level of each segment) is the whole
    state and resumes one.  Two segments of one level become one of the next
    while the batch that completes them is written; their files are removed
    after that, so a lost executor or a failed batch leaves the history as it was.
    """

    def __init__(self, spark: SparkSession, folder: str, shards: int = 64, live: list[tuple[int, int]] = ()):
        self.spark, self.folder, self.shards = spark, folder.rstrip("/"), shards
        self.live = [tuple(x) for x in live]

    def accept(self, batch: DataFrame, park_metadata: DataFrame) -> DataFrame:
        """``ingest_key, run_id`` of the batch's rows that repeat an earlier
        run's (of the history or of the batch); then the batch is history too."""
        rows = checkpointed(Texts(batch, park_metadata).rows(self.shards))
        return self.accept_texts(rows, hot_shards(rows))

    def accept_texts(self, rows: DataFrame, hot: DataFrame | None) -> DataFrame:
        """``rows`` of ``Texts``; ``hot``: shards to split and their parts."""
        segment, level, folded = max([n for n, _ in self.live], default=0) + 1, 0, set()
        while any(x == level for n, x in self.live if n not in folded):
            folded |= {n for n, x in self.live if x == level}
            level += 1
        task = Shard(self.folder, {n for n, _ in self.live}, folded, segment)
        plain = rows if hot is None else rows.join(hot, "shard", "left_anti")
        if folded:  # every shard takes part in a merge
            none = [F.lit(None).cast(t).alias(c) for c, t in plain.dtypes if c != "shard"]
            plain = plain.unionByName(self.spark.range(self.shards).select(F.col("id").cast("int").alias("shard"), *none))
        n = min(self.shards, 100_000)
        found = plain.repartition(n, "shard").groupBy("shard").applyInArrow(lambda t: task.judge(t), "key binary, run string")
        if hot is not None:
            found = found.unionByName(self._hot(rows.join(hot, "shard"), task))
        found = checkpointed(found.distinct())
        self.live = [(n, x) for n, x in self.live if n not in folded] + [(segment, level)]
        self._drop(folded)
        return found.select(plain_key(F.col("key")).alias("ingest_key"), F.col("run").alias("run_id"))

    def _hot(self, rows: DataFrame, task: Shard) -> DataFrame:
        v = F.col("value")
        records = rows.groupBy("shard", "parts", *TEXT).agg(F.min("run").alias("first_run"), F.max("run").alias("last_run"))
        cells = F.array_distinct(F.array(value_cell(v), value_cell(v * 1.0011), value_cell(v * 0.9989)))
        records = records.withColumn("cell", F.explode(cells)).withColumn("core", F.col("cell") == value_cell(v))
        part = F.pmod(F.xxhash64(*WORDS, "cell"), F.col("parts")).cast("int")
        records = records.withColumn("part", part).drop("cell", "parts")
        found = records.groupBy("shard", "part").applyInArrow(lambda t: task.judge_records(t), "w1 long, w2 long, w3 long, value double, since string")
        found = checkpointed(found.groupBy(*TEXT).agg(F.min("since").alias("since")))
        same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in TEXT]
        hit = rows.alias("a").join(checked_side(found).alias("b"), [*same, F.col("a.run") > F.col("b.since")], "left_semi")
        return hit.filter(F.col("key").isNotNull()).select("key", "run")

    def _drop(self, segments: set[int]) -> None:
        """Files of merged segments; tasks remove them, shard by shard."""
        if not segments:
            return
        folder = self.folder

        def run(batches):
            for b in batches:
                for shard in b.column(0).to_pylist():
                    for path in suffix.files_of(f"{folder}/{shard:06d}", segments):
                        remove(path)
                yield b

        self.spark.range(self.shards).mapInArrow(run, "id long").write.format("noop").mode("overwrite").save()


def hot_shards(rows: DataFrame, *more: str) -> DataFrame | None:
    """Shards (of each of ``more``) with more than ``HOT`` rows, and the parts
    that they are split into; None if there are none, as usual."""
    counts = rows.groupBy(*more, "shard").agg(F.count("*").alias("n")).filter(F.col("n") > HOT)
    hot = checkpointed(counts.select(*more, "shard", F.ceil(F.col("n") / ROWS).cast("int").alias("parts")))
    return None if hot.isEmpty() else checked_side(hot)


def repeats(silver: DataFrame, park_metadata: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``ingest_key, run_id`` of each row that repeats a row of an earlier run.

    The table is replayed in ``batches`` ranges of runs, in order, each accepted
    into a history as a new batch would be; none reads the rows before it."""
    texts = Texts(silver, park_metadata)
    shards = bucket_count(2 * texts.units.profile.n_rows // batches, ROWS)
    spark = silver.sparkSession
    history = AcceptedHistory(spark, f"{shared_folder(spark)}/history-{uuid.uuid4().hex}", shards)
    ranges = texts.units.run_ranges(batches)
    number = sum(((F.col("run") > F.lit(z)).cast("int") for _, z in ranges[:-1]), F.lit(0))
    hot = hot_shards(texts.rows(shards).withColumn("batch", number), "batch")
    found = None
    for k, (a, z) in enumerate(ranges):
        mine = None if hot is None else hot.filter(F.col("batch") == k).drop("batch")
        some = history.accept_texts(texts.rows(shards, only=F.col("run_id").between(a, z)), mine)
        found = some if found is None else found.unionByName(some)
    remove_folder(spark, history.folder)
    return found if found is not None else spark.createDataFrame([], "ingest_key string, run_id string")
