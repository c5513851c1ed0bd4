"""Structured Streaming: exports to the fact, exactly once, and event windows."""

from __future__ import annotations

import csv
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import append_monthly, key_of, time_column, unreadable_rows, wide_to_long
from ..operators.quality import flagged, new_keys, split
from ..operators.sizing import checkpointed
from ..sinks.control import Registry, existing


REQUIRED = ["ts_utc", "park_id", "signal_name", "ingest_key"]
FILE = "path string, modificationTime timestamp, length bigint, content binary"


def commit_batch(fact: DataFrame, rules: DataFrame, folder: str, batch_id: int) -> tuple[int, int]:
    """One micro-batch: flag (copies too), divert invalid rows to quarantine,
    drop keys that the table has, append.  Running a batch again adds nothing.
    Valid and quarantined rows."""
    spark = fact.sparkSession
    good, bad = split(checkpointed(flagged(fact, rules, REQUIRED, mark_all=False)))
    known = existing(spark, f"{folder}/fact")
    append_monthly(new_keys(good, known) if known is not None else good, f"{folder}/fact")
    bad.write.mode("overwrite").parquet(f"{folder}/quarantine/batch={batch_id}")
    return good.count(), bad.count()


def _long(spark: SparkSession, paths: list[str], columns: list[str], files: DataFrame, zone: str) -> tuple[DataFrame, DataFrame]:
    """Long rows, and rows without a readable time, of files of one header."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = spark.read.schema(schema).option("header", True).csv(paths)
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    rows = rows.withColumn("_path", plain(F.col("_metadata.file_path")))
    about = files.select(plain(F.col("path")).alias("_path"), F.element_at(F.split("path", "/"), -1).alias("source_file"), "source_file_hash")
    rows = checkpointed(rows.join(F.broadcast(about), "_path").drop("_path"))  # at most the files of one trigger
    return wide_to_long(rows, zone=zone), unreadable_rows(rows, zone)


def ingest_exports(spark: SparkSession, inbox: str, rules: DataFrame, folder: str, run_id: str = "stream", zone: str = "Europe/Athens", allow_duplicates: bool = False, files_per_trigger: int = 1000) -> None:
    """Read all new wide CSV exports of an inbox and stop; the checkpoint
    remembers the files, so that a second call reads only later ones.

    A file is known by the hash of its content: one that was ingested under any
    name is registered as a duplicate and not read (unless ``allow_duplicates``).
    Columns go by the file's own header; a file without a time column is
    rejected, rows without a readable time are quarantined.
    """
    registry = Registry(spark, f"{folder}/registry")
    files = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", files_per_trigger).load(inbox)

    def batch(df: DataFrame, batch_id: int) -> None:
        header = F.regexp_replace(F.element_at(F.split(F.decode("content", "UTF-8"), "\r?\n"), 1), "^\ufeff", "")
        found = checkpointed(df.select("path", F.sha2("content", 256).alias("source_file_hash"), header.alias("header")))
        fresh = found if allow_duplicates else registry.unseen(found)
        first = fresh.groupBy("source_file_hash").agg(F.min("path").alias("path"), F.first("header").alias("header"))
        todo = [r.asDict() for r in (fresh if allow_duplicates else first).collect()]  # files of one trigger
        taken, events, parts, lost = {r["path"] for r in todo}, [], [], []
        event = lambda r, status, message="": {"dataset": "exports", "source_file": r["path"], "source_file_hash": r["source_file_hash"], "run_id": run_id, "status": status, "message": message}
        events += [event(r, "skipped_duplicate") for r in found.select("path", "source_file_hash").collect() if r["path"] not in taken]
        for line in dict.fromkeys(r["header"] for r in todo):
            columns = next(csv.reader([line or ""]), [])
            mine = [r for r in todo if r["header"] == line]
            try:
                time_column(columns)
            except ValueError as e:
                events += [event(r, "rejected", str(e)) for r in mine]
                continue
            long, unread = _long(spark, [r["path"] for r in mine], columns, fresh, zone)
            parts.append(long)
            lost.append(unread.select("source_file", "source_file_hash", F.to_json(F.struct("*")).alias("row")))
            events += [event(r, "ingested") for r in mine]
        if parts:
            fact = reduce(DataFrame.unionByName, parts)
            key = key_of(F.col("park_id"), F.col("ts_utc"), F.col("signal_name"), F.col("unit"), F.col("source_file_hash"))
            commit_batch(fact.withColumns({"ingest_key": key, "run_id": F.lit(run_id)}), rules, folder, batch_id)
            reduce(DataFrame.unionByName, lost).write.mode("overwrite").parquet(f"{folder}/unreadable/batch={batch_id}")
        if events:
            registry.append(events)

    q = files.writeStream.foreachBatch(batch).option("checkpointLocation", f"{folder}/_progress").trigger(availableNow=True).start()
    q.awaitTermination()


def drain(spark: SparkSession, path: str, window: str = "1 day") -> DataFrame:
    """Events of a Parquet file as a stream: counts and sums by window and type,
    brought to completion and returned as a table."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    rows = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    at = F.col("ts").cast("timestamp").alias("at")
    sums = rows.select(at, "event_type", "value").withWatermark("at", "30 days").groupBy(F.window("at", window), "event_type")
    sums = sums.agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"))
    target = f"drain_{uuid.uuid4().hex}"
    q = sums.writeStream.outputMode("complete").format("memory").queryName(target).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(target).select(F.col("window.start").cast("string").alias("at"), "event_type", "n", "total")
