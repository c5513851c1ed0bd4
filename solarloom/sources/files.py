"""File sources: wide exports, inboxes, mappings, run logs, table folders."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXPORTS = (".csv", ".txt")
#: A run: its second, and a file's hash where two files of one second must differ.
RUN_ID = re.compile(r"\d{8}T\d{6}Z(-[0-9a-f]{8})?")

# The run log's columns.
RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("dataset", T.StringType()),
    T.StructField("input_file_processing_path", T.StringType()), T.StructField("archived_path", T.StringType()),
    T.StructField("source_file_hash", T.StringType()), T.StructField("mapping_filename", T.StringType()),
    T.StructField("mapping_file_hash", T.StringType()), T.StructField("rows_long", T.LongType()),
    T.StructField("files_written", T.ArrayType(T.StringType())), T.StructField("ingested_at_utc", T.StringType()),
    T.StructField("duplicate_seen", T.BooleanType()), T.StructField("allow_duplicates", T.BooleanType()),
    T.StructField("status_note", T.StringType()),
])


def wide_export(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """A wide text export; all cells as strings, so that reading never fails."""
    if not path.lower().endswith(EXPORTS):
        raise ValueError(f"no reader for {path}; exports are {', '.join(EXPORTS)}")
    rows = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("mode", "PERMISSIVE").csv(path)
    return rows.withColumn("source_file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def export_columns(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """The header alone: a plan without any job over the rows."""
    return spark.read.option("header", True).option("sep", sep).csv(path).columns


def inbox(spark: SparkSession, folder: str, least_age_s: int = 0, now_s: float | None = None) -> DataFrame:
    """Files ready for pick-up (known extension, not empty, old enough), with
    their content hash, oldest first."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    known = F.lit(False)
    for e in EXPORTS:
        known |= name.endswith(e)
    now = F.current_timestamp() if now_s is None else F.timestamp_seconds(F.lit(now_s))
    ready = files.filter(known & (F.col("length") > 0) & (F.col("modificationTime") <= now - F.expr(f"interval {least_age_s} seconds")))
    return ready.select("path", "length", "modificationTime", F.sha2("content", 256).alias("source_file_hash")).orderBy("modificationTime", "path")


def listing(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``path, length, modificationTime`` of the files below a folder; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return files.select("path", "length", "modificationTime")


def settled(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files of two listings, some seconds apart, that did not change between them."""
    return after.join(before, ["path", "length", "modificationTime"], "left_semi")


def first_files(paths: DataFrame, n: int, year: int | None = None) -> DataFrame:
    """The first ``n`` paths by name, of one year where asked."""
    rows = paths.select("path").distinct()
    if year is not None:
        rows = rows.filter(F.col("path").contains(str(year)))
    return rows.orderBy("path").limit(n)


def partitions(table: DataFrame) -> DataFrame:
    """Files, bytes and rows of each month partition, from file metadata."""
    rows = table.select("year", "month", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    files = rows.groupBy("year", "month", "file").agg(F.first("size").alias("size"), F.count("*").alias("n"))
    return files.groupBy("year", "month").agg(F.count("*").alias("n_files"), F.sum("size").alias("n_bytes"), F.sum("n").alias("n_rows"))


def run_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Run-log JSON files; malformed ones are left out."""
    schema = T.StructType([*RUN_LOG.fields, T.StructField("_corrupt", T.StringType())])
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(folder)
    return rows.filter(F.col("_corrupt").isNull()).drop("_corrupt")


def new_files(logs: DataFrame, after_run: str | None, dataset: str | None = None) -> DataFrame:
    """``run_id, path`` of the files written by valid runs after a run, each path
    once (at its first run)."""
    rows = logs.filter(F.col("run_id").rlike(f"^{RUN_ID.pattern}$"))
    if after_run:
        rows = rows.filter(F.col("run_id") > after_run)
    if dataset:
        rows = rows.filter(F.col("dataset") == dataset)
    paths = rows.select("run_id", F.explode("files_written").alias("path")).filter(F.trim("path") != "")
    return paths.groupBy("path").agg(F.min("run_id").alias("run_id"))


def mapping(spark: SparkSession, path: str) -> DataFrame:
    """``original, sanitized``; with or without header, columns in either order
    (sanitized names are those with ``__``)."""
    rows = spark.read.schema("a string, b string").csv(path).filter(~F.lower("a").isin("original", "sanitized"))
    counts = rows.agg(F.count_if(F.col("a").contains("__")).alias("a"), F.count_if(F.col("b").contains("__")).alias("b")).first()
    original, clean = ("b", "a") if counts["a"] > counts["b"] else ("a", "b")
    return rows.select(F.col(original).alias("original"), F.col(clean).alias("sanitized")).dropDuplicates(["original"])


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns under their mapped names; others pass through."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})
