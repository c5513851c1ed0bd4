"""The incremental step from run logs to the validated fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.ingest import append_monthly
from .operators.quality import FLAGS, any_flag, benchmarks, flagged, new_keys, split
from .operators.sizing import checkpointed
from .sinks.control import Mappings, Watermark, existing, next_version, write_with_sidecar
from .sources.files import new_files

REQUIRED = ["ts_utc", "park_id", "signal_name", "ingest_key"]


@dataclass(frozen=True)
class Outcome:
    runs: int
    rows: int
    invalid: int
    appended: int
    accepted: bool
    flags: dict[str, int]


def validate_new_runs(spark: SparkSession, logs: DataFrame, rules: DataFrame, folder: str, watermark: Watermark, dataset: str | None = None, most_invalid_pct: float | None = 20.0) -> Outcome:
    """Read the files of the runs after the watermark, flag, quarantine, drop
    known keys and append; the watermark moves last, so a failure is retried.

    The gate sees all rows of the batch; a batch beyond ``most_invalid_pct`` is
    quarantined whole.  A batch without rows moves the watermark as well.
    """
    fresh = new_files(logs, watermark.get(), dataset).collect()  # paths of one batch
    runs = sorted({r["run_id"] for r in fresh})
    if not fresh:
        return Outcome(0, 0, 0, 0, True, {})
    raw = spark.read.option("mergeSchema", True).option("ignoreMissingFiles", True).parquet(*[r["path"] for r in fresh])
    rows = checkpointed(flagged(raw, rules, REQUIRED, mark_all=False).withColumn("prepared_at_utc", F.current_timestamp().cast("string")))
    n = rows.agg(F.count("*").alias("n"), F.count_if(any_flag()).alias("bad"), *[F.count_if(F.col(f)).alias(f) for f in FLAGS]).first()
    accepted = most_invalid_pct is None or n["bad"] * 100.0 <= most_invalid_pct * max(1, n["n"])
    good, bad = split(rows) if accepted else (rows.limit(0), rows)
    bad.write.mode("overwrite").parquet(f"{folder}/quarantine/upto={runs[-1]}")
    known = existing(spark, f"{folder}/fact")
    if known is not None:
        good = new_keys(good, known)
    good = checkpointed(good)
    appended = good.count()
    if appended:
        append_monthly(good, f"{folder}/fact")
    watermark.commit(runs)
    return Outcome(len(runs), n["n"], n["bad"], appended, accepted, {f: n[f] for f in FLAGS})


def unit_report(silver: DataFrame, rules: DataFrame, folder: str, mappings: Mappings | None = None) -> str:
    """Statistics of the values of each unit against its rules, written as the
    next version of a report with the mapping in force beside it.  Its path."""
    path = next_version(folder, "unit_report")
    current = mappings.current() if mappings else None
    write_with_sidecar(benchmarks(silver, rules), path, rules=rules.count(), mapping=current and current[0], mapping_sha256=current and current[1])
    return path
