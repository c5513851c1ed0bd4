"""Queries of problems 7 to 10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.domain import COMMON, INSTANTS
from ..sources.tables import table
from . import encoding, history, mixing, reading


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return history.repeats(table(spark, sf, "silver_prepair"), table(spark, sf, "park_metadata"))


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.encoded(table(spark, sf, "documents"), ["doc_id"])


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixed(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.shares(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return reading.demanding(table(spark, sf, "documents"), table(spark, sf, "reading_grades"))


def p10_levels(spark: SparkSession, sf: str) -> DataFrame:
    return reading.reading_levels(table(spark, sf, "documents"), table(spark, sf, "reading_grades"))


QUERIES = {f.__name__: f for f in (p7_found, p8_ids, p9_mix, p9_shares, p10_found, p10_levels)}
SQL: dict[str, str] = {
    "p7_found": f"""WITH {COMMON}, {INSTANTS}, u AS (SELECT DISTINCT ingest_key, floor(epoch_us(first_at) / 1000000) AS s FROM i),
q AS (SELECT ingest_key, run_id, park_id, sig, s, common FROM c JOIN u USING (ingest_key))
SELECT a.ingest_key, a.run_id FROM q a JOIN q b ON a.park_id = b.park_id AND a.sig = b.sig AND a.s = b.s AND b.run_id < a.run_id AND abs(a.common - b.common) <= 0.001 * greatest(abs(a.common), abs(b.common))
UNION SELECT ingest_key, run_id FROM (SELECT ingest_key, run_id, min(run_id) OVER (PARTITION BY ingest_key) AS earliest FROM silver_prepair) WHERE run_id > earliest""",
}
