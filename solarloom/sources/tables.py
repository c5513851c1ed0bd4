"""Reading the project's tables, and the park dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c: Column | str) -> Column:
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def latest_lines(meta: DataFrame, key: str = "park_id", order: str = "line_no") -> DataFrame:
    """One row per key: the line with the greatest ``order``.

    Null keys are dropped.  Two lines with the same key and order are told
    apart by their whole content, so that the result is defined.
    """
    rest = [c for c in meta.columns if c != key]
    line = F.struct(*[F.col(c) for c in rest])
    best = F.max_by(line, F.struct(F.col(order), F.xxhash64(*rest)))
    return meta.filter(F.col(key).isNotNull()).groupBy(key).agg(best.alias("_line")).select(key, "_line.*")
