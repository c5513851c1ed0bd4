"""Profiles of the fact: overview, statistics, coverage, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .quantiles import with_quantiles


def overview(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct("park_id").alias("n_parks"), F.countDistinct("signal_name").alias("n_signals"), F.countDistinct("unit").alias("n_units"), F.min("interval_start_date").alias("first_day"), F.max("interval_start_date").alias("last_day"))


def stats_by(df: DataFrame, keys: list[str], value: str = "value", quantiles=(0.05, 0.5, 0.95), count_nulls: bool = False) -> DataFrame:
    """Count, extremes, mean, sample deviation and exact quantiles by keys."""
    g = df.groupBy(*keys).agg((F.count("*") if count_nulls else F.count(value)).alias("n"), F.min(value).alias("v_min"), F.max(value).alias("v_max"), F.avg(value).alias("v_mean"), F.stddev_samp(value).alias("v_std"))
    g = with_quantiles(g, df, keys, value, tuple(quantiles))
    return g.select(*keys, "n", "v_min", "v_max", "v_mean", "v_std", *[F.col("q")[i].alias(f"p{round(x * 100):02d}") for i, x in enumerate(quantiles)])


def coverage(df: DataFrame) -> DataFrame:
    return df.groupBy("park_id", "signal_name").agg(F.min("interval_start_date").alias("first_day"), F.max("interval_start_date").alias("last_day"), F.countDistinct("interval_start_date").alias("n_days"), F.count("*").alias("n_rows"))


def coverage_matrix(df: DataFrame) -> DataFrame:
    """Rows of every park and day between the table's first and last day of the park."""
    n = df.groupBy("park_id", F.col("interval_start_date").alias("day")).agg(F.count("*").alias("n_rows"))
    spine = n.groupBy("park_id").agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    return spine.join(n, ["park_id", "day"], "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


def histogram(df: DataFrame, keys: list[str], value: str, bins: int) -> DataFrame:
    """Counts of equal bins between each group's extremes; the last bin is closed."""
    ends = df.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    at = F.when(F.col("hi") > F.col("lo"), F.floor((F.col(value) - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins))).otherwise(0)
    rows = df.join(ends, keys).withColumn("bin", F.least(F.lit(bins - 1), at).cast("int"))
    return rows.groupBy(*keys, "bin").agg(F.count("*").alias("n"))


def value_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def top(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The n most frequent combinations; ties by name (a report, hence a limit)."""
    return value_counts(df, *keys).orderBy(F.desc("n"), *keys).limit(n)


def thinned(df: DataFrame, keys: list[str], order: list[str], most: int) -> DataFrame:
    """Every k-th row of a series, so that about ``most`` are left."""
    w = W.partitionBy(*keys)
    step = F.greatest(F.lit(1), F.floor(F.count("*").over(w) / most))
    rows = df.withColumns({"_k": F.row_number().over(w.orderBy(*order)) - 1, "_step": step})
    return rows.filter(F.col("_k") % F.col("_step") == 0).drop("_k", "_step")


def by_park(df: DataFrame) -> DataFrame:
    return df.groupBy("park_id").agg(F.min("park_capacity_kwp").alias("capacity_kwp"), F.count("value").alias("n_values"), F.countDistinct("signal_name").alias("n_signals"))


def hash_sample(df: DataFrame, key: str, share: float) -> DataFrame:
    """Rows whose key's hash falls into a share of all hashes: the same rows on
    every run, and all copies of a key or none.  Null keys are not sampled."""
    first = F.conv(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 8), 16, 10).cast("long")
    return df.filter(first < int(share * 2**32))


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, n, n_distinct, mean, std, least, most`` of numeric columns."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "v")
    v = F.col("v")
    return long.groupBy("column_name").agg(F.count(v).alias("n"), F.countDistinct(v).alias("n_distinct"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("least"), F.max(v).alias("most"))
