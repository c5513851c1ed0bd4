"""Robust scores, flags and runs of flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAD = 1.4826


def rolling_robust_z(df: DataFrame, value: str, keys: list[str], order: str, window: int = 31) -> DataFrame:
    """Add ``z``: distance from the trailing median in trailing MADs; null with
    fewer than max(7, window // 3) values or a MAD of 0."""
    frame = W.partitionBy(*keys).orderBy(order).rowsBetween(1 - window, 0)
    enough = lambda c, x: F.when(F.count(c).over(frame) >= max(7, window // 3), x)
    df = df.withColumn("_m", enough(value, F.percentile(value, F.lit(0.5)).over(frame)))
    df = df.withColumn("_d", F.abs(F.col(value) - F.col("_m")))
    df = df.withColumn("_mad", enough("_d", F.percentile("_d", F.lit(0.5)).over(frame)))
    return df.withColumn("z", F.try_divide(F.col(value) - F.col("_m"), F.col("_mad") * MAD)).drop("_m", "_d", "_mad")


def robust_score(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Add ``score``: distance from the series' median in MADs; 0 where the MAD
    is 0.  One shuffle by series, for series of one value a day, whose length is
    bounded by time."""
    series = W.partitionBy(*keys)
    median = lambda c: F.percentile(c, F.lit(0.5)).over(series)
    df = df.withColumn("_m", median(value))
    df = df.withColumn("_mad", median(F.abs(F.col(value) - F.col("_m"))))
    score = F.coalesce(F.try_divide(F.col(value) - F.col("_m"), F.col("_mad") * MAD), F.lit(0.0))
    return df.withColumn("score", F.when(F.col(value).isNotNull(), score)).drop("_m", "_mad")


def tail_flag(score: Column, at: float) -> Column:
    """-1 below -at, 1 above at, else 0; null is 0."""
    return F.when(score < -at, -1).when(score > at, 1).otherwise(0)


def band_flag(x: Column, low: float = 0.8, high: float = 1.2) -> Column:
    return F.when(x < low, -1).when(x > high, 1).otherwise(0)


def runs(df: DataFrame, flag: str, keys: list[str], order: str) -> DataFrame:
    """Add ``run`` (number of the stretch of equal flags) and ``run_length``."""
    w = W.partitionBy(*keys).orderBy(order)
    df = df.withColumn("_change", F.coalesce((F.col(flag) != F.lag(flag).over(w)).cast("int"), F.lit(1)))
    df = df.withColumn("run", F.sum("_change").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return df.withColumn("run_length", F.count("*").over(W.partitionBy(*keys, "run"))).drop("_change")


def persistent(df: DataFrame, flag: str, keys: list[str], order: str, least: int = 2) -> DataFrame:
    """Rows whose flag is set and stays set for at least ``least`` rows."""
    return runs(df, flag, keys, order).filter(F.col(flag).cast("boolean") & (F.col("run_length") >= least))
