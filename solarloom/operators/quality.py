"""Flags, duplicates, rules and profiles of measurement rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ingest import finite
from .quantiles import exact_quantiles, with_quantiles
from .sizing import checked_side, checkpointed

FLAGS = ("flag_missing_required", "flag_invalid_value", "flag_invalid_unit_range", "flag_duplicate")


def flagged(df: DataFrame, rules: DataFrame, required: list[str], mark_all: bool = True) -> DataFrame:
    """Recompute the four flags.  Rules (unit, min_allowed, max_allowed) are a
    small fixed dimension; the rules of one unit are united.  ``mark_all``
    marks every copy of a key, else all but the first (by run, file and content;
    rows without a key are nobody's copies then).  Copies are counted map-side
    and joined back, so those of a hot key never meet in one task."""
    rules = rules.groupBy(F.lower(F.trim("unit")).alias("_unit")).agg(F.min("min_allowed").alias("_lo"), F.max("max_allowed").alias("_hi"))
    rows = df.drop(*FLAGS).withColumn("_unit", F.regexp_replace(F.lower(F.trim("unit")), "^u_", ""))
    rows = rows.join(checked_side(rules), "_unit", "left").withColumn("_v", finite(F.col("value")))
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in required])
    outside = F.coalesce((F.col("_v") < F.col("_lo")) | (F.col("_v") > F.col("_hi")), F.lit(False))
    if mark_all:
        copies = df.groupBy(F.col("ingest_key").alias("_key")).agg(F.count("*").alias("_copies")).filter("_copies > 1")
        rows = rows.join(copies, F.col("ingest_key").eqNullSafe(F.col("_key")), "left")
        rows = rows.withColumn("_duplicate", F.col("_copies").isNotNull()).drop("_copies", "_key")
    else:
        content = F.xxhash64(*[c for c in df.columns if c not in FLAGS])
        rows = checkpointed(rows.withColumn("_place", F.struct("run_id", "source_file_hash", content, F.monotonically_increasing_id().alias("id"))))
        first = rows.filter(F.col("ingest_key").isNotNull()).groupBy(F.col("ingest_key").alias("_key")).agg(F.min("_place").alias("_first"), F.count("*").alias("_copies"))
        rows = rows.join(first.filter("_copies > 1"), F.col("ingest_key") == F.col("_key"), "left")
        rows = rows.withColumn("_duplicate", F.coalesce(F.col("_place") != F.col("_first"), F.lit(False))).drop("_place", "_key", "_first", "_copies")
    rows = rows.withColumns({"flag_missing_required": missing, "flag_invalid_value": F.col("_v").isNull(), "flag_invalid_unit_range": outside, "flag_duplicate": F.col("_duplicate")})
    return rows.drop("_unit", "_lo", "_hi", "_v", "_duplicate")


def any_flag() -> Column:
    return reduce(Column.__or__, [F.coalesce(F.col(f), F.lit(False)) for f in FLAGS])


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows; together they are ``df``."""
    return df.filter(~any_flag()), df.filter(any_flag())


def flag_counts(df: DataFrame) -> DataFrame:
    """One row: all rows, those of each flag, and those of any."""
    return df.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(f)).alias(f) for f in FLAGS], F.count_if(any_flag()).alias("n_flagged"))


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last by ``order`` (ties by the whole row); aggregated, not sorted."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order, F.xxhash64(*rest)))
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*").select(*df.columns)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by ``order`` (ties by the whole row)."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order, F.xxhash64(*rest)))
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*").select(*df.columns)


def new_keys(batch: DataFrame, existing: DataFrame, keys: tuple[str, ...] = ("ingest_key",)) -> DataFrame:
    """Rows of the batch whose key is not in the table; reads only its keys.

    By key alone a row comes once, whatever its run; ``("ingest_key", "run_id")``
    lets a later run bring it again.  Rows with a null key are not comparable and
    are left out: they belong into quarantine (``flagged`` marks them as missing
    when the key is required)."""
    batch = batch.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))
    return batch.join(existing.select(*keys), list(keys), "left_anti")


def invalid_percent(df: DataFrame) -> DataFrame:
    """Rows, flagged rows and their percentage, as one row."""
    n = F.count("*")
    bad = F.count_if(any_flag())
    return df.agg(n.alias("n_rows"), bad.alias("n_invalid"), F.round(F.coalesce(F.try_divide(bad * 100.0, n), F.lit(0.0)), 4).alias("invalid_pct"))


def benchmarks(df: DataFrame, rules: DataFrame, quantiles=(0.01, 0.5, 0.99)) -> DataFrame:
    """Statistics of the finite values of each unit of the rules, zero counts included."""
    rows = df.select(F.regexp_replace(F.lower(F.trim("unit")), "^u_", "").alias("unit"), finite(F.col("value")).alias("v")).filter("v is not null")
    rules = checked_side(rules.select("unit", "min_allowed", "max_allowed"))
    rows = rows.join(rules, "unit")
    stats = rows.groupBy("unit").agg(
        F.count("*").alias("n"), F.min("v").alias("v_min"), F.max("v").alias("v_max"),
        F.count_if(F.col("v") < F.col("min_allowed")).alias("n_low"), F.count_if(F.col("v") > F.col("max_allowed")).alias("n_high"),
    )
    stats = with_quantiles(stats, rows, ["unit"], "v", tuple(quantiles)).withColumns({f"p{round(q * 100):02d}": F.col("q")[i] for i, q in enumerate(quantiles)}).drop("q")
    out = rules.join(stats, "unit", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n", "n_low", "n_high")}
    return out.withColumns(zero).withColumn("invalid_fraction", F.coalesce(F.try_divide((F.col("n_low") + F.col("n_high")).cast("double"), F.col("n")), F.lit(0.0)))


def missing_values(df: DataFrame) -> DataFrame:
    """Null count and percentage of each column that has nulls; one pass."""
    wide = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = wide.unpivot(["_n"], df.columns, "column_name", "n_missing")
    return long.filter("n_missing > 0").select("column_name", "n_missing", F.round(F.col("n_missing") * 100.0 / F.col("_n"), 4).alias("pct_missing"))


def problematic(df: DataFrame, keys: list[str], value: str = "value", most_missing: float = 0.5, most_zero: float = 0.8) -> DataFrame:
    """Series with too many missing values or, of the others, too many zeros."""
    v = finite(F.col(value))
    g = df.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(v.isNull().cast("int")).alias("missing_share"), F.avg((v == 0).cast("int")).alias("zero_share"))
    return g.filter((F.col("missing_share") >= most_missing) | (F.col("zero_share") >= most_zero))


def iqr_bounds(df: DataFrame, keys: list[str], value: str = "value", k: float = 1.5) -> DataFrame:
    q = exact_quantiles(df, keys, value, (0.25, 0.75))
    a, b = F.col("q")[0], F.col("q")[1]
    return q.select(*keys, (a - k * (b - a)).alias("lo"), (b + k * (b - a)).alias("hi"))


def iqr_outliers(df: DataFrame, keys: list[str], value: str = "value", k: float = 1.5) -> DataFrame:
    """Rows outside their series' fences."""
    return df.join(iqr_bounds(df, keys, value, k), keys).filter((F.col(value) < F.col("lo")) | (F.col(value) > F.col("hi")))
