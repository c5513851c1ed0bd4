"""Wide exports to the long fact, and its partitioned table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import TIME_COLUMNS, header_parts
from .instants import instant_of


def time_column(columns: list[str]) -> str:
    """The time column of a wide file: ``ts`` first, then the usual names."""
    for wanted in TIME_COLUMNS:
        for c in columns:
            if c == wanted or wanted != "ts" and c.strip().lower() == wanted:
                return c
    raise ValueError(f"no time column among {columns}")


def interval_day(ts: Column, ends_interval: bool = True) -> Column:
    """The day that a stamp is booked on; at the end of an interval it is the day before."""
    return F.date_sub(F.to_date(ts), 1) if ends_interval else F.to_date(ts)


def key_of(park: Column, ts_utc: Column, signal: Column, unit: Column, file_hash: Column) -> Column:
    """sha256 of a row's identity; nulls count as the text ``<NA>``."""
    na = lambda c: F.coalesce(c.cast("string"), F.lit("<NA>"))
    stamp = F.concat(F.date_format(ts_utc, "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00"))
    return F.sha2(F.concat_ws("|", na(park), na(stamp), na(signal), na(unit), na(file_hash)), 256)


def finite(c: Column) -> Column:
    """NaN and infinities become null."""
    d = c.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def stamped(wide: DataFrame, zone: str) -> DataFrame:
    """Add ``ts_utc`` (null where the text denotes no time) and ``ts_local``, its
    wall time in ``zone``, from the time column of a wide export.

    All layouts of ``functions.timeparse`` are read; a text with a zone of its
    own keeps its instant, a wall time that occurs twice is the earlier one, one
    that does not exist the first instant after the gap.
    """
    at = instant_of(F.col(time_column(wide.columns)).cast("string"), zone)
    rows = wide.withColumn("_at", at)
    utc = F.timestamp_micros(F.col("_at.first_us"))
    return rows.withColumns({"ts_utc": utc, "ts_local": F.from_utc_timestamp(utc, zone)}).drop("_at")


def unreadable_rows(wide: DataFrame, zone: str = "Europe/Athens") -> DataFrame:
    """Rows of a wide export whose time can't be read, for quarantine."""
    return stamped(wide, zone).filter(F.col("ts_utc").isNull()).drop("ts_utc", "ts_local")


def wide_to_long(wide: DataFrame, ends_interval: bool = True, zone: str = "Europe/Athens") -> DataFrame:
    """Unpivot the measurement columns of one or more wide exports.

    Null and non-numeric cells give no row; rows whose time can't be read are
    those of ``unreadable_rows``; columns whose names do not follow the header
    grammar are no measurements.
    """
    names = [c for c in wide.columns if "__" in c]
    kept = [c for c in wide.columns if c.startswith("source_")]
    rows = stamped(wide, zone).filter(F.col("ts_utc").isNotNull())
    narrow = rows.select("ts_local", "ts_utc", *kept, *[F.expr(f"try_cast(`{c}` as double)").alias(c) for c in names])
    long = narrow.unpivot(["ts_local", "ts_utc", *kept], names, "column", "value")
    long = long.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    long = long.withColumns(header_parts(F.col("column"))).filter(F.col("signal_name").isNotNull())
    day = interval_day(F.col("ts_local"), ends_interval)
    return long.withColumns({"interval_start_date": day, "year": F.year(day), "month": F.month(day)}).drop("column")


def append_monthly(fact: DataFrame, folder: str) -> None:
    """Append to the table partitioned by month.  Rows of a month meet before the
    write, so no small files; a month larger than a partition is split by AQE."""
    fact.hint("rebalance", "year", "month").write.mode("append").partitionBy("year", "month").option("compression", "zstd").parquet(folder)


def booked_day(df: DataFrame) -> DataFrame:
    """``interval_start_date`` of every row: its own, else the day of ``ts_local``,
    else that of ``ts_utc``; no day is moved back."""
    own = [F.col("interval_start_date")] if "interval_start_date" in df.columns else []
    return df.withColumn("interval_start_date", F.coalesce(*own, F.to_date(F.try_to_timestamp(F.col("ts_local").cast("string"))), F.to_date("ts_utc")))
