"""Queries of the reference's operators, each with an independent SQL oracle.

Daily energy of several years comes from ``lineitem`` (a park is a supplier, a
day's energy its quantities), measurement rows from ``silver_prepair``.
``f32`` rounds to single precision on both sides, as sums and square roots of
doubles may differ in their last bits.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates, naming
from ..operators import anomaly, decompose, ingest, matching, metrics, profile, quality, reference_day, reshape, selecting, sizing
from ..sources import files
from ..sources.tables import latest_lines, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

AT = dt.date(1998, 2, 28)
FIRST, LAST = dt.date(2024, 3, 5), dt.date(2024, 9, 20)
RUN = "20240601T000000Z"
KEYS = ["park_id", "signal_name"]

ENERGY = "SELECT 's' || l_suppkey AS park_id, l_shipdate::DATE AS day, sum(l_quantity) AS kwh FROM lineitem GROUP BY 1, 2"
FINITE = "value IS NOT NULL AND isfinite(value)"
READ = f"SELECT * FROM silver_prepair WHERE {FINITE} AND park_id IS NOT NULL AND signal_name IS NOT NULL"
UNIT = "regexp_replace(lower(trim(unit)), '^u_', '')"
RULES = "SELECT lower(trim(unit)) AS u, min(min_allowed) AS lo, max(max_allowed) AS hi FROM unit_rules GROUP BY 1"
FLAGGED = f"""SELECT s.*, ts_utc IS NULL OR park_id IS NULL OR signal_name IS NULL AS f_missing, NOT coalesce({FINITE}, false) AS f_value,
 coalesce({FINITE} AND (value < lo OR value > hi), false) AS f_range, count(*) OVER (PARTITION BY ingest_key) > 1 AS f_dup
 FROM silver_prepair s LEFT JOIN ({RULES}) r ON r.u = {UNIT}"""
ANY = "coalesce(flag_missing_required, false) OR coalesce(flag_invalid_value, false) OR coalesce(flag_invalid_unit_range, false) OR coalesce(flag_duplicate, false)"
META = "SELECT * FROM park_metadata WHERE park_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY park_id ORDER BY line_no DESC) = 1"
TYPICAL = f"SELECT park_id, month(day) AS m, day(day) AS d, avg(kwh) AS expected FROM ({ENERGY}) WHERE NOT (month(day) = 2 AND day(day) = 29) GROUP BY 1, 2, 3"


def f32(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("float").cast("double")


def s32(x: str) -> str:
    return f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"


def day_text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "silver_prepair")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("value")
    return silver(spark, sf).filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")) & F.col("park_id").isNotNull() & F.col("signal_name").isNotNull())


def energy(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(F.concat(F.lit("s"), F.col("l_suppkey")).alias("park_id"), F.to_date("l_shipdate").alias("day"), "l_quantity")
    return rows.groupBy("park_id", "day").agg(F.sum("l_quantity").alias("kwh"))


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.periods(energy(spark, sf), "month")


MONTHLY = f"""SELECT p.park_id, p.period, coalesce(s.kwh, 0) AS kwh FROM
 (SELECT park_id, unnest(generate_series(min(date_trunc('month', day)), max(date_trunc('month', day)), INTERVAL 1 MONTH))::DATE AS period FROM ({ENERGY}) GROUP BY park_id) p
 LEFT JOIN (SELECT park_id, date_trunc('month', day)::DATE AS period, sum(kwh) AS kwh FROM ({ENERGY}) GROUP BY 1, 2) s ON s.park_id = p.park_id AND s.period = p.period"""

# ---- calendar aggregates ---------------------------------------------------


@query(f"SELECT park_id, year(day)::INT AS year, sum(kwh) AS kwh FROM ({ENERGY}) WHERE month(day) = 2 AND day(day) <= 28 GROUP BY 1, 2")
def mtd_energy_by_year(spark, sf):
    return metrics.annual_mtd(energy(spark, sf), AT)


def _mtd_total(how: str, sql: str) -> None:
    def f(spark, sf):
        return metrics.annual_mtd(energy(spark, sf), AT, how, per_park=False).select("year", f32("kwh").alias("kwh"))

    f.__name__ = f"mtd_total_by_year_{how}"
    query(f"SELECT year(day)::INT AS year, {s32(sql)} AS kwh FROM (SELECT day, sum(kwh) AS kwh FROM ({ENERGY}) WHERE month(day) = 2 AND day(day) <= 28 GROUP BY day) GROUP BY 1")(f)


for _how, _sql in {"sum": "sum(kwh)", "mean": "avg(kwh)", "median": "median(kwh)", "std": "stddev_samp(kwh)", "count": "count(kwh)", "min": "min(kwh)", "max": "max(kwh)"}.items():
    _mtd_total(_how, _sql)


@query(f"SELECT p.park_id, m.kwh FROM (SELECT DISTINCT park_id FROM ({ENERGY})) p LEFT JOIN (SELECT park_id, sum(kwh) AS kwh FROM ({ENERGY}) WHERE year(day) = 1998 AND month(day) = 2 AND day(day) <= 28 GROUP BY 1) m USING (park_id)")
def mtd_current_year(spark, sf):
    return metrics.current_mtd(energy(spark, sf), AT)


@query(f"SELECT park_id, period::VARCHAR AS period, kwh FROM ({MONTHLY})")
def monthly_energy_spine(spark, sf):
    return monthly(spark, sf).select("park_id", day_text("period").alias("period"), "kwh")


@query(f"SELECT park_id, year(day)::INT AS year, sum(kwh) AS kwh FROM ({ENERGY}) GROUP BY 1, 2")
def yearly_energy(spark, sf):
    return metrics.yearly(energy(spark, sf))


@query(f"SELECT park_id, month(day)::INT AS month, sum(kwh) AS kwh FROM ({ENERGY}) GROUP BY 1, 2")
def seasonal_month(spark, sf):
    return metrics.seasonal(energy(spark, sf))


@query(f"""SELECT park_id, arg_max(year, (kwh, -year))::INT AS best, arg_min(year, (kwh, year))::INT AS worst, max(kwh) AS best_kwh, min(kwh) AS worst_kwh
 FROM (SELECT park_id, year(day) AS year, sum(kwh) AS kwh FROM ({ENERGY}) GROUP BY 1, 2) GROUP BY 1""")
def best_worst_year(spark, sf):
    return metrics.best_and_worst(metrics.yearly(energy(spark, sf)), ["park_id"], "year")


@query(f"""SELECT park_id, arg_min(kwh, year) AS first_kwh, arg_max(kwh, year) AS last_kwh, {s32("(arg_max(kwh, year) / arg_min(kwh, year) - 1) * 100")} AS change_pct
 FROM (SELECT park_id, year(day) AS year, sum(kwh) AS kwh FROM ({ENERGY}) GROUP BY 1, 2) GROUP BY 1""")
def overall_growth(spark, sf):
    out = metrics.overall_change(metrics.yearly(energy(spark, sf)), ["park_id"], "year")
    return out.withColumn("change_pct", f32("change_pct"))


@query(f"""SELECT park_id, year::INT AS year, kwh, {s32("(kwh / lag(kwh) OVER (PARTITION BY park_id ORDER BY year) - 1) * 100")} AS growth_pct
 FROM (SELECT park_id, year(day) AS year, sum(kwh) AS kwh FROM ({ENERGY}) GROUP BY 1, 2)""")
def yoy_growth(spark, sf):
    return metrics.yearly(energy(spark, sf)).withColumn("growth_pct", f32(metrics.growth_percent("kwh", ["park_id"], "year")))


@query(f"SELECT park_id, period::VARCHAR AS period, sum(kwh) OVER (PARTITION BY park_id ORDER BY period) AS kwh_so_far FROM ({MONTHLY})")
def cumulative_energy(spark, sf):
    return monthly(spark, sf).select("park_id", day_text("period").alias("period"), metrics.cumulative("kwh", ["park_id"], "period").alias("kwh_so_far"))


@query(f"""SELECT park_id, period::VARCHAR AS period, CASE WHEN n = 3 THEN {s32("m")} END AS mean3, CASE WHEN n = 3 THEN {s32("s")} END AS std3
 FROM (SELECT park_id, period, count(kwh) OVER w AS n, avg(kwh) OVER w AS m, stddev_samp(kwh) OVER w AS s FROM ({MONTHLY}) WINDOW w AS (PARTITION BY park_id ORDER BY period ROWS 2 PRECEDING))""")
def rolling3_mean_std(spark, sf):
    w = W.partitionBy("park_id").orderBy("period").rowsBetween(-2, 0)
    full = lambda c: F.when(F.count("kwh").over(w) == 3, f32(c.over(w)))
    return monthly(spark, sf).select("park_id", day_text("period").alias("period"), full(F.avg("kwh")).alias("mean3"), full(F.stddev_samp("kwh")).alias("std3"))


@query(f"""SELECT park_id, day::VARCHAR AS day, {s32("avg(kwh) OVER (PARTITION BY park_id ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)")} AS ma7,
 CASE WHEN count(kwh) OVER w >= 10 THEN {s32("avg(kwh) OVER w")} END AS smooth21
 FROM ({ENERGY}) WINDOW w AS (PARTITION BY park_id ORDER BY day ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING)""")
def centered_averages(spark, sf):
    ma = metrics.moving_average
    return energy(spark, sf).select("park_id", day_text("day").alias("day"), f32(ma("kwh", ["park_id"], "day", 3, 3)).alias("ma7"), f32(ma("kwh", ["park_id"], "day", 10, 10, 10)).alias("smooth21"))


@query(f"""SELECT park_id, count(kwh) AS n, {s32("avg(kwh)")} AS mean, median(kwh) AS median, {s32("stddev_samp(kwh)")} AS std, min(kwh) AS least, max(kwh) AS most,
 {s32("stddev_samp(kwh) / avg(kwh) * 100")} AS cv_pct FROM ({ENERGY}) GROUP BY 1""")
def summary_stats(spark, sf):
    out = metrics.summary(energy(spark, sf), ["park_id"])
    return out.withColumns({c: f32(c) for c in ("mean", "std", "cv_pct")})


@query(f"""SELECT park_id, year::INT AS year, (CASE WHEN r >= 1.1 THEN 3 WHEN r >= 1.0 THEN 2 WHEN r >= 0.9 THEN 1 ELSE 0 END)::INT AS band
 FROM (SELECT park_id, year, kwh / avg(kwh) OVER (PARTITION BY park_id) AS r FROM (SELECT park_id, year(day) AS year, sum(kwh) AS kwh FROM ({ENERGY}) GROUP BY 1, 2))""")
def average_bands(spark, sf):
    return metrics.yearly(energy(spark, sf)).select("park_id", "year", metrics.average_band("kwh", ["park_id"]).alias("band"))


@query(f"""SELECT park_id, {s32("slope")} AS slope, {s32("r2")} AS r2, {s32("slope / m * 100 * 30.44")} AS monthly_pct, {s32("slope / m * 100 * 365.25")} AS annual_pct
 FROM (SELECT park_id, regr_slope(kwh, x) AS slope, regr_r2(kwh, x) AS r2, avg(kwh) AS m FROM (SELECT *, (day - DATE '1970-01-01')::DOUBLE AS x FROM ({ENERGY})) GROUP BY 1)""")
def trend_regression(spark, sf):
    out = metrics.trend(energy(spark, sf), ["park_id"])
    return out.withColumns({c: f32(c) for c in ("slope", "r2", "monthly_pct", "annual_pct")})


@query(f"""WITH m AS ({MONTHLY}), c AS (SELECT park_id, row_number() OVER (PARTITION BY park_id ORDER BY period) AS i, kwh - avg(kwh) OVER (PARTITION BY park_id) AS d, count(*) OVER (PARTITION BY park_id) AS n FROM m),
 v AS (SELECT park_id, sum(d * d) AS v FROM c GROUP BY 1)
 SELECT a.park_id, (b.i - a.i)::INT AS lag, round(sum(a.d * b.d) / any_value(v.v), 6) AS acf FROM c a JOIN c b ON a.park_id = b.park_id AND b.i - a.i BETWEEN 0 AND least(20, a.n // 2) JOIN v ON v.park_id = a.park_id GROUP BY 1, 2""")
def acf(spark, sf):
    rows = decompose.correlations(monthly(spark, sf), ["park_id"], order="period")
    return rows.select("park_id", "lag", F.round("acf", 6).alias("acf"))


@query(f"""WITH RECURSIVE m AS ({MONTHLY}), c AS (SELECT park_id, row_number() OVER (PARTITION BY park_id ORDER BY period) AS i, kwh - avg(kwh) OVER (PARTITION BY park_id) AS d, count(*) OVER (PARTITION BY park_id) AS n FROM m),
 v AS (SELECT park_id, sum(d * d) AS v FROM c GROUP BY 1),
 a AS (SELECT a.park_id, b.i - a.i AS lag, sum(a.d * b.d) / any_value(v.v) AS acf FROM c a JOIN c b ON a.park_id = b.park_id AND b.i - a.i BETWEEN 0 AND least(20, a.n // 2) JOIN v ON v.park_id = a.park_id GROUP BY 1, 2),
 r AS (SELECT park_id, list(acf ORDER BY lag) AS r, max(lag) AS n FROM a GROUP BY 1),
 l AS (SELECT park_id, r, n, 0::BIGINT AS k, []::DOUBLE[] AS phi, 1.0::DOUBLE AS last FROM r UNION ALL
 SELECT park_id, r, n, k + 1, list_append(list_transform(phi, lambda x, i: x - z * phi[len(phi) - i + 1]), z), z FROM
 (SELECT *, (r[k + 2] - CASE WHEN k = 0 THEN 0 ELSE list_dot_product(phi, list_reverse(r[2:k + 1])) END) / (1 - CASE WHEN k = 0 THEN 0 ELSE list_dot_product(phi, r[2:k + 1]) END) AS z FROM l WHERE k < n))
 SELECT park_id, k::INT AS lag, round(last, 6) AS pacf FROM l""")
def pacf(spark, sf):
    rows = decompose.correlations(monthly(spark, sf), ["park_id"], order="period")
    return rows.select("park_id", "lag", F.round("pacf", 6).alias("pacf"))


@query()
def stl_decomposition(spark, sf):
    """Daily energy of each park, days without energy as 0: period 365."""
    days = metrics.periods(energy(spark, sf), "day").withColumnRenamed("period", "day")
    return decompose.decomposed(days, ["park_id"], period=365)


@query()
def stl_degradation(spark, sf):
    """Each park's slope of the trend, scores of the remainder and persistent drops."""
    parts = sizing.checkpointed(stl_decomposition(spark, sf))
    scored = anomaly.robust_score(parts, "remainder", ["park_id"]).withColumn("low", F.col("score") < -3)
    held = anomaly.runs(scored, "low", ["park_id"], "day").groupBy("park_id").agg(F.count_if("low").alias("n_low"), F.count_if(F.col("low") & (F.col("run_length") >= 2)).alias("n_persistent"))
    return metrics.trend(parts, ["park_id"], "trend").join(held, "park_id")


@query(f"SELECT park_id, date_trunc('month', day)::DATE::VARCHAR AS month, median(kwh) AS median FROM ({ENERGY}) GROUP BY 1, 2")
def monthly_medians(spark, sf):
    return metrics.monthly_median(energy(spark, sf), ["park_id"], "kwh").withColumn("month", day_text("month"))


# ---- against a typical year ------------------------------------------------


@query(f"SELECT park_id, m::INT AS month, d::INT AS dom, {s32('expected')} AS expected FROM ({TYPICAL})")
def typical_day(spark, sf):
    return reference_day.typical_day(energy(spark, sf)).withColumn("expected", f32("expected"))


def _aligned(spark, sf, **kw):
    e = energy(spark, sf)
    return reference_day.aligned(e, reference_day.typical_day(e), **kw)


@query(f"SELECT e.park_id, e.day::VARCHAR AS day, {s32('e.kwh / t.expected * 100')} AS pct FROM ({ENERGY}) e LEFT JOIN ({TYPICAL}) t ON t.park_id = e.park_id AND t.m = month(e.day) AND t.d = day(e.day)")
def ratio_calendar_day(spark, sf):
    return _aligned(spark, sf).select("park_id", day_text("day").alias("day"), f32(reference_day.ratio(F.col("kwh"), F.col("expected"))).alias("pct"))


@query(f"SELECT e.park_id, e.day::VARCHAR AS day, {s32('e.kwh / t.expected * 100')} AS pct FROM ({ENERGY}) e LEFT JOIN ({TYPICAL}) t ON t.park_id = e.park_id AND t.m = month(e.day) AND t.d = CASE WHEN month(e.day) = 2 THEN least(28, day(e.day)) ELSE day(e.day) END")
def ratio_ffill_leap_day(spark, sf):
    return _aligned(spark, sf, leap_day="ffill").select("park_id", day_text("day").alias("day"), f32(reference_day.ratio(F.col("kwh"), F.col("expected"))).alias("pct"))


@query(f"""SELECT e.park_id, e.day::VARCHAR AS day, {s32("CASE WHEN t.expected >= 20 AND e.kwh / t.expected * 100 BETWEEN 50 AND 150 THEN e.kwh / t.expected * 100 END")} AS kept,
 {s32("CASE WHEN t.expected >= 20 THEN greatest(50, least(150, e.kwh / t.expected * 100)) END")} AS clipped
 FROM ({ENERGY}) e LEFT JOIN ({TYPICAL}) t ON t.park_id = e.park_id AND t.m = month(e.day) AND t.d = day(e.day)""")
def ratio_clip_range(spark, sf):
    r = lambda clip: f32(reference_day.ratio(F.col("kwh"), F.col("expected"), least=20, keep=(50.0, 150.0), clip=clip))
    return _aligned(spark, sf).select("park_id", day_text("day").alias("day"), r(False).alias("kept"), r(True).alias("clipped"))


@query(f"""SELECT coalesce(a.park_id, b.park_id) AS park_id, coalesce(a.day, b.day)::VARCHAR AS day, a.kwh AS kwh_1996, b.kwh AS kwh_1997
 FROM (SELECT park_id, strftime(day, '%m-%d') AS day, kwh FROM ({ENERGY}) WHERE year(day) = 1996) a
 FULL JOIN (SELECT park_id, strftime(day, '%m-%d') AS day, kwh FROM ({ENERGY}) WHERE year(day) = 1997) b ON a.park_id = b.park_id AND a.day = b.day""")
def ratio_outer_align(spark, sf):
    year = lambda y: energy(spark, sf).filter(F.year("day") == y).select("park_id", F.date_format("day", "MM-dd").alias("day"), F.col("kwh").alias(f"kwh_{y}"))
    return year(1996).join(year(1997), ["park_id", "day"], "full")


@query(f"""SELECT p.park_id, p.day::VARCHAR AS day, {s32("coalesce(s.kwh, 0)")} AS kwh FROM
 (SELECT park_id, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM (SELECT park_id, ts_utc::DATE AS day FROM ({READ}) WHERE signal_name = 'active_power' AND ts_utc IS NOT NULL) GROUP BY 1) p
 LEFT JOIN (SELECT park_id, ts_utc::DATE AS day, sum(value * 1000 / 1000.0) AS kwh FROM ({READ}) WHERE signal_name = 'active_power' AND ts_utc IS NOT NULL GROUP BY 1, 2) s USING (park_id, day)""")
def expected_daily(spark, sf):
    rows = readings(spark, sf).filter((F.col("signal_name") == "active_power") & F.col("ts_utc").isNotNull()).select("park_id", "ts_utc", (F.col("value") * 1000).alias("p_w"))
    return reference_day.daily_from_hourly(rows, "UTC").select("park_id", day_text("day").alias("day"), f32("kwh").alias("kwh"))


# ---- scores and flags ------------------------------------------------------


@query(f"""WITH e AS ({ENERGY}), a AS (SELECT *, CASE WHEN count(kwh) OVER w >= 10 THEN median(kwh) OVER w END AS m FROM e WINDOW w AS (PARTITION BY park_id ORDER BY day ROWS 30 PRECEDING)),
 b AS (SELECT *, abs(kwh - m) AS d FROM a), c AS (SELECT *, CASE WHEN count(d) OVER w >= 10 THEN median(d) OVER w END AS mad FROM b WINDOW w AS (PARTITION BY park_id ORDER BY day ROWS 30 PRECEDING))
 SELECT park_id, day::VARCHAR AS day, {s32("CASE WHEN mad > 0 THEN (kwh - m) / (mad * 1.4826) END")} AS z FROM c""")
def rolling_robust_z(spark, sf):
    return anomaly.rolling_robust_z(energy(spark, sf), "kwh", ["park_id"], "day").select("park_id", day_text("day").alias("day"), f32("z").alias("z"))


_SCORE = f"""SELECT park_id, day, kwh, CASE WHEN mad > 0 THEN (kwh - m) / (mad * 1.4826) ELSE 0 END AS score FROM
 (SELECT park_id, day, kwh, m, median(abs(kwh - m)) OVER (PARTITION BY park_id) AS mad FROM (SELECT *, median(kwh) OVER (PARTITION BY park_id) AS m FROM ({ENERGY})))"""


@query(f"SELECT park_id, day::VARCHAR AS day, {s32('score')} AS score, (CASE WHEN score < -1.5 THEN -1 WHEN score > 1.5 THEN 1 ELSE 0 END)::INT AS flag FROM ({_SCORE})")
def global_robust_score(spark, sf):
    rows = anomaly.robust_score(energy(spark, sf), "kwh", ["park_id"])
    return rows.select("park_id", day_text("day").alias("day"), f32("score").alias("score"), anomaly.tail_flag(F.col("score"), 1.5).alias("flag"))


@query(f"SELECT e.park_id, e.day::VARCHAR AS day, (CASE WHEN e.kwh / t.expected < 0.8 THEN -1 WHEN e.kwh / t.expected > 1.2 THEN 1 ELSE 0 END)::INT AS flag FROM ({ENERGY}) e LEFT JOIN ({TYPICAL}) t ON t.park_id = e.park_id AND t.m = month(e.day) AND t.d = day(e.day)")
def pi_band_flag(spark, sf):
    return _aligned(spark, sf).select("park_id", day_text("day").alias("day"), anomaly.band_flag(F.try_divide("kwh", "expected")).alias("flag"))


@query(f"""WITH s AS (SELECT park_id, day, score < -0.5 AS low FROM ({_SCORE})), c AS (SELECT *, CASE WHEN low IS DISTINCT FROM lag(low) OVER (PARTITION BY park_id ORDER BY day) THEN 1 ELSE 0 END AS ch FROM s),
 r AS (SELECT *, sum(ch) OVER (PARTITION BY park_id ORDER BY day) AS run FROM c), l AS (SELECT *, count(*) OVER (PARTITION BY park_id, run) AS run_length FROM r)
 SELECT park_id, day::VARCHAR AS day, run_length FROM l WHERE low AND run_length >= 3""")
def persistent_islands(spark, sf):
    rows = anomaly.robust_score(energy(spark, sf), "kwh", ["park_id"]).withColumn("low", F.col("score") < -0.5)
    return anomaly.persistent(rows, "low", ["park_id"], "day", 3).select("park_id", day_text("day").alias("day"), "run_length")


# ---- quality ---------------------------------------------------------------


@query(f"SELECT ingest_key, run_id, f_missing AS flag_missing_required, f_value AS flag_invalid_value, f_range AS flag_invalid_unit_range, f_dup AS flag_duplicate FROM ({FLAGGED})")
def flag_quality(spark, sf):
    out = quality.flagged(silver(spark, sf), table(spark, sf, "unit_rules"), ["ts_utc", "park_id", "signal_name"])
    return out.select("ingest_key", "run_id", *quality.FLAGS)


@query(f"SELECT (f_missing OR f_value OR f_range OR f_dup)::BOOLEAN AS invalid, count(*) AS n FROM ({FLAGGED}) GROUP BY 1")
def split_valid_counts(spark, sf):
    good, bad = quality.split(quality.flagged(silver(spark, sf), table(spark, sf, "unit_rules"), ["ts_utc", "park_id", "signal_name"]))
    n = lambda df, v: df.groupBy().agg(F.lit(v).alias("invalid"), F.count("*").alias("n")).filter("n > 0")
    return n(good, False).unionByName(n(bad, True))


@query("SELECT ingest_key, count(*) AS n FROM silver_prepair GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return profile.value_counts(silver(spark, sf), "ingest_key").filter("n > 1")


@query("SELECT ingest_key, max(run_id) AS run_id FROM silver_prepair GROUP BY 1")
def keep_last_per_key(spark, sf):
    rows = silver(spark, sf).select("ingest_key", "run_id", "value", "ts_local")
    return quality.keep_last(rows, ["ingest_key"], ["run_id"]).select("ingest_key", "run_id")


@query("SELECT ingest_key, min(run_id) AS run_id FROM silver_prepair GROUP BY 1")
def dedupe_keep_first(spark, sf):
    rows = silver(spark, sf).select("ingest_key", "run_id", "value", "ts_local")
    return quality.keep_first(rows, ["ingest_key"], ["run_id"]).select("ingest_key", "run_id")


@query("SELECT park_id, signal_name, unit, ts_utc::VARCHAR AS ts, max(run_id) AS run_id FROM silver_prepair WHERE ts_utc IS NOT NULL GROUP BY park_id, signal_name, unit, ts_utc")
def latest_wins(spark, sf):
    rows = silver(spark, sf).filter("ts_utc is not null").select("park_id", "signal_name", "unit", "ts_utc", "run_id", "ingest_key", "value")
    out = quality.keep_last(rows, ["park_id", "signal_name", "unit", "ts_utc"], ["run_id", "ingest_key"])
    stamp = F.date_format("ts_utc", "yyyy-MM-dd HH:mm:ss")
    part = F.date_format("ts_utc", "SSSSSS")
    tail = F.regexp_replace(part, "0+$", "")
    return out.select("park_id", "signal_name", "unit", F.concat(stamp, F.when(tail != "", F.concat(F.lit("."), tail)).otherwise(""), F.lit("+00")).alias("ts"), "run_id")


@query(f"SELECT ingest_key, run_id FROM silver_prepair WHERE run_id >= '{RUN}' AND ingest_key NOT IN (SELECT ingest_key FROM silver_prepair WHERE run_id < '{RUN}' AND ingest_key IS NOT NULL)")
def anti_join_existing(spark, sf):
    s = silver(spark, sf)
    return quality.new_keys(s.filter(F.col("run_id") >= RUN), s.filter(F.col("run_id") < RUN)).select("ingest_key", "run_id")


@query(f"SELECT count(*) AS n_rows, count(*) FILTER ({ANY}) AS n_invalid, round(count(*) FILTER ({ANY}) * 100.0 / count(*), 4)::DOUBLE AS invalid_pct FROM silver_prepair")
def quality_gate(spark, sf):
    return quality.invalid_percent(silver(spark, sf))


@query(f"""WITH v AS (SELECT {UNIT} AS unit, value AS v FROM silver_prepair WHERE {FINITE})
 SELECT r.unit, r.min_allowed, r.max_allowed, count(v) AS n, min(v) AS v_min, max(v) AS v_max, {s32("quantile_cont(v, 0.01)")} AS p01, {s32("quantile_cont(v, 0.5)")} AS p50, {s32("quantile_cont(v, 0.99)")} AS p99,
 count(*) FILTER (v < min_allowed) AS n_low, count(*) FILTER (v > max_allowed) AS n_high, CASE WHEN count(v) = 0 THEN 0 ELSE count(*) FILTER (v < min_allowed OR v > max_allowed)::DOUBLE / count(v) END AS invalid_fraction
 FROM unit_rules r LEFT JOIN v ON v.unit = r.unit GROUP BY 1, 2, 3""")
def unit_benchmarks(spark, sf):
    out = quality.benchmarks(silver(spark, sf), table(spark, sf, "unit_rules"))
    return out.withColumns({c: f32(c) for c in ("p01", "p50", "p99")})


_COLUMNS = [
    "ts_local", "ts_utc", "interval_start_date", "year", "month", "park_id", "park_capacity_kwp", "signal_name", "unit", "value", "source_file", "source_file_hash", "run_id",
    "ingested_at_utc", "ingest_key", "prepared_at_utc", "flag_missing_required", "flag_invalid_value", "flag_invalid_unit_range", "flag_duplicate",
]


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing, round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 4)::DOUBLE AS pct_missing FROM silver_prepair" for c in _COLUMNS) + ") WHERE n_missing > 0")
def missing_values(spark, sf):
    return quality.missing_values(silver(spark, sf).select(*_COLUMNS))


@query(f"""SELECT park_id, signal_name, n, {s32("m")} AS missing_share, {s32("z")} AS zero_share FROM (SELECT park_id, signal_name, count(*) AS n, avg((NOT coalesce({FINITE}, false))::INT) AS m, avg(CASE WHEN {FINITE} THEN (value = 0)::INT END) AS z
 FROM silver_prepair GROUP BY 1, 2) WHERE m >= 0.5 OR z >= 0.8""")
def problematic_columns(spark, sf):
    out = quality.problematic(silver(spark, sf), KEYS)
    return out.withColumns({c: f32(c) for c in ("missing_share", "zero_share")})


@query(f"""WITH r AS ({READ}), q AS (SELECT park_id, signal_name, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM r GROUP BY 1, 2)
 SELECT r.ingest_key, r.value FROM r JOIN q USING (park_id, signal_name) WHERE value < a - 3.0 * (b - a) OR value > b + 3.0 * (b - a)""")
def iqr_outliers(spark, sf):
    return quality.iqr_outliers(readings(spark, sf), KEYS, k=3.0).select("ingest_key", "value")


# ---- selection -------------------------------------------------------------


@query(f"SELECT ingest_key, value FROM silver_prepair WHERE NOT ({ANY})")
def filter_valid(spark, sf):
    return selecting.by_flags(silver(spark, sf)).select("ingest_key", "value")


@query(f"SELECT ingest_key, value FROM silver_prepair WHERE {ANY}")
def filter_flagged(spark, sf):
    return selecting.by_flags(silver(spark, sf), "flagged").select("ingest_key", "value")


@query(f"SELECT ingest_key, interval_start_date::VARCHAR AS day FROM silver_prepair WHERE interval_start_date BETWEEN DATE '{FIRST}' AND DATE '{LAST}'")
def date_range(spark, sf):
    return selecting.day_range(silver(spark, sf), FIRST, LAST).select("ingest_key", day_text("interval_start_date").alias("day"))


@query(f"""SELECT ts_local, park_id, signal_name, unit, value FROM silver_prepair WHERE interval_start_date BETWEEN DATE '{FIRST}' AND DATE '{LAST}' AND NOT ({ANY})
 AND lower(trim(signal_name)) IN ('wind_speed', 'active_power') AND lower(trim(unit)) IN ('kw', 'm_s_1') AND park_capacity_kwp >= 200 AND park_capacity_kwp <= 8000""")
def load_long(spark, sf):
    rows = selecting.load(silver(spark, sf), FIRST, LAST, signals=["Wind_Speed", "active_power "], units=["KW", "m_s_1"], flags="valid", kwp=(200, 8000))
    return rows.select("ts_local", "park_id", "signal_name", "unit", "value")


@query("SELECT ingest_key FROM silver_prepair WHERE regexp_matches(lower(park_id), 'sol|park') AND regexp_matches(lower(signal_name), 'energy') AND lower(trim(unit)) IN ('kwh', 'mwh')")
def filter_by_pattern(spark, sf):
    return silver(spark, sf).filter(selecting.like("park_id", "Sol|Park") & selecting.like("signal_name", "energy") & selecting.one_of("unit", ["kwh", "mwh"])).select("ingest_key")


@query("SELECT ingest_key FROM silver_prepair WHERE interval_start_date >= (SELECT max(interval_start_date) FROM silver_prepair) - 45")
def last_n_days(spark, sf):
    return selecting.last_days(silver(spark, sf), 45).select("ingest_key")


@query("SELECT ingest_key FROM silver_prepair WHERE park_id IN (SELECT park_id FROM park_metadata WHERE latitude > 38)")
def members_semi(spark, sf):
    return selecting.members(silver(spark, sf), table(spark, sf, "park_metadata").filter("latitude > 38")).select("ingest_key")


@query(f"SELECT s.ingest_key, m.park_name, m.capacity_kwp, coalesce(m.latitude, m.nearest_meteo_station_lat) AS latitude, coalesce(m.longitude, m.nearest_meteo_station_lon) AS longitude FROM silver_prepair s LEFT JOIN ({META}) m USING (park_id)")
def enrich_left(spark, sf):
    dim = latest_lines(table(spark, sf, "park_metadata")).select("park_id", "park_name", "capacity_kwp", F.coalesce("latitude", "nearest_meteo_station_lat").alias("latitude"), F.coalesce("longitude", "nearest_meteo_station_lon").alias("longitude"))
    return silver(spark, sf).select("ingest_key", "park_id").join(dim, "park_id", "left").drop("park_id")


_KWP = "CASE WHEN regexp_extract(lower(s.park_id), '(\\d+(?:[.,_]\\d+)?)[\\s_]*(k|m)wp?', 1) <> '' THEN replace(replace(regexp_extract(lower(s.park_id), '(\\d+(?:[.,_]\\d+)?)[\\s_]*(k|m)wp?', 1), ',', '.'), '_', '.')::DOUBLE * CASE regexp_extract(lower(s.park_id), '(\\d+(?:[.,_]\\d+)?)[\\s_]*(k|m)wp?', 2) WHEN 'm' THEN 1000 ELSE 1 END ELSE 100 END"


@query(f"SELECT DISTINCT s.park_id, coalesce(CASE WHEN m.capacity_kwp > 0 THEN m.capacity_kwp END, {_KWP}) AS kwp FROM (SELECT DISTINCT park_id FROM silver_prepair WHERE park_id IS NOT NULL) s LEFT JOIN ({META}) m USING (park_id)")
def capacity_of_parks(spark, sf):
    dim = latest_lines(table(spark, sf, "park_metadata").select("park_id", "line_no", "capacity_kwp"))
    parks = silver(spark, sf).filter("park_id is not null").select("park_id").distinct().join(dim, "park_id", "left")
    return parks.select("park_id", F.coalesce(F.when(F.col("capacity_kwp") > 0, F.col("capacity_kwp")), naming.kwp_in_label(F.col("park_id"), 100.0)).alias("kwp"))


# ---- profiles --------------------------------------------------------------


@query("SELECT count(*) AS n_rows, count(DISTINCT park_id) AS n_parks, count(DISTINCT signal_name) AS n_signals, count(DISTINCT unit) AS n_units, min(interval_start_date)::VARCHAR AS first_day, max(interval_start_date)::VARCHAR AS last_day FROM silver_prepair")
def overview(spark, sf):
    return profile.overview(silver(spark, sf)).withColumns({c: day_text(c) for c in ("first_day", "last_day")})


def _stats(name: str, keys: list[str]) -> None:
    def f(spark, sf):
        out = profile.stats_by(readings(spark, sf), keys)
        return out.withColumns({c: f32(c) for c in ("v_mean", "v_std", "p05", "p50", "p95")})

    f.__name__ = name
    k = ", ".join(keys)
    query(f"SELECT {k}, count(value) AS n, min(value) AS v_min, max(value) AS v_max, {s32('avg(value)')} AS v_mean, {s32('stddev_samp(value)')} AS v_std, {s32('quantile_cont(value, 0.05)')} AS p05, {s32('quantile_cont(value, 0.5)')} AS p50, {s32('quantile_cont(value, 0.95)')} AS p95 FROM ({READ}) GROUP BY {k}")(f)


_stats("stats_by_unit", ["unit"])
_stats("stats_by_signal_unit", ["signal_name", "unit"])
_stats("stats_by_park", ["park_id"])


@query("SELECT park_id, signal_name, min(interval_start_date)::VARCHAR AS first_day, max(interval_start_date)::VARCHAR AS last_day, count(DISTINCT interval_start_date) AS n_days, count(*) AS n_rows FROM silver_prepair GROUP BY 1, 2")
def coverage(spark, sf):
    return profile.coverage(silver(spark, sf)).withColumns({c: day_text(c) for c in ("first_day", "last_day")})


@query("""SELECT p.park_id, p.day::VARCHAR AS day, coalesce(n.n, 0) AS n_rows FROM
 (SELECT park_id, unnest(generate_series(min(interval_start_date), max(interval_start_date), INTERVAL 1 DAY))::DATE AS day FROM silver_prepair WHERE park_id IS NOT NULL GROUP BY 1) p
 LEFT JOIN (SELECT park_id, interval_start_date AS day, count(*) AS n FROM silver_prepair GROUP BY 1, 2) n USING (park_id, day)""")
def coverage_matrix(spark, sf):
    rows = silver(spark, sf).filter("park_id is not null and interval_start_date is not null")
    return profile.coverage_matrix(rows).withColumn("day", day_text("day"))


@query(f"""WITH r AS ({READ}), e AS (SELECT signal_name, min(value) AS lo, max(value) AS hi FROM r GROUP BY 1)
 SELECT signal_name, (least(39, CASE WHEN hi > lo THEN floor((value - lo) / ((hi - lo) / 40)) ELSE 0 END))::INT AS bin, count(*) AS n FROM r JOIN e USING (signal_name) GROUP BY 1, 2""")
def histogram40(spark, sf):
    return profile.histogram(readings(spark, sf), ["signal_name"], "value", 40)


@query(f"SELECT signal_name, min(value) AS v_min, {s32('quantile_cont(value, 0.25)')} AS q1, {s32('median(value)')} AS q2, {s32('quantile_cont(value, 0.75)')} AS q3, max(value) AS v_max FROM ({READ}) GROUP BY 1")
def boxplot(spark, sf):
    out = profile.stats_by(readings(spark, sf), ["signal_name"], quantiles=(0.25, 0.5, 0.75))
    return out.select("signal_name", "v_min", f32("p25").alias("q1"), f32("p50").alias("q2"), f32("p75").alias("q3"), "v_max")


@query("SELECT signal_name, unit, count(*) AS n FROM silver_prepair GROUP BY 1, 2 ORDER BY n DESC, signal_name NULLS FIRST, unit NULLS FIRST LIMIT 20")
def top_pairs(spark, sf):
    return profile.top(silver(spark, sf), 20, "signal_name", "unit")


@query("SELECT park_id, min(park_capacity_kwp) AS capacity_kwp, count(value) AS n_values, count(DISTINCT signal_name) AS n_signals FROM silver_prepair GROUP BY 1")
def parks_summary(spark, sf):
    return profile.by_park(silver(spark, sf))


@query(f"""SELECT park_id, day::VARCHAR AS day, kwh FROM (SELECT *, row_number() OVER (PARTITION BY park_id ORDER BY day) - 1 AS k, greatest(1, count(*) OVER (PARTITION BY park_id) // 100) AS step FROM ({ENERGY})) WHERE k % step = 0""")
def downsample(spark, sf):
    return profile.thinned(energy(spark, sf), ["park_id"], ["day"], 100).select("park_id", day_text("day").alias("day"), "kwh")


# ---- reshaping and names ---------------------------------------------------



def _named(spark, sf) -> tuple[DataFrame, list[str]]:
    """Readings under plain lower-case names, and the names: the pivot's columns."""
    rows = readings(spark, sf).withColumn("signal", F.lower(F.trim("signal_name")))
    return rows, sorted(r[0] for r in rows.select("signal").distinct().collect())


def _pivot_sql(cell: str) -> str:
    return f"PIVOT (SELECT park_id, interval_start_date::VARCHAR AS day, lower(trim(signal_name)) AS signal, value, run_id, ingest_key FROM ({READ})) ON signal USING {cell} GROUP BY park_id, day"


@query(_pivot_sql(s32("avg(value)")))
def to_wide_mean(spark, sf):
    rows, names = _named(spark, sf)
    out = reshape.to_wide(rows, ["park_id", "interval_start_date"], "signal", names)
    return out.select("park_id", day_text("interval_start_date").alias("day"), *[f32(f"`{s}`").alias(s) for s in names])


@query(_pivot_sql("arg_min(value, (run_id, ingest_key, value))"))
def to_wide_first(spark, sf):
    rows, names = _named(spark, sf)
    out = reshape.to_wide(rows, ["park_id", "interval_start_date"], "signal", names, how="first", order=["run_id", "ingest_key"])
    return out.select("park_id", day_text("interval_start_date").alias("day"), *[F.col(f"`{s}`") for s in names])


@query(f"""SELECT day::VARCHAR AS day, 'p' || k AS key, v AS value FROM (SELECT ts::DATE AS day, {', '.join(f"sum(CASE WHEN user_id % 5 = {k} THEN CAST(value AS DECIMAL(18,4)) END)::DOUBLE AS p{k}" for k in range(5))} FROM events GROUP BY 1)
 t, LATERAL (VALUES {', '.join(f'({k}, p{k})' for k in range(5))}) x(k, v) WHERE v IS NOT NULL""")
def pivot_unpivot(spark, sf):
    rows = table(spark, sf, "events").select(F.to_date("ts").alias("day"), F.concat(F.lit("p"), F.col("user_id") % 5).alias("key"), F.col("value").cast("decimal(18,4)").alias("value"))
    wide = rows.groupBy("day").pivot("key", [f"p{k}" for k in range(5)]).agg(F.sum("value").cast("double"))
    return reshape.to_long(wide, ["day"]).select(day_text("day").alias("day"), "key", "value")


@query("SELECT ingest_key, coalesce(park_id, 'none') || '__' || coalesce(signal_name, 'none') || '__' || coalesce(unit, 'none') AS flat_key FROM silver_prepair")
def flatten_key(spark, sf):
    return silver(spark, sf).select("ingest_key", reshape.flat_key("park_id", "signal_name", "unit").alias("flat_key"))


@query("SELECT event_id, (ts::DATE - 1)::VARCHAR AS day, year(ts::DATE - 1)::INT AS year, month(ts::DATE - 1)::INT AS month FROM events")
def interval_start_date(spark, sf):
    day = ingest.interval_day(F.col("ts"))
    return table(spark, sf, "events").select("event_id", day_text(day).alias("day"), F.year(day).alias("year"), F.month(day).alias("month"))


@query("SELECT source_file_hash, sha256(concat_ws('|', coalesce(park_id, '<NA>'), coalesce(strftime(ts_utc AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') || '+00:00', '<NA>'), coalesce(signal_name, '<NA>'), coalesce(unit, '<NA>'), coalesce(source_file_hash, '<NA>'))) AS key FROM silver_prepair")
def ingest_key_sha256(spark, sf):
    key = ingest.key_of(F.col("park_id"), F.col("ts_utc"), F.col("signal_name"), F.col("unit"), F.col("source_file_hash"))
    return silver(spark, sf).select("source_file_hash", key.alias("key"))


@query("""WITH h AS (SELECT DISTINCT park_id || '__' || park_capacity_kwp::INT || '__kwp' AS x, park_id, park_capacity_kwp::INT AS c, signal_name, unit FROM silver_prepair WHERE park_id IS NOT NULL AND park_capacity_kwp IS NOT NULL AND regexp_matches(signal_name, '^[a-z0-9]+(_[a-z0-9]+)*$') AND regexp_matches(unit, '^[a-z0-9]+(_[a-z0-9]+)*$'))
 SELECT DISTINCT park_id || '__' || c || '_kwp__' || signal_name || '__' || unit AS header, park_id, c::DOUBLE AS park_capacity_kwp, signal_name, unit FROM h""")
def header_split(spark, sf):
    plain = "^[a-z0-9]+(_[a-z0-9]+)*$"
    rows = silver(spark, sf).filter(F.col("park_id").isNotNull() & F.col("park_capacity_kwp").isNotNull() & F.col("signal_name").rlike(plain) & F.col("unit").rlike(plain))
    header = F.concat_ws("__", "park_id", F.concat(F.col("park_capacity_kwp").cast("int"), F.lit("_kwp")), "signal_name", "unit")
    return rows.select(header.alias("header")).distinct().withColumns(naming.header_parts(F.col("header")))


@query("SELECT DISTINCT park_id, regexp_replace(regexp_replace(lower(trim(park_id)), '^p_', ''), '_\\d+_?kwp', '', 'g') AS park_key FROM silver_prepair WHERE park_id IS NOT NULL")
def normalize_park_id(spark, sf):
    return silver(spark, sf).filter("park_id is not null").select("park_id", naming.park_key(F.col("park_id")).alias("park_key")).distinct()


@query("SELECT p_partkey, CASE WHEN regexp_matches(s, '^[0-9]') THEN 'p_' || s ELSE s END AS name FROM (SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS s FROM part)")
def snake_case(spark, sf):
    return table(spark, sf, "part").select("p_partkey", naming.snake_case(F.col("p_name")).alias("name"))


@query("SELECT event_id, (props ->> '$.k')::BIGINT AS k FROM events")
def json_props(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


@query("SELECT park_id, value, unit, NULL::VARCHAR AS kind FROM silver_prepair UNION ALL SELECT 'u' || user_id, value, NULL, event_type FROM events")
def union_by_name(spark, sf):
    a = silver(spark, sf).select("park_id", "value", "unit")
    b = table(spark, sf, "events").select(F.concat(F.lit("u"), F.col("user_id")).alias("park_id"), "value", F.col("event_type").alias("kind"))
    return a.unionByName(b, allowMissingColumns=True)


@query(f"SELECT path, min(run_id) AS run_id FROM (SELECT run_id, unnest(files_written) AS path FROM run_log WHERE regexp_matches(run_id, '^\\d{{8}}T\\d{{6}}Z$') AND run_id > '{RUN}') WHERE trim(path) <> '' GROUP BY 1")
def runlog_new_files(spark, sf):
    return files.new_files(table(spark, sf, "run_log"), RUN)


@query("SELECT run_id, sum(rows_long)::BIGINT AS rows_long, sum(len(files_written))::BIGINT AS n_files FROM run_log GROUP BY 1")
def runlog_totals(spark, sf):
    return table(spark, sf, "run_log").groupBy("run_id").agg(F.sum("rows_long").alias("rows_long"), F.sum(F.size("files_written")).cast("bigint").alias("n_files"))


@query("""SELECT (ts::DATE + 1)::VARCHAR || ' 00:00:00' AS ts_local, ts::DATE::VARCHAR AS day, 'u' || (user_id % 10) AS park_id, 100.0::DOUBLE AS park_capacity_kwp, event_type AS signal_name, 'num' AS unit,
 sum(CAST(value AS DECIMAL(18,4)))::DOUBLE AS value FROM events GROUP BY ALL""")
def wide_to_long(spark, sf):
    """A wide export (a column per group of users and event type) and its melt."""
    rows = table(spark, sf, "events")
    header = F.concat(F.lit("u"), F.col("user_id") % 10, F.lit("__100_kwp__"), "event_type", F.lit("__num"))
    types = [r[0] for r in rows.select("event_type").distinct().collect()]
    names = [f"u{k}__100_kwp__{t}__num" for k in range(10) for t in sorted(types)]
    stamp = F.date_add(F.to_date("ts"), 1).cast("string").alias("datetime")
    wide = rows.withColumn("header", header).groupBy(stamp).pivot("header", names)
    long = ingest.wide_to_long(wide.agg(F.sum(F.col("value").cast("decimal(18,4)")).cast("double")))
    return long.select(F.date_format("ts_local", "yyyy-MM-dd HH:mm:ss").alias("ts_local"), day_text("interval_start_date").alias("day"), "park_id", "park_capacity_kwp", "signal_name", "unit", "value")


@query("SELECT event_id, make_date(2001, month(ts)::INT, least(day(ts), day(last_day(make_date(2001, month(ts)::INT, 1))))::INT)::VARCHAR AS day FROM events")
def same_day_in_2001(spark, sf):
    return table(spark, sf, "events").select("event_id", day_text(dates.in_year(F.to_date("ts"), 2001)).alias("day"))


_WORDS = "list_distinct(list_filter(string_split(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '' AND NOT regexp_matches(w, '[0-9]') AND w NOT IN ('kw', 'mw', 'kwp', 'mwp')))"


@query(f"""WITH a AS (SELECT park_id, unnest({_WORDS.format(c='park_id')}) AS word FROM (SELECT DISTINCT park_id FROM silver_prepair WHERE park_id IS NOT NULL)),
 b AS (SELECT park_name, unnest({_WORDS.format(c='park_name')}) AS word FROM (SELECT DISTINCT park_name FROM park_metadata WHERE park_name IS NOT NULL)),
 n AS (SELECT park_id, park_name, count(*) AS n_words FROM a JOIN b USING (word) GROUP BY 1, 2 HAVING count(*) >= 2)
 SELECT park_id, park_name, n_words FROM n QUALIFY row_number() OVER (PARTITION BY park_id ORDER BY n_words DESC, park_name) = 1""")
def word_match(spark, sf):
    return matching.best_overlap(silver(spark, sf), table(spark, sf, "park_metadata"), "park_id", "park_name")


@query(f"SELECT count(value) AS n, {s32('avg(value)')} AS mean, {s32('stddev_samp(value)')} AS std, min(value) AS least, {s32('median(value)')} AS median, max(value) AS most FROM ({READ})")
def describe_values(spark, sf):
    out = metrics.summary(readings(spark, sf), [], "value")
    return out.select("n", f32("mean").alias("mean"), f32("std").alias("std"), "least", f32("median").alias("median"), "most")


@query(f"""WITH e AS (SELECT e.park_id, e.day, e.kwh / t.expected AS pi FROM ({ENERGY}) e LEFT JOIN ({TYPICAL}) t ON t.park_id = e.park_id AND t.m = month(e.day) AND t.d = CASE WHEN month(e.day) = 2 THEN least(28, day(e.day)) ELSE day(e.day) END),
 m AS (SELECT *, median(pi) OVER (PARTITION BY park_id) AS m FROM e), d AS (SELECT *, median(abs(pi - m)) OVER (PARTITION BY park_id) AS mad FROM m)
 SELECT park_id, day::VARCHAR AS day, {s32('pi')} AS pi, round(CASE WHEN mad > 0 THEN (pi - m) / (mad * 1.4826) ELSE 0 END, 6) AS score, (CASE WHEN pi < 0.8 THEN -1 WHEN pi > 1.2 THEN 1 ELSE 0 END)::INT AS flag FROM d""")
def performance_anomaly(spark, sf):
    """Ratio to the typical day, its robust score and its band, in one plan."""
    rows = _aligned(spark, sf, leap_day="ffill").withColumn("pi", F.try_divide("kwh", "expected"))
    out = anomaly.robust_score(rows, "pi", ["park_id"])
    return out.select("park_id", day_text("day").alias("day"), f32("pi").alias("pi"), F.round("score", 6).alias("score"), anomaly.band_flag(F.col("pi")).alias("flag"))


@query(f"SELECT park_id, period::VARCHAR AS period, last_value(CASE WHEN kwh > 600 THEN kwh END IGNORE NULLS) OVER (PARTITION BY park_id ORDER BY period ROWS UNBOUNDED PRECEDING) AS kwh FROM ({MONTHLY})")
def forward_fill(spark, sf):
    rows = monthly(spark, sf).withColumn("kwh", F.when(F.col("kwh") > 600, F.col("kwh")))
    return rows.select("park_id", day_text("period").alias("period"), reference_day.forward_filled("kwh", ["park_id"], "period").alias("kwh"))


@query("SELECT p_partkey, array_to_string(list_transform(string_split(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '_'), lambda w: w[:4]), '_') AS short FROM part")
def abbreviated_names(spark, sf):
    return table(spark, sf, "part").select("p_partkey", naming.abbreviated(naming.snake_case(F.col("p_name"))).alias("short"))


@query("""SELECT strftime(ts::DATE, '%Y-%m-%d 00:00:00') AS at, event_type, count(*) AS n, sum(CAST(value AS DECIMAL(18,4)))::DOUBLE AS total FROM events GROUP BY ts::DATE, event_type""")
def stream_quality_counts(spark, sf):
    from ..streaming.ingest import drain

    return drain(spark, f"{sf}/events.parquet")
