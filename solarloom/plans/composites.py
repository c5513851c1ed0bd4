"""Composed loaders, reports and the data behind plots, each with its SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import anomaly, composed, ingest, instants, matching, profile, quality, reference_day, reshape, selecting
from ..sources import files
from ..sources.tables import latest_lines, table
from .domain import INSTANTS
from .reference import ANY, ENERGY, FINITE, FLAGGED, META, MONTHLY, READ, TYPICAL, day_text, energy, f32, monthly, query, readings, s32, silver

FIRST, LAST = dt.date(1994, 1, 1), dt.date(1996, 12, 31)

# ---- loaders ---------------------------------------------------------------

_LOCAL = ["active_power", "module_temperature", "wind_speed"]


@query(f"""SELECT park_id, ts_local, {', '.join(f"{s32(f"avg(value) FILTER (lower(trim(signal_name)) = '{s}')")} AS {s}" for s in _LOCAL)} FROM ({READ}) r
 WHERE NOT ({ANY}) AND lower(trim(signal_name)) IN ({', '.join(repr(s) for s in _LOCAL)}) AND park_id IN (SELECT park_id FROM ({META}) WHERE lower(trim(status_effective)) IN ('true', 'yes', '1', 'active')) GROUP BY 1, 2""")
def wide_by_local_time(spark, sf):
    """Valid readings of active parks, one row per park and time text, a column per signal."""
    parks = latest_lines(table(spark, sf, "park_metadata"))
    out = composed.load_wide(readings(spark, sf), parks, _LOCAL, status="status_effective", rows=["park_id", "ts_local"], flags="valid")
    return out.select("park_id", "ts_local", *[f32(s).alias(s) for s in _LOCAL])


@query(f"SELECT park_id, day::VARCHAR AS day, kwh FROM ({ENERGY}) WHERE strftime(day, '%m-%d') >= '11-15' OR strftime(day, '%m-%d') <= '02-10'")
def reference_year_range(spark, sf):
    """Days between 15 November and 10 February of any year, as of a one-year reference."""
    rows = energy(spark, sf).filter(selecting.in_season("day", (11, 15), (2, 10)))
    return rows.select("park_id", day_text("day").alias("day"), "kwh")


@query(f"SELECT park_id, {', '.join(f'{s32(f'avg(expected) FILTER (m = {m})')} AS m{m:02d}' for m in range(1, 13))} FROM ({TYPICAL}) GROUP BY 1")
def typical_wide(spark, sf):
    """Typical days of all parks by month, one column a month."""
    typical = reference_day.typical_day(energy(spark, sf)).withColumn("month", F.format_string("m%02d", "month"))
    months = [f"m{m:02d}" for m in range(1, 13)]
    return reshape.to_wide(typical, ["park_id"], "month", months, value="expected").select("park_id", *[f32(m).alias(m) for m in months])


@query("SELECT path FROM (SELECT DISTINCT unnest(files_written) AS path FROM run_log) WHERE path LIKE '%2024%' ORDER BY path LIMIT 25")
def first_files(spark, sf):
    """The first files of a year, by name (the listing is the feature, hence a limit)."""
    paths = table(spark, sf, "run_log").select(F.explode("files_written").alias("path"))
    return files.first_files(paths, 25, year=2024)


@query("SELECT ingest_key, value, NULL::VARCHAR AS comment FROM silver_prepair")
def select_missing_as_null(spark, sf):
    return selecting.with_columns(silver(spark, sf), {"ingest_key": "string", "value": "double", "comment": "string"})


@query("SELECT ingest_key, coalesce(interval_start_date, ts_utc::DATE)::VARCHAR AS day FROM silver_prepair")
def booked_day(spark, sf):
    rows = silver(spark, sf).select("ingest_key", "interval_start_date", F.lit(None).cast("string").alias("ts_local"), "ts_utc")
    return ingest.booked_day(rows).select("ingest_key", day_text("interval_start_date").alias("day"))


@query(f"SELECT park_id FROM ({META}) WHERE coalesce(latitude, nearest_meteo_station_lat) IS NULL OR coalesce(longitude, nearest_meteo_station_lon) IS NULL OR coalesce(capacity_kwp, 0) <= 0")
def parks_without_place(spark, sf):
    return composed.incomplete_parks(latest_lines(table(spark, sf, "park_metadata")))


@query("SELECT ingest_key FROM silver_prepair WHERE substring(sha256(ingest_key), 1, 2) < '20'")
def hash_sample(spark, sf):
    """An eighth of the keys, told by the key alone: all copies of a row are in or out."""
    return profile.hash_sample(silver(spark, sf), "ingest_key", 1 / 8).select("ingest_key")


@query("SELECT park_id FROM silver_prepair WHERE park_id IS NOT NULL INTERSECT SELECT park_id FROM park_metadata WHERE park_id IS NOT NULL")
def parks_in_both(spark, sf):
    ids = lambda name: table(spark, sf, name).select("park_id").filter("park_id is not null")
    return ids("silver_prepair").intersect(ids("park_metadata"))


@query("SELECT ingest_key, CASE WHEN park_id IN (SELECT park_id FROM park_metadata WHERE park_id IS NOT NULL) THEN park_id END AS park_id FROM silver_prepair")
def known_parks(spark, sf):
    return composed.known_or_null(silver(spark, sf).select("ingest_key", "park_id"), table(spark, sf, "park_metadata"), "park_id")


@query(f"""WITH r AS (SELECT DISTINCT trim(ts_local) AS ingest_key, NULL::TIMESTAMPTZ AS ts_utc, trim(ts_local) AS x, 'Europe/Athens' AS zone FROM silver_prepair WHERE ts_local IS NOT NULL),
{INSTANTS[INSTANTS.index("w AS (") :]} SELECT x AS ts_local, floor(epoch_us(first_at) / 1000000)::BIGINT AS utc_s FROM (SELECT ingest_key AS x, first_at FROM i)""")
def localize_utc(spark, sf):
    """Every time text of the exports as an instant, wall times in one zone: gaps, overlaps, zones of the texts' own."""
    rows = silver(spark, sf).filter("ts_local is not null").select(F.trim("ts_local").alias("ts_local")).distinct()
    at = instants.instant_of(F.col("ts_local")).getField("first_us")
    return rows.select("ts_local", F.floor(at / F.lit(1_000_000)).cast("long").alias("utc_s"))


# ---- quality ---------------------------------------------------------------


@query(f"""SELECT count(*) AS n_rows, count(*) FILTER (f_missing) AS flag_missing_required, count(*) FILTER (f_value) AS flag_invalid_value, count(*) FILTER (f_range) AS flag_invalid_unit_range,
 count(*) FILTER (f_dup) AS flag_duplicate, count(*) FILTER (f_missing OR f_value OR f_range OR f_dup) AS n_flagged FROM ({FLAGGED})""")
def flag_counts(spark, sf):
    return quality.flag_counts(quality.flagged(silver(spark, sf), table(spark, sf, "unit_rules"), ["ts_utc", "park_id", "signal_name"]))


_NUMBERS = ["value", "park_capacity_kwp", "year", "month"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS n, count(DISTINCT {c}) AS n_distinct, {s32(f'avg({c}::DOUBLE)')} AS mean, {s32(f'stddev_samp({c}::DOUBLE)')} AS std, min({c})::DOUBLE AS least, max({c})::DOUBLE AS most FROM ({READ})" for c in _NUMBERS))
def describe_columns(spark, sf):
    out = profile.describe_columns(readings(spark, sf), _NUMBERS)
    return out.withColumns({c: f32(c) for c in ("mean", "std")})


@query(f"""WITH p AS (SELECT signal_name, unit, count(*) AS n FROM ({READ}) WHERE unit IS NOT NULL GROUP BY 1, 2 ORDER BY n DESC, signal_name, unit LIMIT 5),
 k AS (SELECT r.signal_name, r.unit, r.park_id, count(*) AS n_rows, min(value) AS v_min, max(value) AS v_max, {s32('avg(value)')} AS v_mean FROM ({READ}) r JOIN p ON p.signal_name = r.signal_name AND p.unit = r.unit GROUP BY 1, 2, 3)
 SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY signal_name, unit ORDER BY n_rows DESC, park_id) <= 10""")
def focus_pairs(spark, sf):
    """The most frequent signals and units, each with its ten busiest parks (reports of top items)."""
    return composed.focus(readings(spark, sf).filter("unit is not null"), 5, 10).withColumn("v_mean", f32("v_mean"))


@query(f"""SELECT 'rows' AS item, count(*)::DOUBLE AS amount FROM silver_prepair UNION ALL SELECT 'parks', count(DISTINCT park_id) FROM silver_prepair UNION ALL SELECT 'signals', count(DISTINCT signal_name) FROM silver_prepair
 UNION ALL SELECT 'runs', count(DISTINCT run_id) FROM silver_prepair UNION ALL SELECT 'months', count(DISTINCT (year, month)) FROM silver_prepair WHERE year IS NOT NULL AND month IS NOT NULL
 UNION ALL SELECT 'invalid values', count(*) FROM silver_prepair WHERE NOT coalesce({FINITE}, false) UNION ALL SELECT 'null cells', sum({' + '.join(f'({c} IS NULL)::INT' for c in ('park_id', 'signal_name', 'unit', 'value', 'ts_utc', 'interval_start_date'))}) FROM silver_prepair""")
def inspection(spark, sf):
    return composed.inspection(silver(spark, sf), ["park_id", "signal_name", "unit", "value", "ts_utc", "interval_start_date"])


# ---- reports and plots -----------------------------------------------------


@query(f"""WITH e AS ({ENERGY}), y AS (SELECT park_id, year(day) AS year, sum(kwh) AS kwh FROM e GROUP BY 1, 2), t AS (SELECT park_id, max(day) AS last FROM e GROUP BY 1)
 SELECT park_id, 'total' AS section, NULL::VARCHAR AS at, sum(kwh) AS kwh FROM y GROUP BY 1
 UNION ALL SELECT park_id, 'best year', arg_max(year, (kwh, -year))::VARCHAR, max(kwh) FROM y GROUP BY 1
 UNION ALL SELECT park_id, 'worst year', arg_min(year, (kwh, year))::VARCHAR, min(kwh) FROM y GROUP BY 1
 UNION ALL SELECT park_id, 'change %', NULL, {s32('(arg_max(kwh, year) / arg_min(kwh, year) - 1) * 100')} FROM y GROUP BY 1
 UNION ALL SELECT e.park_id, 'last 7 days', any_value(last)::VARCHAR, sum(kwh) FROM e JOIN t ON t.park_id = e.park_id AND e.day > t.last - 7 GROUP BY 1""")
def technical_report(spark, sf):
    out = composed.technical_report(energy(spark, sf))
    return out.withColumn("kwh", F.when(F.col("section") == "change %", f32("kwh")).otherwise(F.col("kwh")))


_MONTHS = ", ".join(f"sum(kwh) FILTER (month(day) = {m}) AS m{m:02d}" for m in range(1, 13))


@query(f"SELECT park_id, year(day)::INT AS year, {_MONTHS} FROM ({ENERGY}) GROUP BY 1, 2")
def heatmap_frame(spark, sf):
    """Energy by year and month, a column a month: the data behind a heat map."""
    return composed.heatmap(energy(spark, sf))


@query(f"""WITH w AS (SELECT park_id, day, kwh, CASE WHEN count(kwh) OVER w >= 10 THEN {s32('avg(kwh) OVER w')} END AS smooth, row_number() OVER (PARTITION BY park_id ORDER BY day) - 1 AS k, greatest(1, count(*) OVER (PARTITION BY park_id) // 200) AS step
 FROM ({ENERGY}) WHERE day BETWEEN DATE '1994-01-01' AND DATE '1996-12-31' WINDOW w AS (PARTITION BY park_id ORDER BY day ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING)) SELECT park_id, day::VARCHAR AS day, kwh, smooth FROM w WHERE k % step = 0""")
def line_frame(spark, sf):
    """A range of days, smoothed and thinned: the data behind a line per park."""
    out = composed.lines(energy(spark, sf), FIRST, LAST, 200)
    return out.select("park_id", day_text("day").alias("day"), "kwh", f32("smooth").alias("smooth"))


@query(f"""WITH m AS ({MONTHLY}), g AS (SELECT 'monthly' AS panel, park_id, period::VARCHAR AS at, kwh AS amount FROM m
 UNION ALL SELECT 'cumulative', park_id, period::VARCHAR, sum(kwh) OVER (PARTITION BY park_id ORDER BY period) FROM m
 UNION ALL SELECT 'yearly', park_id, year(day)::VARCHAR, sum(kwh) FROM ({ENERGY}) GROUP BY 2, 3
 UNION ALL SELECT 'season', park_id, month(day)::VARCHAR, sum(kwh) FROM ({ENERGY}) GROUP BY 2, 3
 UNION ALL SELECT 'mean of 3 months', park_id, period::VARCHAR, CASE WHEN count(kwh) OVER w = 3 THEN {s32('avg(kwh) OVER w')} END FROM m WINDOW w AS (PARTITION BY park_id ORDER BY period ROWS 2 PRECEDING)) SELECT * FROM g""")
def energy_dashboard(spark, sf):
    out = composed.dashboard(energy(spark, sf), monthly(spark, sf))
    return out.withColumn("amount", F.when(F.col("panel") == "mean of 3 months", f32("amount")).otherwise(F.col("amount")))


@query(f"""WITH e AS ({ENERGY}), x AS (SELECT a.park_id, a.day, a.kwh / b.kwh AS pi FROM e a LEFT JOIN e b ON b.park_id = a.park_id AND b.day = make_date((1992 + (year(a.day) - 1992) % 3)::INT, month(a.day)::INT, least(day(a.day), day(last_day(make_date((1992 + (year(a.day) - 1992) % 3)::INT, month(a.day)::INT, 1))))::INT)),
 m AS (SELECT *, CASE WHEN count(pi) OVER w >= 10 THEN median(pi) OVER w END AS m FROM x WINDOW w AS (PARTITION BY park_id ORDER BY day ROWS 30 PRECEDING)), d AS (SELECT *, abs(pi - m) AS d FROM m),
 s AS (SELECT *, CASE WHEN count(d) OVER w >= 10 THEN median(d) OVER w END AS mad FROM d WINDOW w AS (PARTITION BY park_id ORDER BY day ROWS 30 PRECEDING))
 SELECT park_id, day::VARCHAR AS day, {s32('pi')} AS pi, round(CASE WHEN mad > 0 THEN (pi - m) / (mad * 1.4826) END, 5) AS score, (CASE WHEN pi < 0.8 THEN -1 WHEN pi > 1.2 THEN 1 ELSE 0 END)::INT AS flag FROM s""")
def rolling_performance(spark, sf):
    """Ratio to the same day of a reference year (years repeat in turn), with its trailing score and band."""
    rows = composed.against_years(energy(spark, sf), energy(spark, sf), 1992, 1994)
    out = anomaly.rolling_robust_z(rows, "pi", ["park_id"], "day")
    return out.select("park_id", day_text("day").alias("day"), f32("pi").alias("pi"), F.round("z", 5).alias("score"), anomaly.band_flag(F.col("pi")).alias("flag"))


@query(f"""WITH h AS (SELECT park_id, ts_utc::DATE AS day, sum(value) AS kwh FROM ({READ}) WHERE signal_name = 'active_power' AND ts_utc IS NOT NULL GROUP BY 1, 2),
 p AS (SELECT park_id, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM h GROUP BY 1), d AS (SELECT p.park_id, p.day, coalesce(kwh, 0) AS kwh FROM p LEFT JOIN h USING (park_id, day))
 SELECT park_id, month(day)::INT AS month, day(day)::INT AS dom, {s32('avg(kwh)')} AS expected FROM d WHERE NOT (month(day) = 2 AND day(day) = 29) GROUP BY 1, 2, 3""")
def typical_year_of_parks(spark, sf):
    """Hourly power to daily energy to the typical year, of all parks at once."""
    rows = readings(spark, sf).filter((F.col("signal_name") == "active_power") & F.col("ts_utc").isNotNull()).select("park_id", "ts_utc", (F.col("value") * 1000).alias("p_w"))
    return reference_day.typical_day(reference_day.daily_from_hourly(rows, "UTC")).withColumn("expected", f32("expected"))


# ---- matching --------------------------------------------------------------

_PLAINNAME = "regexp_replace(lower({c}), '[^a-z0-9]+', '', 'g')"


@query(f"""WITH a AS (SELECT DISTINCT regexp_replace(park_id, '_\\d+_kwp', '') AS name, max(park_capacity_kwp) AS kwp FROM silver_prepair WHERE park_id IS NOT NULL GROUP BY 1),
 b AS (SELECT DISTINCT park_id, {_PLAINNAME.format(c='park_name')} AS k, capacity_kwp FROM ({META}) WHERE park_name IS NOT NULL),
 l AS (SELECT name, {_PLAINNAME.format(c='name')} AS k, kwp FROM a),
 m AS (SELECT name, park_id, 1 AS rank FROM l JOIN b USING (k) WHERE k <> '' UNION ALL SELECT name, park_id, 2 FROM l JOIN b ON abs(kwp - capacity_kwp) <= 0.1
 UNION ALL SELECT name, park_id, 3 FROM l JOIN b ON length(l.k) >= 3 AND length(b.k) >= 3 AND (contains(l.k, b.k) OR contains(b.k, l.k)))
 SELECT name, park_id, rank::INT AS rank FROM m QUALIFY row_number() OVER (PARTITION BY name ORDER BY rank, park_id) = 1""")
def park_lookup(spark, sf):
    """Park of a name: the same plain name, else the same capacity, else one name inside the other."""
    left = silver(spark, sf).filter("park_id is not null").groupBy(F.regexp_replace("park_id", r"_\d+_kwp", "").alias("name")).agg(F.max("park_capacity_kwp").alias("kwp"))
    right = latest_lines(table(spark, sf, "park_metadata")).select("park_id", "park_name", "capacity_kwp")
    return matching.lookup(left, right)
