"""Queries of problems 1 to 6 over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gridding, instants, rolling, spikes, units_op, wide
from ..sources.tables import table


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "silver_prepair")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return rolling.idle_windows(_silver(spark, sf))


def p1_rolling(spark: SparkSession, sf: str) -> DataFrame:
    return rolling.rolling_energy(_silver(spark, sf))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return gridding.missing_days(_silver(spark, sf))


def p2_grid(spark: SparkSession, sf: str) -> DataFrame:
    return gridding.regular_series(_silver(spark, sf))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return units_op.rescaled_keys(_silver(spark, sf))


def p3_converted(spark: SparkSession, sf: str) -> DataFrame:
    rows = units_op.converted(_silver(spark, sf))
    return rows.select("ingest_key", "park_id", F.col("interval_start_date").cast("string").alias("interval_day"), F.col("signal").alias("signal_name"), "common", "is_reading")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return spikes.implausible_keys(_silver(spark, sf), table(spark, sf, "park_metadata"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return instants.corrected_instants(_silver(spark, sf), table(spark, sf, "park_metadata"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return wide.contradictions(_silver(spark, sf))


def p6_wide(spark: SparkSession, sf: str) -> DataFrame:
    return wide.wide_days(_silver(spark, sf)).withColumn("contradictory", F.array_join("contradictory", ","))


QUERIES = {f.__name__: f for f in (p1_found, p1_rolling, p2_found, p2_grid, p3_found, p3_converted, p4_found, p5_found, p6_found, p6_wide)}

# The plain name of a signal: without unit text in brackets or after underscores.
_PLAIN = r"""regexp_replace(regexp_replace(regexp_replace(lower(trim(signal_name)), '\s*[\(\[].*$', ''),
 '_{1,2}(kwh|wh|mwh|gwh|mj|gj|kw_m_2|w_m_2|mw_cm2|mw_cm_2|watt|kw|mw|w|m_s_1|km_h|knots|knot|kn|mph|celsius|degc|c|kelvin|k|fahrenheit|degf|f|fraction|percent|permille|pct)$', ''),
 '[^a-z0-9]+', '_', 'g')"""
_READING = f"""SELECT park_id, {_PLAIN} AS signal_name, interval_start_date AS d, value FROM silver_prepair
 WHERE park_id IS NOT NULL AND signal_name IS NOT NULL AND interval_start_date IS NOT NULL AND value IS NOT NULL AND isfinite(value)"""


# Common units for the SQL side, written out on its own: target -> unit text -> factor, offset.
_UNITS = {
    "kwh": {"kwh kw*h": "1, 0", "wh": "0.001, 0", "mwh": "1000, 0", "gwh": "1000000, 0", "mj": "10 / 36.0, 0", "gj": "10000 / 36.0, 0"},
    "kw": {"kw": "1, 0", "w watt": "0.001, 0", "mw": "1000, 0"},
    "w_m_2": {"w_m_2 w/m2 w/m² w*m^-2": "1, 0", "kw_m_2 kw/m2 kw/m² kw*m^-2": "1000, 0", "mw_cm2 mw/cm2 mw/cm²": "10, 0"},
    "m_s_1": {"m_s_1 m/s m*s^-1": "1, 0", "km_h km/h": "10 / 36.0, 0", "knots knot kn": "1852 / 3600.0, 0", "mph": "0.44704, 0"},
    "c": {"c degc °c celsius": "1, 0", "k": "1, -273.15", "f °f degf fahrenheit": "5 / 9.0, -160 / 9.0"},
    "fraction": {"fraction pct p.u.": "1, 0", "percent %": "0.01, 0", "permille": "0.001, 0"},
}
_CONV = ", ".join(f"('{t}', '{u}', {f})" for t, units in _UNITS.items() for us, f in units.items() for u in us.split())
_TAIL = "_{1,2}(kwh|wh|mwh|gwh|mj|gj|kw_m_2|w_m_2|mw_cm2|watt|kw|mw|w|m_s_1|km_h|knots|knot|kn|mph|celsius|degc|c|kelvin|k|fahrenheit|degf|f|fraction|percent|permille|pct)$"
COMMON = rf"""conv(t, u, a, b) AS (VALUES {_CONV}),
n AS (SELECT *, {_PLAIN} AS sig, lower(trim(signal_name)) AS low, regexp_replace(regexp_replace(lower(coalesce(unit, '')), '\s+', '', 'g'), '^u_+', '') AS own FROM silver_prepair),
m AS (SELECT *, replace(CASE WHEN regexp_matches(low, '[\)\]]$') THEN regexp_extract(low, '[\(\[]\s*(.*?)\s*[\)\]]$', 1) ELSE regexp_extract(low, '^(.+?){_TAIL}', 2) END, ' ', '') AS ins,
 CASE WHEN sig LIKE '%energy%' THEN 'kwh' WHEN sig LIKE '%power%' THEN 'kw' WHEN sig LIKE '%irradiance%' THEN 'w_m_2' WHEN sig IN ('availability', 'soiling_ratio') THEN 'fraction' WHEN sig LIKE '%temperature%' THEN 'c' WHEN sig LIKE '%wind_speed%' THEN 'm_s_1' END AS t,
 date_trunc('month', interval_start_date) AS mo FROM n WHERE park_id IS NOT NULL AND sig IS NOT NULL AND interval_start_date IS NOT NULL AND value IS NOT NULL AND isfinite(value)),
l AS (SELECT m.*, CASE WHEN i.a IS NOT NULL THEN value * i.a + i.b WHEN o.a IS NOT NULL THEN value * o.a + o.b ELSE value END AS lab FROM m LEFT JOIN conv i ON i.t = m.t AND i.u = m.ins LEFT JOIN conv o ON o.t = m.t AND o.u = m.own),
k AS (SELECT *, coalesce(max(CASE WHEN park_capacity_kwp > 0 THEN park_capacity_kwp END) OVER (PARTITION BY park_id, sig, run_id, mo), try_cast(regexp_extract(park_id, '_(\d+)_kwp', 1) AS DOUBLE)) AS cap FROM l WHERE value <> 0 AND abs(value) NOT IN (999, 9999, 99999, 999999, 9999999) AND (lab > 0 OR sig = 'active_power')),
g AS (SELECT park_id, sig, run_id, mo, count(*) AS n, log10(CASE WHEN sig = 'active_power' THEN quantile_disc(abs(lab), 0.8) ELSE quantile_disc(abs(lab), 0.5) END) - log10(CASE WHEN sig LIKE 'inverter%energy' THEN 350 WHEN sig LIKE '%energy_export' THEN 2.5 * any_value(cap)
 WHEN sig LIKE '%energy_import' THEN 0.017 * any_value(cap) WHEN sig = 'active_power' THEN 0.4 * any_value(cap) WHEN sig LIKE '%irradiance%' THEN 140 WHEN sig IN ('availability', 'soiling_ratio') THEN 1 END) AS off FROM k GROUP BY 1, 2, 3, 4),
x AS (SELECT *, CASE WHEN sig IN ('availability', 'soiling_ratio') THEN CASE WHEN abs(off - 2) <= 0.85 THEN 2 WHEN abs(off - 3) <= 0.85 THEN 3 END WHEN abs(off - 3) <= 0.85 THEN 3 WHEN abs(off + 3) <= 0.85 AND (sig <> 'active_power' OR n >= 4) THEN -3 END AS e FROM g WHERE abs(off) > 1.5),
c AS (SELECT l.*, lab * CASE e WHEN 2 THEN 0.01 WHEN 3 THEN 0.001 WHEN -3 THEN 1000 ELSE 1 END AS common FROM l LEFT JOIN x USING (park_id, sig, run_id, mo))"""

# Time texts on the SQL side: one format for each layout, offsets a day before and after tell gaps and overlaps.
INSTANTS = r"""z AS (SELECT park_id, coalesce((SELECT any_value(name) FROM pg_timezone_names() WHERE lower(name) = lower(trim(timezone))),
 CASE lower(trim(timezone)) WHEN 'w. europe standard time' THEN 'Europe/Berlin' WHEN 'gtb standard time' THEN 'Europe/Bucharest' ELSE 'Europe/Athens' END) AS zone
 FROM (SELECT * FROM park_metadata WHERE park_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY park_id ORDER BY line_no DESC) = 1)),
r AS (SELECT ingest_key, ts_utc, trim(ts_local) AS x, coalesce(zone, 'Europe/Athens') AS zone FROM silver_prepair LEFT JOIN z USING (park_id) WHERE park_id IS NOT NULL),
w AS (SELECT *, CASE
 WHEN regexp_matches(x, '^\d{13}$') THEN make_timestamp(x::BIGINT * 1000) WHEN regexp_matches(x, '^\d{10}$') THEN make_timestamp(x::BIGINT * 1000000)
 WHEN regexp_matches(x, '^\d{5}(\.\d+)?$') THEN make_timestamp((round((x::DOUBLE - 25569) * 86400000))::BIGINT * 1000)
 WHEN regexp_matches(x, '^\d{4}-\d\d-\d\d') THEN regexp_extract(x, '^(\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d+)?)', 1)::TIMESTAMP
 WHEN regexp_matches(x, '^\d{8}T') THEN strptime(x[:15], '%Y%m%dT%H%M%S') WHEN regexp_matches(x, '^\d\d-[A-Z]') THEN strptime(x, '%d-%b-%Y %H:%M:%S')
 WHEN regexp_matches(x, 'M$') THEN strptime(x, '%m/%d/%Y %I:%M:%S %p')
 WHEN regexp_matches(x, '^\d\d[.]\d\d[.]\d\d ') THEN strptime(x, '%d.%m.%y %H:%M') WHEN regexp_matches(x, '^\d\d[.]') THEN strptime(x, '%d.%m.%Y %H:%M:%S')
 WHEN regexp_matches(x, ':\d\d:\d\d$') THEN strptime(x, '%d/%m/%Y %H:%M:%S')
 ELSE strptime(replace(x, ' 24:', ' 00:'), '%d/%m/%Y %H:%M') + CASE WHEN x LIKE '% 24:%' THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END END AS wall,
 CASE WHEN regexp_matches(x, '^(\d{10}|\d{13})$') OR x LIKE '%Z' OR x LIKE '% WET' THEN 0 WHEN x LIKE '% CET' OR x LIKE '% WEST' THEN 60 WHEN x LIKE '% EET' OR x LIKE '% CEST' THEN 120 WHEN x LIKE '% EEST' THEN 180
 WHEN regexp_matches(x, 'T.*[+]\d\d:?\d\d$') THEN regexp_extract(x, '[+](\d\d):?\d\d$', 1)::INT * 60 + x[-2:]::INT END AS off FROM r),
o AS (SELECT *, date_diff('minute', (wall - INTERVAL 1 DAY)::TIMESTAMP, timezone(zone, timezone('UTC', (wall - INTERVAL 1 DAY)::TIMESTAMP))) AS a, date_diff('minute', (wall + INTERVAL 1 DAY)::TIMESTAMP, timezone(zone, timezone('UTC', (wall + INTERVAL 1 DAY)::TIMESTAMP))) AS b FROM w),
v AS (SELECT *, timezone('UTC', wall - to_minutes(a)) AS ca, timezone('UTC', wall - to_minutes(b)) AS cb FROM o),
t AS (SELECT *, timezone(zone, ca) = wall AS va, timezone(zone, cb) = wall AS vb FROM v),
i AS (SELECT ingest_key, ts_utc, CASE WHEN off IS NOT NULL THEN timezone('UTC', wall - to_minutes(off)) WHEN va THEN ca WHEN vb THEN cb ELSE timezone('UTC', date_trunc('hour', wall) - to_minutes(a)) END AS first_at,
 CASE WHEN off IS NULL AND va AND vb THEN cb END AS other FROM t)"""

_IS_DAILY = "(sig IN ('pcc_active_energy_export', 'pcc_active_energy_import', 'average_irradiance', 'availability', 'soiling_ratio', 'fault_count', 'breaker_state') OR regexp_matches(sig, '^inverter_\\d+_energy$'))"
_DIFFERS = "max(common) - min(common) > 0.001 * greatest(abs(max(common)), abs(min(common)))"

SQL: dict[str, str] = {
    "p1_rolling": f"""WITH {COMMON}, e AS (SELECT park_id, interval_start_date AS d, arg_max(common, (coalesce(run_id, ''), coalesce(ingest_key, ''), common)) AS v FROM c WHERE sig = 'pcc_active_energy_export' GROUP BY 1, 2),
p AS (SELECT park_id, min(d) AS a, max(d) AS z FROM e GROUP BY 1), days AS (SELECT park_id, a, unnest(generate_series(a, z, INTERVAL 1 DAY))::DATE AS d FROM p),
f AS (SELECT days.park_id, a, days.d, coalesce(v, 0) AS v FROM days LEFT JOIN e USING (park_id, d)),
w AS (SELECT park_id, d, 7::INT AS n, round(sum(v) OVER (PARTITION BY park_id ORDER BY d ROWS 6 PRECEDING), 3) AS total, least(7, d - a + 1)::INT AS days_in_period FROM f
 UNION ALL SELECT park_id, d, 30::INT, round(sum(v) OVER (PARTITION BY park_id ORDER BY d ROWS 29 PRECEDING), 3), least(30, d - a + 1)::INT FROM f)
SELECT park_id, strftime(d, '%Y-%m-%d') AS interval_day, n AS period_days, total, days_in_period, total / days_in_period AS daily_average FROM w""",
    "p3_converted": f"""WITH {COMMON}, every AS (SELECT ingest_key, park_id, interval_start_date, sig, common, true AS is_reading FROM c UNION ALL
SELECT ingest_key, park_id, interval_start_date, nullif(regexp_replace(sig, '^_+|_+$', '', 'g'), ''), NULL, false FROM n WHERE park_id IS NULL OR sig IS NULL OR interval_start_date IS NULL OR value IS NULL OR NOT isfinite(value))
SELECT ingest_key, park_id, interval_start_date::VARCHAR AS interval_day, sig AS signal_name, common, is_reading FROM every""",
    "p6_wide": f"""SELECT * REPLACE (fault_count::BIGINT AS fault_count, breaker_state::BIGINT AS breaker_state) FROM (PIVOT (WITH {COMMON},
cells AS (SELECT park_id, strftime(interval_start_date, '%Y-%m-%d') AS interval_day, sig, arg_max(common, (coalesce(run_id, ''), coalesce(ingest_key, ''), common)) AS v, {_DIFFERS} AS differs FROM c WHERE {_IS_DAILY} GROUP BY 1, 2, 3),
marks AS (SELECT park_id, interval_day, coalesce(string_agg(sig, ',' ORDER BY sig) FILTER (differs), '') AS contradictory FROM cells GROUP BY 1, 2)
SELECT park_id, interval_day, contradictory, sig, v FROM cells JOIN marks USING (park_id, interval_day)) ON sig USING first(v) GROUP BY park_id, interval_day, contradictory)""",
    "p1_found": f"""
WITH r AS ({_READING}), e AS (SELECT * FROM r WHERE signal_name = 'pcc_active_energy_export'),
p AS (SELECT park_id, min(d) AS a, max(d) AS z FROM e GROUP BY 1),
days AS (SELECT park_id, a, unnest(generate_series(a, z, INTERVAL 1 DAY))::DATE AS d FROM p),
n AS (SELECT park_id, d, count(*) FILTER (value <> 0) AS n FROM e GROUP BY 1, 2),
f AS (SELECT days.park_id, a, days.d, coalesce(n, 0) AS n FROM days LEFT JOIN n USING (park_id, d)),
w AS (SELECT park_id, a, d, sum(n) OVER (PARTITION BY park_id ORDER BY d ROWS 6 PRECEDING) AS s7, sum(n) OVER (PARTITION BY park_id ORDER BY d ROWS 29 PRECEDING) AS s30 FROM f)
SELECT park_id, strftime(d, '%Y-%m-%d') AS interval_day, 7::INT AS period_days FROM w WHERE s7 = 0 AND d - a >= 6
UNION ALL SELECT park_id, strftime(d, '%Y-%m-%d'), 30::INT FROM w WHERE s30 = 0 AND d - a >= 29""",
    "p2_found": f"""
WITH r AS ({_READING}), p AS (SELECT park_id, signal_name, min(d) AS a, max(d) AS z FROM r GROUP BY 1, 2),
days AS (SELECT park_id, signal_name, unnest(generate_series(a, z, INTERVAL 1 DAY))::DATE AS d FROM p)
SELECT park_id, signal_name, strftime(d, '%Y-%m-%d') AS interval_day FROM days ANTI JOIN r USING (park_id, signal_name, d)""",
    "p3_found": f"WITH {COMMON} SELECT DISTINCT ingest_key FROM c WHERE common <> value",
    "p6_found": f"""WITH {COMMON} SELECT park_id, strftime(interval_start_date, '%Y-%m-%d') AS interval_day, sig AS signal_name FROM c
 WHERE sig IN ('pcc_active_energy_export', 'pcc_active_energy_import', 'average_irradiance', 'availability', 'soiling_ratio', 'fault_count', 'breaker_state') OR regexp_matches(sig, '^inverter_\\d+_energy$')
 GROUP BY 1, 2, 3 HAVING max(common) - min(common) > 0.001 * greatest(abs(max(common)), abs(min(common)))""",
    "p5_found": f"""WITH {INSTANTS} SELECT DISTINCT ingest_key, floor(epoch_us(first_at) / 1000000)::BIGINT AS utc_s FROM i
 WHERE ts_utc IS NULL OR (abs(epoch_us(ts_utc) - epoch_us(first_at)) > 1000000 AND (other IS NULL OR abs(epoch_us(ts_utc) - epoch_us(other)) > 1000000))""",
}
