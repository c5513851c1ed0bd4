"""Every query with an SQL oracle against DuckDB, and operators on fixtures."""

import datetime as dt
import json
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from solarloom.functions import naming
from solarloom.operators import anomaly, decompose, ingest, metrics, profile, quality, reference_day, selecting
from solarloom.sources import files
from solarloom.streaming.ingest import ingest_exports

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in os.listdir(SF):
        c.execute(f"CREATE VIEW {t.split('.')[0]} AS FROM '{SF}/{t}'")
    return c


def plain(df):
    cols = sorted(df.columns)
    return cols, sorted(map(str, df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_against_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), duck.execute(entry.oracle_sql()[name]).df()
    for c in want.columns:  # a nullable integer column comes as doubles from one side
        if str(want[c].dtype) == "Int64" and str(got[c].dtype) == "float64":
            got[c] = got[c].astype("Int64")
    assert plain(got) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["ingest_key"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_names(spark):
    h = naming.sanitized_all(["[Alpha Sun 805 KWp] Alpha Sun 805 KWp PCC Active Energy Export (kWh)", "[Beta_0.45MW] Active Power (kW)", "[P] Availability (%)", "Timestamp", "[P] Availability (%)"], {"p": 12.0})
    assert h == ["alpha_sun__805_kwp__pcc_active_energy_export__kwh", "beta__450_kwp__active_power__kw", "p__12_kwp__availability__pct", "datetime", "p__12_kwp__availability__pct_1"]
    assert naming.sanitized_all(["a b", "a-b"]) == ["a_b", "a_b_1"]
    df = spark.createDataFrame([("x_0_45mw_y",), ("sol_97_kwp_z",), ("none",), (None,)], "p string")
    assert [r[0] for r in df.select(naming.kwp_in_label(F.col("p"), 100.0)).collect()] == [450.0, 97.0, 100.0, 100.0]
    assert [r[0] for r in df.select(naming.plain_label(F.col("p"))).collect()][1] == "Sol Z (97 kWp)"
    parts = spark.range(1).select(*[c.alias(k) for k, c in naming.header_parts(F.lit("a_b__97_kwp__active_power")).items()]).first()
    assert tuple(parts) == ("a_b", 97.0, "active_power", None)


def test_parks_in_front_of_signals():
    f = naming.without_park
    assert f(["alphasun", "active", "power"], ["alpha", "sun"]) == ["active", "power"] and f(["alpha", "active", "power"], ["alpha", "sun"]) == ["active", "power"]
    assert f(["al", "phasun", "power"], ["alpha", "sun"]) == ["power"] and f(["alpha"], ["alpha"]) == ["alpha"] and f(["power"], ["alpha"]) == ["power"] and f([], ["a"]) == []
    assert naming.slug(" No time: κ? Spalte É ") == "no_time_spalte_e" and naming.file_name("a/b: c.csv") == "a_b_c.csv" and naming.file_name("///") == "unnamed"


def test_reports_and_listings(spark, silver, tmp_path):
    from solarloom.config import Settings, Workspace
    from solarloom.jobs import unit_report
    from solarloom.operators import composed

    rules = spark.createDataFrame([("pct", 0.0, 1.0)], "unit string, min_allowed double, max_allowed double")
    path = unit_report(silver([{"unit": "pct", "value": 0.5}]), rules, str(tmp_path / "reports"))
    assert path.endswith("unit_report_v001") and json.loads((tmp_path / "reports" / "unit_report_v001.meta.json").read_text())["rules"] == 1
    assert unit_report(silver([{"unit": "pct", "value": 0.5}]), rules, str(tmp_path / "reports")).endswith("_v002")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("1")
    (tmp_path / "in" / "b.csv").write_text("1")
    before = files.listing(spark, str(tmp_path / "in"), "*.csv").collect()
    (tmp_path / "in" / "b.csv").write_text("12")
    after = files.listing(spark, str(tmp_path / "in"), "*.csv")
    assert [r["path"][-5:] for r in files.settled(spark.createDataFrame(before, after.schema), after).collect()] == ["a.csv"]
    with pytest.raises(ValueError):
        composed.unique(spark.createDataFrame([("p",), ("p",)], "park_id string"), "park_id")
    assert selecting.columns_like(silver([]), "^flag_") == list(quality.FLAGS)
    assert Workspace("/data/").dataset("solar")["fact"] == "/data/solar/fact" and "ingest_key" in Settings().required


def test_melt(spark):
    wide = spark.createDataFrame(
        [("2024-01-01 00:00:00", "5", "x"), ("01/03/2024 00:00", None, "2.5"), ("never", "1", "1"), ("2024-02-29 00:00:00", "NaN", "7")],
        "datetime string, a__97_kwp__pcc_active_energy_export__kwh string, `b__10_kwp__breaker_state` string",
    )
    rows = {(r["park_id"], str(r["interval_start_date"]), r["unit"], r["value"]) for r in ingest.wide_to_long(wide).collect()}
    assert rows == {("a", "2023-12-31", "kwh", 5.0), ("b", "2024-02-29", None, 2.5), ("b", "2024-02-28", None, 7.0)}
    with pytest.raises(ValueError):
        ingest.time_column(["a", "b"])


def test_flags_partition_rows(spark, silver):
    base = dict(ts_utc=dt.datetime(2024, 1, 1), park_id="p", signal_name="s", unit="pct", value=0.5, ingest_key="k", run_id="1")
    df = silver([base, base | {"run_id": "2"}, base | {"ingest_key": "b", "value": 2.0}, base | {"ingest_key": "c", "value": float("inf")}, base | {"ingest_key": "d", "park_id": None}, base | {"ingest_key": "e"}, base | {"ingest_key": "f", "unit": None, "value": 9.0}])
    rules = spark.createDataFrame([("pct", 0.0, 1.0)], "unit string, min_allowed double, max_allowed double")
    good, bad = quality.split(quality.flagged(df, rules, ["ts_utc", "park_id", "signal_name"]))
    assert sorted(r["ingest_key"] for r in good.collect()) == ["e", "f"] and bad.count() == 5
    good, _ = quality.split(quality.flagged(df, rules, ["ts_utc", "park_id", "signal_name"], mark_all=False))
    assert sorted((r["ingest_key"], r["run_id"]) for r in good.collect()) == [("e", "1"), ("f", "1"), ("k", "1")]
    assert quality.flagged(silver([]), rules, ["park_id"]).count() == 0


def test_selection(spark, silver):
    rows = [{"park_id": p, "signal_name": "S", "value": 1.0, "interval_start_date": dt.date(2024, m, 1), "year": 2024, "month": m, "ingest_key": f"{p}{m}"} for p in ("A", "b") for m in (1, 2, 3)]
    df = silver(rows)
    keys = lambda d: sorted(r["ingest_key"] for r in d.collect())
    assert keys(selecting.day_range(df, dt.date(2024, 3, 1), dt.date(2024, 2, 1))) == ["A2", "A3", "b2", "b3"]
    assert keys(selecting.day_range(df, end=dt.date(2024, 1, 31))) == ["A1", "b1"]
    assert keys(df.filter(selecting.one_of("park_id", ["a "]))) == ["A1", "A2", "A3"] and keys(df.filter(selecting.one_of("park_id", []))) == [] and len(keys(df.filter(selecting.one_of("park_id", None)))) == 6
    assert keys(selecting.last_days(df, 0)) == ["A3", "b3"]
    assert selecting.columns_of(df, "measurement", "lineage").columns[-1] == "prepared_at_utc"


def test_month_partitions_are_pruned(spark, tmp_path, silver):
    rows = [{"park_id": "p", "value": 1.0, "interval_start_date": dt.date(2024, m, 1), "year": 2024, "month": m} for m in range(1, 13)]
    ingest.append_monthly(silver(rows), str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    part = selecting.day_range(table, dt.date(2024, 5, 1), dt.date(2024, 6, 30))
    assert part.count() == 2
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and len(part.inputFiles()) == 12
    assert files.partitions(table).agg(F.sum("n_files"), F.sum("n_rows")).first()[:] == (12, 12)


def test_calendar(spark):
    days = [("p", dt.date(y, m, d), float(d)) for y in (2019, 2020) for m in (2, 4) for d in range(1, 29)] + [("p", dt.date(2020, 2, 29), 29.0)]
    df = spark.createDataFrame(days, "park_id string, day date, kwh double")
    leap = dt.date(2020, 2, 29)
    assert {r["year"]: r["kwh"] for r in metrics.annual_mtd(df, leap).collect()} == {2019: 406.0, 2020: 435.0}
    assert metrics.annual_mtd(df, leap, lambda c: F.max(c) - F.min(c)).filter("year = 2020").first()["kwh"] == 28.0
    assert [(str(r["period"]), r["kwh"]) for r in metrics.periods(df).orderBy("period").limit(3).collect()] == [("2019-02-01", 406.0), ("2019-03-01", 0.0), ("2019-04-01", 406.0)]
    typical = reference_day.typical_day(df)
    pct = lambda how: {str(r["day"]): r["expected"] for r in reference_day.aligned(df, typical, leap_day=how).collect()}["2020-02-29"]
    assert pct("null") is None and pct("ffill") == 28.0
    assert metrics.current_mtd(df, dt.date(2018, 2, 28)).first()["kwh"] is None


def test_scores(spark):
    df = spark.createDataFrame([("a", i, float(i % 3)) for i in range(30)] + [("a", 30, 50.0), ("b", 0, 1.0), ("b", 1, 1.0), ("b", 2, None)], "k string, i int, v double")
    s = {(r["k"], r["i"]): r["score"] for r in anomaly.robust_score(df, "v", ["k"]).collect()}
    assert s["a", 30] > 30 and s["b", 0] == 0.0 and s["b", 2] is None
    z = {(r["k"], r["i"]): r["z"] for r in anomaly.rolling_robust_z(df, "v", ["k"], "i").collect()}
    assert z["a", 3] is None and z["a", 30] > 30 and z["b", 1] is None
    runs = anomaly.persistent(df.withColumn("f", F.col("v") == 1), "f", ["k"], "i", 2).collect()
    assert {(r["k"], r["i"]) for r in runs} == {("b", 0), ("b", 1)}


def test_decomposition_finds_the_slope(spark):
    rng = np.random.default_rng(0)
    n = 1500
    t = np.arange(n)
    y = 100 - 0.02 * t + 20 * np.sin(2 * np.pi * t / 50) + rng.normal(0, 1, n)
    y[400:403] -= 40
    df = spark.createDataFrame([("p", dt.date(2020, 1, 1) + dt.timedelta(int(i)), float(v)) for i, v in zip(t, y)] + [("q", dt.date(2020, 1, 1), 1.0)], "park_id string, day date, kwh double")
    parts = decompose.decomposed(df, ["park_id"], period=50)
    line = metrics.trend(parts, ["park_id"], "trend").collect()
    assert len(line) == 1 and line[0]["slope"] == pytest.approx(-0.02, abs=0.004)
    low = anomaly.robust_score(parts, "remainder", ["park_id"]).withColumn("low", F.col("score") < -6)
    assert {str(r["day"]) for r in anomaly.persistent(low, "low", ["park_id"], "day", 3).collect()} == {str(dt.date(2020, 1, 1) + dt.timedelta(i)) for i in (400, 401, 402)}
    ar = np.zeros(4000)
    for i in range(1, 4000):
        ar[i] = 0.7 * ar[i - 1] + rng.normal()
    p = decompose.pacf(ar, 5)
    assert p[1] == pytest.approx(0.7, abs=0.05) and np.abs(p[2:]).max() < 0.06


@pytest.mark.parametrize("n, span", [(900, 697), (2500, 367), (300, 367)])
def test_wide_smoothing_is_the_plain_one(n, span):
    rng = np.random.default_rng(n)
    y, w = 1e4 + np.arange(n) + rng.normal(0, 9, n), rng.random(n) * (rng.random(n) > 0.2)
    assert np.allclose(decompose.loess_wide(y, span, w), decompose.loess(y, span, w), atol=1e-6)


@pytest.mark.parametrize("gathered", [50_000, 7])
def test_exact_quantiles(spark, monkeypatch, gathered):
    from solarloom.operators import quantiles

    monkeypatch.setattr(quantiles, "GATHERED", gathered)
    rng = np.random.default_rng(4)
    groups = {"a": rng.normal(0, 1e6, 300), "b": np.array([5.0] * 40 + [6.0]), None: np.r_[-1e-9, 0.0, 1e-9, 1e300, rng.lognormal(0, 3, 60)], "one": np.array([2.5]), "same": np.zeros(30)}
    df = spark.createDataFrame([(k, float(v)) for k, x in groups.items() for v in x] + [("none", None), ("a", None)], "k string, v double")
    qs = (0.0, 0.01, 0.25, 0.5, 0.99, 1.0)
    got = {r["k"]: r for r in quantiles.exact_quantiles(df, ["k"], "v", qs).collect()}
    assert set(got) == set(groups)
    for k, x in groups.items():
        assert got[k]["n"] == len(x) and got[k]["q"] == pytest.approx(np.quantile(x, qs).tolist(), rel=1e-9, abs=1e-12)
    whole = quantiles.exact_quantiles(df, [], "v", (0.5,)).first()
    assert whole["q"][0] == pytest.approx(np.median(np.concatenate(list(groups.values()))))
    assert quantiles.exact_quantiles(df.limit(0), ["k"], "v", qs).count() == 0


def test_every_park_is_decomposed_alone(spark):
    q = entry.queries()
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_suppkey", "l_quantity", F.to_date("l_shipdate").alias("day")).toPandas()
    parts = q["stl_decomposition"](spark, SF).toPandas()
    assert set(parts["park_id"]) == {f"s{k}" for k in lines["l_suppkey"]}
    for park, p in parts.groupby("park_id"):
        own = lines[lines["l_suppkey"] == int(park[1:])]
        days = {}
        for d, kwh in zip(own["day"], own["l_quantity"]):
            days[d] = days.get(d, 0.0) + float(kwh)
        every = [min(days) + dt.timedelta(i) for i in range((max(days) - min(days)).days + 1)]
        y = np.array([days.get(d, 0.0) for d in every])
        p = p.sort_values("day")
        assert list(p["day"]) == every and np.allclose(p["value"], y) and np.allclose(p["trend"], decompose.stl(y, 365)[0])
    rates = q["stl_degradation"](spark, SF).toPandas()
    assert sorted(rates["park_id"]) == sorted(set(parts["park_id"])) and rates[["slope", "r2", "annual_pct", "n_low", "n_persistent"]].notna().all(axis=None)
    one = parts[parts["park_id"] == "s1"]
    x = np.array([d.toordinal() for d in one["day"]])
    assert rates.set_index("park_id").loc["s1", "slope"] == pytest.approx(np.polyfit(x - x.mean(), one["trend"], 1)[0])


def test_profiles(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("a", 5.0), ("b", 3.0), ("b", None)], "k string, v double")
    h = {(r["k"], r["bin"]): r["n"] for r in profile.histogram(df.filter("v is not null"), ["k"], "v", 2).collect()}
    assert h == {("a", 0): 1, ("a", 1): 2, ("b", 0): 1}
    assert {r["k"]: r["n"] for r in profile.stats_by(df, ["k"], "v", count_nulls=True).collect()} == {"a": 3, "b": 2}


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("Timestamp;[P 5 kWp] Active Power (kW)\n2024-01-02 00:00:00;3\n")
    (tmp_path / "in" / "b.txt").write_text("")
    (tmp_path / "in" / "c.pdf").write_text("x")
    (tmp_path / "map.csv").write_text("p__5_kwp__active_power__kw,[P 5 kWp] Active Power (kW)\ndatetime,Timestamp\n")
    found = files.inbox(spark, str(tmp_path / "in")).collect()
    assert [r["path"].rsplit("/", 1)[1] for r in found] == ["a.csv"] and len(found[0]["source_file_hash"]) == 64
    names = {r["original"]: r["sanitized"] for r in files.mapping(spark, str(tmp_path / "map.csv")).collect()}
    wide = files.renamed(files.wide_export(spark, str(tmp_path / "in" / "a.csv"), ";"), names)
    row = ingest.wide_to_long(wide).first()
    assert (row["park_id"], row["value"], row["source_file"]) == ("p", 3.0, "a.csv")
    assert files.export_columns(spark, str(tmp_path / "in" / "a.csv"), ";")[0] == "Timestamp"
    with pytest.raises(ValueError):
        files.wide_export(spark, "a.pdf")
    logs = tmp_path / "logs"
    logs.mkdir()
    for i, x in enumerate([{"run_id": "20240101T000000Z", "files_written": ["a", "b"]}, {"run_id": "20240102T000000Z", "files_written": ["b", "c", " "]}, {"run_id": "odd", "files_written": ["d"]}]):
        (logs / f"{i}.json").write_text(json.dumps(x))
    (logs / "bad.json").write_text("{not json")
    read = files.run_logs(spark, str(logs))
    assert {(r["run_id"], r["path"]) for r in files.new_files(read, None).collect()} == {("20240101T000000Z", "a"), ("20240101T000000Z", "b"), ("20240102T000000Z", "c")}
    assert {r["path"] for r in files.new_files(read, "20240101T000000Z").collect()} == {"b", "c"}


def test_streaming_ingest_is_idempotent(spark, tmp_path):
    inbox, out = tmp_path / "inbox", tmp_path / "out"
    inbox.mkdir()
    columns = ["datetime", "a__97_kwp__availability__pct", "b__10_kwp__pcc_active_energy_export__kwh"]
    rules = spark.createDataFrame([("pct", 0.0, 1.0)], "unit string, min_allowed double, max_allowed double")
    first = ",".join(columns) + "\n2024-01-02 00:00:00,0.5,10\n2024-01-03 00:00:00,7,11\nnever,1,1\n"
    (inbox / "f1.csv").write_text(first)
    step = lambda **kw: ingest_exports(spark, str(inbox), rules, str(out), **kw)
    step()
    n = lambda: (spark.read.parquet(str(out / "fact")).count(), spark.read.parquet(str(out / "quarantine")).count())
    assert n() == (3, 1) and spark.read.parquet(str(out / "unreadable")).count() == 1
    step()
    assert n() == (3, 1)
    # Columns in another order and time texts of another kind; the same content under another name; no time column.
    (inbox / "f2.csv").write_text(",".join([columns[2], columns[0], columns[1]]) + "\n10,2024-02-01T22:00:00Z,0.25\n,02/03/2024 00:00,0.5\n")
    (inbox / "f3.csv").write_text(first)
    (inbox / "f4.csv").write_text("a,b\n1,2\n")
    step()
    fact = spark.read.parquet(str(out / "fact"))
    assert n()[0] == 6 and fact.select("ingest_key").distinct().count() == 6
    got = {(r["park_id"], str(r["interval_start_date"]), r["value"]) for r in fact.filter("source_file = 'f2.csv'").collect()}
    assert got == {("a", "2024-02-01", 0.25), ("b", "2024-02-01", 10.0), ("a", "2024-03-01", 0.5)}
    events = spark.read.parquet(str(out / "registry")).collect()
    assert sorted((r["source_file"].rsplit("/", 1)[1], r["status"]) for r in events) == [("f1.csv", "ingested"), ("f2.csv", "ingested"), ("f3.csv", "skipped_duplicate"), ("f4.csv", "rejected")]
    (inbox / "f5.csv").write_text(first)
    step(allow_duplicates=True)  # the rows are known by their keys all the same
    assert n()[0] == 6 and spark.read.parquet(str(out / "registry")).filter("status = 'ingested'").count() == 3


def test_ingest_instants(spark):
    wide = spark.createDataFrame(
        [("2024-05-01T12:00:00+00:00", "1"), ("2024-03-31 03:30:00", "2"), ("2024-10-27 03:30:00", "3"), ("05/01/2024 12:00:00 PM", "4"), ("13/05/2024 12:00:00", "5"), ("x" * 70, "6"), (None, "7")],
        "datetime string, a__97_kwp__active_power__kw string",
    )
    got = {r["value"]: str(r["ts_utc"]) for r in ingest.wide_to_long(wide).collect()}
    assert got == {1.0: "2024-05-01 12:00:00", 2.0: "2024-03-31 01:00:00", 3.0: "2024-10-27 00:30:00", 4.0: "2024-05-01 09:00:00", 5.0: "2024-05-13 09:00:00"}
    assert ingest.unreadable_rows(wide).count() == 2
    days = spark.createDataFrame([(dt.date(2024, 1, 1), "2024-05-01 00:00:00", None), (None, "2024-05-01 00:00:00", None), (None, "no", dt.datetime(2024, 6, 1, 5))], "interval_start_date date, ts_local string, ts_utc timestamp")
    assert [str(r["interval_start_date"]) for r in ingest.booked_day(days).collect()] == ["2024-01-01", "2024-05-01", "2024-06-01"]


def test_null_keys_go_to_quarantine(spark, silver):
    base = dict(ts_utc=dt.datetime(2024, 1, 1), park_id="p", signal_name="s", unit="pct", value=0.5, run_id="1")
    df = silver([base | {"ingest_key": None}, base | {"ingest_key": None}, base | {"ingest_key": "k"}, base | {"ingest_key": "k"}])
    rules = spark.createDataFrame([("pct", 0.0, 1.0)], "unit string, min_allowed double, max_allowed double")
    good, bad = quality.split(quality.flagged(df, rules, ["ingest_key"], mark_all=False))
    assert [r["ingest_key"] for r in good.collect()] == ["k"] and sorted(r["flag_duplicate"] for r in bad.collect()) == [False, False, True]
    assert quality.new_keys(df, df.limit(0)).count() == 2
    assert quality.new_keys(df, df.withColumn("run_id", F.lit("2")), ("ingest_key", "run_id")).count() == 2


def test_control(spark, tmp_path):
    from solarloom.sinks import control

    r = control.Registry(spark, str(tmp_path / "reg"))
    assert r.rows().count() == 0
    r.append([{"source_file_hash": "a", "status": "ingested", "rows_long": 3}, {"source_file_hash": "b", "status": "rejected"}])
    files_df = spark.createDataFrame([("a",), ("b",), ("c",)], "source_file_hash string")
    assert sorted(x[0] for x in r.unseen(files_df).collect()) == ["b", "c"]
    assert control.Registry(spark, f"file://{tmp_path}/reg").rows().count() == 2 and control.Watermark(f"file://{tmp_path}/no").get() is None
    own = control.new_run_id(dt.datetime(2024, 1, 2, 3, 4, 5), "ab" * 32)
    control.write_run_log(str(tmp_path / "logs"), own, dataset="d", files_written=["x"])
    assert [tuple(r) for r in files.new_files(files.run_logs(spark, str(tmp_path / "logs")), None).select("path", "run_id").collect()] == [("x", own)]
    with control.Lock(spark, str(tmp_path / "lock")):
        with pytest.raises(TimeoutError):
            control.Lock(spark, str(tmp_path / "lock")).__enter__()
    with control.Lock(spark, str(tmp_path / "lock")):
        pass
    maps = control.Mappings(str(tmp_path / "maps"))
    assert maps.current() is None
    path, new = maps.update(["[A 5 kWp] Power (kW)", "Timestamp"], naming.sanitized_all)
    assert new and path.endswith("mapping_v001.csv") and maps.current()[0] == path
    assert maps.update(["Timestamp"], naming.sanitized_all) == (path, False)
    path, new = maps.update(["x, \"y\""], naming.sanitized_all)
    assert new and path.endswith("_v002.csv") and maps.names()["Timestamp"] == "datetime" and maps.names()["x, \"y\""] == "x_y"
    (tmp_path / "maps" / "mapping_v002.csv").write_text("")
    with pytest.raises(ValueError):
        maps.current()
    stage = lambda run: control.write_stage(files_df, str(tmp_path / "stage"), run, keep=2)
    assert [stage(x) for x in ("1", "2", "3")] == [[], [], ["run_id=1"]]
    assert control.reset(str(tmp_path / "stage"), "run_id=2", "run_id=9") == [str(tmp_path / "stage" / "run_id=2")]
    with pytest.raises(ValueError):
        control.reset(str(tmp_path / "stage"), "../logs")
    (tmp_path / "in.csv").write_text("1")
    moved = control.filed(str(tmp_path / "in.csv"), str(tmp_path / "rejected"), dt.date(2024, 1, 2), "ab" * 32, "No time column!")
    assert moved.endswith("rejected/year=2024/month=01/day=02/in__no_time_column_abababab.csv")
    assert control.restored(moved, str(tmp_path / "again")).endswith("again/in.csv")
    w = control.Watermark(str(tmp_path / "w" / "mark"))
    assert w.get() is None and w.commit(["2", "1"]) == "2" and w.commit(["1"]) == "2" and w.get() == "2" and w.commit([]) == "2"
    (tmp_path / "x_v001.md").write_text("")
    (tmp_path / "x_v007.md").write_text("")
    assert control.next_version(str(tmp_path), "x", ".md").endswith("x_v008.md") and control.next_version(str(tmp_path / "no"), "y").endswith("y_v001")
    assert control.beyond_retention(["c", "a", "b"], 1) == ["a", "b"] and control.beyond_retention(["a"], None) == []
    t = spark.createDataFrame([("p", 1.23456789, None)], "a string, b double, c int")
    assert "| p | 1.235 |  |" in control.markdown(t, "T") and "More than 0 rows" in control.markdown(t, "T", 0)
    control.write_with_sidecar(t, str(tmp_path / "rep"), rules=3)
    control.write_with_sidecar(t.limit(0), str(tmp_path / "none"))
    assert json.loads((tmp_path / "rep.meta.json").read_text()) == {"rules": 3} and not (tmp_path / "none").exists()
    assert control.RUN_ID.fullmatch(control.new_run_id(dt.datetime(2024, 1, 2), "ab" * 32))


def test_validation_of_new_runs(spark, silver, tmp_path):
    from solarloom.jobs import validate_new_runs
    from solarloom.sinks.control import Watermark

    base = dict(ts_utc=dt.datetime(2024, 1, 1), park_id="p", signal_name="s", unit="pct", value=0.5, year=2024, month=1)
    rules = spark.createDataFrame([("pct", 0.0, 1.0)], "unit string, min_allowed double, max_allowed double")
    write = lambda name, rows: silver(rows).write.parquet(str(tmp_path / name))
    write("a", [base | {"ingest_key": f"k{i}"} for i in range(9)] + [base | {"ingest_key": "bad", "value": 4.0}])
    write("b", [base | {"ingest_key": "k1"}, base | {"ingest_key": "new"}])
    write("c", [base | {"ingest_key": f"c{i}", "value": 7.0} for i in range(3)])
    log = lambda *runs: spark.createDataFrame([(r, "d", [str(tmp_path / f)]) for r, f in runs], "run_id string, dataset string, files_written array<string>")
    mark, out = Watermark(str(tmp_path / "mark")), str(tmp_path / "out")
    step = lambda logs: validate_new_runs(spark, logs, rules, out, mark)
    first = step(log(("20240101T000000Z", "a")))
    assert (first.rows, first.invalid, first.appended, first.accepted, first.flags["flag_invalid_unit_range"]) == (10, 1, 9, True, 1)
    logs = log(("20240101T000000Z", "a"), ("20240102T000000Z", "b"))
    assert step(logs).appended == 1 and step(logs).runs == 0
    last = step(log(("20240103T000000Z", "c")))
    assert not last.accepted and last.appended == 0 and mark.get() == "20240103T000000Z"
    assert spark.read.parquet(f"{out}/fact").count() == 10 and spark.read.parquet(f"{out}/quarantine").count() == 4


def test_years(spark):
    from solarloom.functions.dates import clamped_years, params_key

    one = spark.range(1).select(params_key(F.struct(F.lit(1).alias("a"))).alias("k"), params_key(F.struct(F.lit(2).alias("a"))).alias("m"), naming.distinct_words(F.lit("sol_Park_sol_x")).alias("w")).first()
    assert len(one["k"]) == 12 and one["k"] != one["m"] and one["w"] == "sol_park_x"

    assert clamped_years(2000, 2030) == (2005, 2023)
    with pytest.raises(ValueError):
        clamped_years(2024, 2030)
