"""Problems 1, 2, 4, 5 and 6 against brute force on small tables."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from solarloom.functions.kalman import repeated, stuck
from solarloom.functions.ssa import impute
from solarloom.operators import gridding, instants, rolling, spikes, tiles, wide

D0 = dt.date(2024, 1, 1)
EXPORT = "pcc_active_energy_export"


def day(i):
    return D0 + dt.timedelta(i)


def row(i, value, park="p_100_kwp_x", signal=EXPORT, key=None, run="20240101T000000Z", unit="kwh", **more):
    return {"interval_start_date": day(i), "value": value if value is None else float(value), "park_id": park, "signal_name": signal, "unit": unit, "run_id": run, "park_capacity_kwp": 100.0, "ingest_key": key or f"{park}|{signal}|{i}|{value}|{run}", "ts_local": f"{day(i + 1)} 00:00:00"} | more


def test_idle_windows(silver):
    rng = np.random.default_rng(1)
    rows = []
    for park, n in (("a_100_kwp_x", 200), ("b_100_kwp_x", 40), ("c_100_kwp_x", 3)):
        on = rng.random(n) < 0.08
        on[0] = on[-1] = True
        kept = [i for i in range(n) if on[i] or rng.random() < 0.5 or i in (0, n - 1)]
        rows += [row(i, float(on[i]) * 200, park) for i in kept for _ in range(1 + i % 2)]
    rows += [row(300, 0.0, "d_100_kwp_x"), row(0, float("nan"), "a_100_kwp_x"), row(500, None, "a_100_kwp_x"), row(600, 5.0, None), row(5, 9.0, "a_100_kwp_x", "active_power")]
    got = {tuple(r) for r in rolling.idle_windows(silver(rows, extra=("v", "tile", "day"))).collect()}
    want = set()
    for park in "abcd":
        mine = [r for r in rows if (r["park_id"] or "")[:1] == park and r["signal_name"] == EXPORT and r["value"] is not None and r["value"] == r["value"]]
        days = {(r["interval_start_date"] - D0).days for r in mine}
        busy = {(r["interval_start_date"] - D0).days for r in mine if r["value"] != 0}
        for p in (7, 30):
            for d in range(min(days) + p - 1, max(days) + 1):
                if not busy & set(range(d - p + 1, d + 1)):
                    want.add((f"{park}_100_kwp_x", str(day(d)), p))
    assert got == want and want


def test_rolling_totals(silver):
    rows = [row(0, 100.0), row(1, 300.0, run="1"), row(1, 200.0, run="2"), row(40, 400.0)]
    got = {(r["interval_day"], r["period_days"]): r for r in rolling.rolling_energy(silver(rows)).collect()}
    assert len(got) == 2 * 41
    r = got[str(day(6)), 7]
    assert r["total"] == 300.0 and r["days_in_period"] == 7 and r["daily_average"] == pytest.approx(300 / 7)
    assert got[str(day(1)), 30]["days_in_period"] == 2 and got[str(day(7)), 7]["total"] == 200.0 and got[str(day(20)), 7]["total"] == 0.0


@given(st.lists(st.integers(0, 400), min_size=1, max_size=25, unique=True))
@settings(max_examples=8, deadline=None)
def test_tiles_cover_every_day(spark, days):
    cells = spark.createDataFrame([("k", d, 1.0) for d in days], "k string, day int, v double")
    got = {r["tile"]: set(r["days"]) for r in tiles.packed(cells, ["k"], 50, before=20, after=10).collect()}
    assert set(got) == set(range(min(days) // 50, max(days) // 50 + 1))
    for t, have in got.items():
        assert have == {d for d in days if t * 50 - 20 <= d < t * 50 + 60}


def test_grid(silver):
    rows = [row(i, 200.0 + 10 * np.sin(i / 3), "a_100_kwp_x", s) for s in (EXPORT, "average_irradiance") for i in range(90) if i % 9 and not 30 < i < 37]
    rows += [row(3, 1.0, "b_100_kwp_x"), row(700, 1.0, "b_100_kwp_x"), row(4, 1.0, None), row(4, None, "c_100_kwp_x")]
    out = gridding.regular_series(silver(rows, extra=("points", "filled"))).collect()
    filled = {(r["park_id"], r["signal_name"], r["interval_day"]) for r in out if r["filled"]}
    want = {("a_100_kwp_x", s, str(day(i))) for s in (EXPORT, "average_irradiance") for i in range(1, 89) if not i % 9 or 30 < i < 37}
    want |= {("b_100_kwp_x", EXPORT, str(day(i))) for i in range(4, 700)}
    assert filled == want == {tuple(r) for r in gridding.missing_days(silver(rows)).collect()}
    a = {r["interval_day"]: r["value"] for r in out if r["park_id"][0] == "a" and r["signal_name"] == "average_irradiance"}
    assert all(abs(a[str(day(i))] - 200 - 10 * np.sin(i / 3)) < 3 for i in range(1, 89))


def test_imputation():
    t = np.arange(200.0)
    full = np.stack([np.sin(t / 7), 5 + t / 50 + np.cos(t / 5)])
    holes = full.copy()
    holes[:, 60:66] = holes[:, ::13] = np.nan
    got = impute(holes, np.array([200, 200]), rounds=60)
    assert np.abs(got - full)[np.isnan(holes)].max() < 0.25 and np.array_equal(got[~np.isnan(holes)], full[~np.isnan(holes)])
    alone = impute(np.array([[1.0, np.nan, 1.0], [np.nan] * 3]), np.array([3, 3]))
    assert np.allclose(alone[0], 1) and np.isnan(alone[1]).all()


def rested(x, w=14, rank=3, rounds=4000):
    """One series by plain replacing, until it rests."""
    hole, mean, sd = np.isnan(x), np.nanmean(x), np.nanstd(x)
    y = np.where(hole, 0.0, (x - mean) / sd)
    for _ in range(rounds):
        t = np.lib.stride_tricks.sliding_window_view(y, w)
        v = np.linalg.svd(t, full_matrices=False)[2][:rank].T
        back = t @ v @ v.T
        smooth = np.array([np.fliplr(back).diagonal(w - 1 - i).mean() for i in range(len(y))])
        if np.abs(smooth - y)[hole].max() < 1e-6:
            break
        y = np.where(hole, smooth, y)
    return y * sd + mean


def test_imputation_rests_in_long_gaps(silver):
    rng = np.random.default_rng(3)
    t = np.arange(300.0)
    x = 100 + 30 * np.sin(2 * np.pi * t / 365) + rng.normal(0, 3, (2, 300))
    x[0, 120:150] = x[1, 40:54] = x[1, 200] = np.nan
    got = impute(x, np.array([300, 300]))
    for a, b in zip(got, x):
        assert np.abs(a - rested(b)).max() < 0.01 * np.nanstd(b)
    truth = lambda i: 200 + 100 * np.sin(2 * np.pi * i / 100)
    out = gridding.regular_series(silver([row(i, truth(i)) for i in range(300) if not 110 <= i < 140])).collect()
    value = {r["interval_day"]: r["value"] for r in out if r["filled"]}
    assert set(value) == {str(day(i)) for i in range(110, 140)} and all(abs(value[str(day(i))] - truth(i)) < 5 for i in range(110, 140))


@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 12), st.sampled_from([0.0, 1.0, 2.0])), max_size=40))
@settings(max_examples=100, deadline=None)
def test_stuck_against_brute_force(points):
    rows = sorted(set(points))
    s, t, y = (np.array([r[i] for r in rows]) for i in range(3)) if rows else (np.zeros(0),) * 3
    got = {r for r, f in zip(rows, stuck(s, t, y, 3)) if f}
    want = set()
    for source in (0, 1):
        times = sorted({r[1] for r in rows if r[0] == source})
        for i in range(len(times) - 2):
            for v in (1.0, 2.0):
                run = [(source, times[i + k], v) for k in range(3)]
                if all(x in rows for x in run):
                    want |= set(run)
    assert got == want


def test_other_deliveries_of_a_flagged_reading():
    s, t = np.array([1, 1, 1, 1, 2]), np.array([5, 5, 5, 6, 6])
    y, f = np.array([100.0, 100.05, 120.0, 100.0, 100.0]), np.array([False, True, False, False, False])
    assert repeated(s, t, y, f).tolist() == [True, True, False, False, False] and not len(repeated(s[:0], t[:0], y[:0], f[:0]))


def spike_table():
    rng = np.random.default_rng(3)
    rows, bad = [], set()
    for i in range(120):
        rows.append(row(i, 250.0 * np.exp(rng.normal(0, 0.15)), key=f"e{i}"))
        hour = i % 24
        sun = max(0.0, np.sin((hour - 6) / 12 * np.pi))
        rows.append(row(i // 24 * 3, 60 * sun * (1 + rng.normal(0, 0.05)) if sun else -0.3 * rng.random(), signal="active_power", unit="kw", key=f"p{i}", ts_local=f"{day(i // 24 * 3)} {hour:02d}:10:00"))
        rows.append(row(i, 4 + rng.normal(0, 1), signal="wind_speed", unit="m_s_1", key=f"w{i}", ts_local=f"{day(i)} 12:{i % 60:02d}:00"))
        rows.append(row(i, min(1.0, 0.97 + rng.normal(0, 0.02)), signal="availability", unit="pct", key=f"a{i}"))
    for i, k, v in ((40, "e", 2600.0), (41, "e", -250.0), (50, "w", 60.0), (51, "w", -1.0), (60, "a", 1.7), (61, "a", -0.2), (62, "e", 9_999_999.0)):
        r = next(r for r in rows if r["ingest_key"] == f"{k}{i}")
        r["value"] = float(v)
        bad.add(f"{k}{i}")
    for i in range(80, 86):
        next(r for r in rows if r["ingest_key"] == f"w{i}")["value"] = 3.21
        bad.add(f"w{i}")
    rows.append(row(6, 45.0, signal="active_power", unit="kw", key="night", ts_local=f"{day(6)} 02:30:00"))
    rows.append(row(40, 2600.0, key="again", run="20240901T000000Z"))
    rows.append(row(82, 3.2112, signal="wind_speed", unit="m_s_1", key="altered", run="20240901T000000Z", ts_local=f"{day(82)} 12:22:00"))
    rows += [row(3, 5.0, signal="breaker_state", key="state"), row(3, float("nan"), key="nan"), row(3, 1e9, None, key="nopark"), row(3, 1e9, signal=None, key="noname")]
    return rows, bad | {"night", "again", "altered"}


def test_spikes(silver, meta):
    rows, bad = spike_table()
    got = [r[0] for r in spikes.implausible_keys(silver(rows, extra=("kind", "lag", "y", "t", "tile", "_n")), meta([])).collect()]
    assert sorted(got) == sorted(bad)


def test_spikes_of_a_source_with_many_readings(silver, meta, monkeypatch):
    """Short tiles with halos find what one tile finds."""
    rows, bad = spike_table()
    monkeypatch.setattr(spikes, "TILE_ROWS", 40)
    monkeypatch.setattr(spikes, "ROWS", 50)
    got = {r[0] for r in spikes.implausible_keys(silver(rows), meta([])).collect()}
    assert bad - {"night"} <= got and len(got) <= len(bad) + 3


def test_instants(silver, meta):
    utc = dt.datetime(2024, 5, 1, 9, 0, tzinfo=dt.timezone.utc)
    t = lambda k, text, ts, **more: row(0, 1.0, key=k, ts_local=text, ts_utc=ts, **({"signal": "active_power", "interval_start_date": dt.date(2024, 5, 1)} | more))
    rows = [
        t("right", "2024-05-01 12:00:00", utc), t("close", "2024-05-01 12:00:00", utc + dt.timedelta(seconds=1)), t("null", "2024-05-01 12:00:00", None), t("null", "2024-05-01 12:00:00", None),
        t("hour", "2024-05-01T12:00:00+03:00", utc + dt.timedelta(hours=1)), t("rome", "2024-05-01 12:00:00", utc, park="rome"), t("nopark", "2024-05-01 12:00:00", None, park=None),
        t("bad", "what", None), t("none", None, utc), t("swap", "05/01/2024 12:00:00", None), t("noday", "01/05/2024 12:00:00", None, interval_start_date=None), t("x", "2024-05-01 12:00:00", None, ingest_key=None),
        t("twice0", "2024-10-27 03:30:00", dt.datetime(2024, 10, 27, 0, 30, tzinfo=dt.timezone.utc)), t("twice1", "2024-10-27 03:30:00", dt.datetime(2024, 10, 27, 1, 30, tzinfo=dt.timezone.utc)), t("long", "1" * 4000, None),
    ]
    dim = meta([{"park_id": "rome", "timezone": "Europe/Athens", "line_no": 1}, {"park_id": "rome", "timezone": " europe/ROME", "line_no": 2}, {"park_id": None, "timezone": "UTC", "line_no": 3}])
    got = sorted((r[0] or "", r[1]) for r in instants.corrected_instants(silver(rows, extra=("_zone", "instant")), dim).collect())
    s = int(utc.timestamp())
    assert got == [("", s), ("hour", s), ("noday", s), ("null", s), ("rome", s + 3600), ("swap", s)]


def test_contradictions_and_wide(silver, spark, tmp_path):
    rows = [
        row(0, 200.0, run="1", key="a"), row(0, 200.1, run="2", key="b"), row(1, 200.0, run="1"), row(1, 201.0, run="2"), row(1, 201.0, run="2"), row(2, 0.0), row(2, 0.0, run="3"), row(3, 0.2, unit="MWh"), row(3, 200.0),
        row(0, 2.0, signal="fault_count", unit="num"), row(0, 5.0, signal="active_power", unit="kw"), row(0, 7.0, signal="active_power", unit="kw"), row(4, None), row(4, 1.0, None), row(9, 300.0, run=None), row(9, 100.0, run="1"),
    ]
    df = silver(rows, extra=("version", "low", "n"))
    got = {tuple(r) for r in wide.contradictions(df).collect()}
    assert got == {("p_100_kwp_x", str(day(1)), EXPORT), ("p_100_kwp_x", str(day(9)), EXPORT)}
    w = {r["interval_day"]: r for r in wide.wide_days(df).collect()}
    assert w[str(day(0))]["fault_count"] == 2 and w[str(day(0))][EXPORT] == 200.1 and w[str(day(9))][EXPORT] == 100.0
    assert w[str(day(1))]["contradictory"] == [EXPORT] and w[str(day(0))]["contradictory"] == [] and dict(wide.wide_days(df).dtypes)["fault_count"] == "bigint"
    store = wide.WideStore(spark, str(tmp_path), fanout=2)
    batches = wide.daily_readings(df)
    for run in ("3", "1", "2", "20240101T000000Z"):
        store.upsert(batches.filter(batches.run_id == run))
        store = wide.WideStore(spark, str(tmp_path), fanout=2, levels=store.levels)
    store.upsert(batches.filter(batches.run_id.isNull()))
    cells = lambda c: sorted((str(r["interval_start_date"]), r["signal"], r["version"]["value"], r["low"], r["high"], r["n"]) for r in c.collect())
    assert cells(store.cells()) == cells(wide.delta(batches)) and len(store.levels) > 1


def test_wide_has_columns_at_every_size(silver):
    rows = [row(0, i, signal=f"inverter_{i:06d}_energy", run=f"2024010{1 + i % 3}T000000Z") for i in range(2001)] + [row(0, 2.0, signal="fault_count", unit="num")]
    kinds = dict(wide.wide_days(silver(rows)).dtypes)
    assert len(kinds) == 2005 and "values" not in kinds and kinds["fault_count"] == "bigint" and kinds["inverter_002000_energy"] == "double"


@pytest.mark.parametrize("empty", [True, False])
def test_empty_and_all_null_tables(silver, meta, empty):
    df = silver([] if empty else [{}, {}])
    for out in (rolling.idle_windows(df), rolling.rolling_energy(df), gridding.regular_series(df), gridding.missing_days(df), spikes.implausible_keys(df, meta([])), instants.corrected_instants(df, meta([])), wide.contradictions(df), wide.wide_days(df)):
        assert out.count() == 0


def test_own_noise_is_told_from_innovations():
    rng = np.random.default_rng(8)
    z = rng.normal(0, 1, (3, 400))
    z[1] *= 3
    z[0, ::50] = 40.0  # spikes do not make a source noisy
    mask = np.ones(z.shape, bool)
    mask[2] = False
    from solarloom.functions.kalman import innovation_variance, noise_factors

    f = noise_factors(z, mask)
    assert f[0] == 1.0 and 1.8 < f[1] <= 3.2 and f[2] == 1.0
    v = innovation_variance(np.array([0, 1, 2, 3, 4, 5, 7, 8]), np.array([2.0, 2, 2, 2, 2, 3, 3, 3]), 5)
    assert v[4] == 0 and 0 < v[5] < np.inf and np.isinf(v[[0, 3, 6, 7]]).all()


def test_a_series_is_imputed_alike_whatever_its_neighbours():
    rng = np.random.default_rng(6)
    x = 50 + np.cumsum(rng.normal(0, 1, (40, 120)), axis=1)
    x[rng.random(x.shape) < 0.15] = np.nan
    x[:, 50:65] = np.nan
    lengths = rng.integers(70, 121, 40)
    x[np.arange(120) >= lengths[:, None]] = np.nan
    together = impute(x, lengths)
    for i in (0, 7, 39):
        alone = impute(x[i : i + 1, : lengths[i]], lengths[i : i + 1])[0]
        assert np.allclose(alone, together[i, : lengths[i]], rtol=1e-6, atol=1e-6, equal_nan=True)
