import datetime as dt
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from solarloom.functions.units import EDGES, conversion_rows, conversions, split_signal
from solarloom.operators import readings, units_op

DAY = dt.date(2024, 5, 1)


def test_paths_close():
    c = conversions()
    assert c["gj", "kwh"] == (Fraction(10000, 36), 0) and c["f", "c"] == (Fraction(5, 9), Fraction(-160, 9))
    assert c["kwh", "gj"][0] * c["gj", "kwh"][0] == 1
    with pytest.raises(ValueError):
        conversions((*EDGES, ("gj", "kwh", 277, 0)))
    rows = {(u, t): (a, b) for u, t, a, b in conversion_rows()}
    assert rows["km/h", "m_s_1"] == (1 / 3.6, 0.0) and rows["mw/cm2", "w_m_2"] == (10.0, 0.0) and len(rows) == len(conversion_rows())


@pytest.mark.parametrize(
    "name, plain, unit",
    [
        ("active_power (watt)", "active_power", "watt"), ("Pcc Active Energy Export [kwh]", "pcc_active_energy_export", "kwh"),
        ("wind_speed_m_s_1", "wind_speed", "m_s_1"), ("average_irradiance__kw_m_2", "average_irradiance", "kw_m_2"), ("inverter_000012_energy_gwh", "inverter_000012_energy", "gwh"),
        ("fault_count", "fault_count", ""), ("Average Irradiance [kW/m²]", "average_irradiance", "kw/m²"), ("availability", "availability", ""), ("", None, ""), ("()", None, ""),
    ],
)
def test_names(spark, name, plain, unit):
    a, b = split_signal(F.col("n"))
    assert tuple(spark.createDataFrame([(name,)], "n string").select(a, b).first()) == (plain, unit)


def row(k, value, unit="kwh", signal="pcc_active_energy_export", run="r1", park="p_100_kwp_x", day=DAY, kwp=100.0, **more):
    return {"ingest_key": k, "value": value, "unit": unit, "signal_name": signal, "run_id": run, "park_id": park, "interval_start_date": day, "park_capacity_kwp": kwp} | more


def common(df):
    return {r["ingest_key"]: r["common"] for r in units_op.converted(df).collect()}


def test_labels(silver):
    rows = [
        row("a", 250.0), row("b", 0.25, "MWh"), row("c", 900.0, " MJ "), row("d", 250.0, None), row("e", 250.0, "unknown"), row("f", 0.25, None, "pcc_active_energy_export (MWh)"),
        row("g", 50.0, "°F", "module_temperature"), row("h", 300.15, "K", "module_temperature"), row("i", 36.0, "km/h", "wind_speed"), row("j", 97.0, "%", "availability"), row("k", 970.0, None, "availability__permille"),
        row("l", 0.0, "MWh"), row("m", None, "MWh"), row("n", float("nan"), "MWh"), row("o", float("inf"), "MWh"), row("p", 1.0, "MWh", None), row("q", 1.0, "MWh", park=None), row("r", 1.0, "MWh", day=None), row("s", 3.0, "count", "fault_count"),
    ]
    got = common(silver(rows, extra=("signal", "_a", "common", "target", "_scale")))
    want = {"a": 250, "b": 250, "c": 250, "d": 250, "e": 250, "f": 250, "g": 10, "h": 27, "i": 10, "j": 0.97, "k": 0.97, "l": 0, "s": 3} | dict.fromkeys("mnopqr")
    assert got == {k: v if v is None else pytest.approx(v) for k, v in want.items()}
    assert {r[0] for r in units_op.rescaled_keys(silver(rows)).collect()} == set("bcfghijk")


def test_numbers_overrule_the_label(silver):
    rows = [row(f"a{i}", 250.0 + i, day=DAY + dt.timedelta(i)) for i in range(5)]
    rows += [row(f"b{i}", 250_000.0 + i, run="r2", day=DAY + dt.timedelta(i)) for i in range(5)]
    rows += [row(f"c{i}", 0.25, run="r3", day=DAY + dt.timedelta(i)) for i in range(5)]
    rows += [row("c9", 0.0, run="r3"), row("s", 2500.0, run="r4"), row("e", 9_999_999.0, run="r1"), row("a0", 250.0)]
    rows += [row(f"v{i}", 98.0, "pct", "availability", "r5") for i in range(2)]
    got = common(silver(rows))
    assert all(240 < got[f"{g}{i}"] < 260 for g in "abc" for i in range(5))
    assert got["s"] == 2500.0 and got["e"] == 9_999_999.0 and got["c9"] == 0 and got["v0"] == pytest.approx(0.98)
    found = [r[0] for r in units_op.rescaled_keys(silver(rows)).collect()]
    assert sorted(found) == sorted([f"{g}{i}" for g in "bc" for i in range(5)] + ["v0", "v1"])


def test_lookup_and_in_place_parsing_agree(silver, monkeypatch):
    rows = [row("a", 0.25, "MWh"), row("b", 1.0, None, "wind_speed_knots"), row("c", None, None, None)]
    df = silver(rows)
    want = common(df)
    monkeypatch.setattr(readings, "BROADCAST_ROWS", 0)
    assert common(df) == want


def test_empty(silver):
    assert units_op.converted(silver([])).count() == 0 and units_op.rescaled_keys(silver([])).count() == 0
