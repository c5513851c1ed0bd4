import datetime as dt
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from solarloom.functions.timeparse import NONE, by_width, compile_mask, shape_masks, to_instants
from solarloom.functions.zones import compiled, resolve_zone, tables_version, zone_table

UTC = dt.timezone.utc


def instants(texts, zone="Europe/Athens", day=None, lag=0):
    days = np.array([NONE if d is None else (d - dt.date(1970, 1, 1)).days for d in (day or [None] * len(texts))])
    return to_instants(pd.Series(texts, dtype=object), days, np.full(len(texts), lag), pd.Series([zone] * len(texts), dtype=object))


def one(text, **kw):
    r = instants([text], **{k: ([v] if k == "day" else v) for k, v in kw.items()}).first_us[0]
    return None if r is pd.NA else dt.datetime.fromtimestamp(r / 1e6, UTC).replace(tzinfo=None)


@pytest.mark.parametrize(
    "text, want",
    [
        ("2024-05-18 10:21:27.237147", "2024-05-18T07:21:27.237147"),
        ("2024-05-18T10:21:27", "2024-05-18T07:21:27"),
        ("18/05/2024 10:21", "2024-05-18T07:21:00"),
        ("18.05.24 10:21", "2024-05-18T07:21:00"),
        ("05/18/2024 10:21:00 PM", "2024-05-18T19:21:00"),
        ("05/18/2024 12:00:00 AM", "2024-05-17T21:00:00"),
        ("18-May-2024 10:21:27", "2024-05-18T07:21:27"),
        ("20240518T102127", "2024-05-18T07:21:27"),
        ("2024-05-18T10:21:27.123Z", "2024-05-18T10:21:27.123"),
        ("2024-05-18T10:21:27+0300", "2024-05-18T07:21:27"),
        ("2024-05-18T10:21:27-03:30", "2024-05-18T13:51:27"),
        ("2024-05-18 10:21:27 CEST", "2024-05-18T08:21:27"),
        ("2024-10-29 00:00:00 CET", "2024-10-28T23:00:00"),
        ("1716027687", "2024-05-18T10:21:27"),
        ("1716027687123", "2024-05-18T10:21:27.123"),
        ("45430", "2024-05-17T21:00:00"),
        ("45449.6063078704", "2024-06-06T11:33:05"),
        ("31/12/2024 24:00", "2024-12-31T22:00:00"),
        (" 2024-05-18 10:21:27 ", "2024-05-18T07:21:27"),
        ("2024-05-18T10:21:27." + "123456789" * 5 + "+03:00", "2024-05-18T07:21:27.123456"),
        ("5/8/2024 1:05 PM", "2024-05-08T10:05:00"),
        ("2024-05-18 10:21:27 EST", "2024-05-18T15:21:27"),
        ("1985-07-01 12:00:00", "1985-07-01T09:00:00"),
        ("2065-07-01 12:00:00", "2065-07-01T09:00:00"),
    ],
)
def test_layouts(text, want):
    assert one(text) == dt.datetime.fromisoformat(want)


@pytest.mark.parametrize("text", [None, "", "  ", "hello", "2024-13-01 00:00:00", "30/02/2024 00:00", "2024-05-18 25:00:00", "2024-05-18 24:01:00", "9" * 5000, "2024-05-18x10:21:27", "2024-05-18 10:21:27 XXXX", "١٢٣"])
def test_no_time(text):
    assert one(text) is None


def test_gap_and_overlap():
    assert one("2025-03-30 03:30:00") == dt.datetime(2025, 3, 30, 1)  # does not exist: the first instant after the gap
    assert one("2025-03-30 04:00:00") == dt.datetime(2025, 3, 30, 1)
    r = instants(["2024-10-27 03:30:00"])
    assert (r.last_us - r.first_us)[0] == 3600 * 10**6
    r = instants(["2024-10-27 04:00:00"])
    assert r.last_us[0] == r.first_us[0]


def test_day_and_month_by_interval():
    assert one("03/04/2024 10:00:00", day=dt.date(2024, 4, 3)) == dt.datetime(2024, 4, 3, 7)
    assert one("03/04/2024 10:00:00", day=dt.date(2024, 3, 4)) == dt.datetime(2024, 3, 4, 8)
    assert one("03/04/2024 00:00:00", day=dt.date(2024, 3, 3), lag=1) == dt.datetime(2024, 3, 3, 22)
    assert one("12/25/2024 10:00:00") == dt.datetime(2024, 12, 25, 8)


def test_texts_of_many_lengths_together():
    texts = ["2024-05-18 10:21:27", None, "2024-05-18T10:21:27." + "0" * 60 + "Z", "x" * 9000, "2024-05-18T10:21:27." + "5" * 200 + "Z"]
    got = instants(texts).first_us
    assert got[0] + 3 * 3600 * 10**6 == got[2] == got[4] - 555_555 and got[1] is pd.NA and got[3] is pd.NA


def test_tables_travel_with_their_version():
    tables = compiled(["Europe/Athens", "Europe/Athens"])
    assert tables.version == tables_version() and len(tables.tables) == 3
    wall = np.array([dt.datetime(y, 7, 1, 12).replace(tzinfo=UTC).timestamp() * 10**6 for y in (1999, 2000, 2024, 1949, 2130)], np.int64)
    first, _ = tables.to_utc("Europe/Athens", wall)
    z = ZoneInfo("Europe/Athens")
    assert first.tolist() == [int(dt.datetime(y, 7, 1, 12, tzinfo=z).timestamp()) * 10**6 for y in (1999, 2000, 2024, 1949, 2130)]


@given(st.datetimes(dt.datetime(1905, 1, 1), dt.datetime(2140, 1, 1)), st.sampled_from(["Europe/Athens", "Europe/Lisbon", "Asia/Nicosia", "UTC", "Etc/GMT-2", "America/St_Johns"]))
@settings(max_examples=60, deadline=None)
def test_wall_times_against_the_library(t, zone):
    t = t.replace(microsecond=0)
    r = instants([t.strftime("%Y-%m-%d %H:%M:%S")], zone)
    z = ZoneInfo(zone)
    fold0, fold1 = (t.replace(tzinfo=z, fold=f).astimezone(UTC) for f in (0, 1))
    exists = fold0.astimezone(z).replace(tzinfo=None) == t
    if exists:
        assert {r.first_us[0], r.last_us[0]} == {int(x.timestamp()) * 10**6 for x in (fold0, fold1)}
    else:
        after = dt.datetime.fromtimestamp(r.first_us[0] / 1e6, UTC)
        before = after - dt.timedelta(seconds=1)
        assert before.astimezone(z).utcoffset() != after.astimezone(z).utcoffset()


@given(st.datetimes(dt.datetime(2000, 1, 1), dt.datetime(2068, 1, 1)))
@settings(max_examples=60, deadline=None)
def test_round_trip_of_layouts(t):
    t = t.replace(microsecond=0)
    texts = [t.strftime(f) for f in ("%Y-%m-%dT%H:%M:%SZ", "%Y%m%dT%H%M%SZ", "%d-%b-%Y %H:%M:%S GMT", "%Y/%m/%d %H:%M:%S+0000", "%d.%m.%Y %H:%M:%S UTC")]
    day = [t.date()] * len(texts)
    got = instants(texts, day=day).first_us
    assert list(got) == [int(t.replace(tzinfo=UTC).timestamp()) * 10**6] * len(texts)


def test_masks_are_compiled_once():
    m = shape_masks(by_width(pd.Series(["2024-05-18 10:21:27 EEST"]))[0][1])[0].decode()
    assert m == "9999-99-99 99:99:99 AAAA" and compile_mask(m) is compile_mask(m)


def test_zones():
    assert resolve_zone(" europe/athens ") == "Europe/Athens"
    assert resolve_zone("GTB Standard Time") == "Europe/Bucharest"
    assert resolve_zone(None) == resolve_zone("") == resolve_zone("nowhere") == "Europe/Athens"
    assert len(zone_table("Etc/GMT-2").starts) == 1 and zone_table("Europe/Athens").offsets[0] == 7200
    assert tables_version()
