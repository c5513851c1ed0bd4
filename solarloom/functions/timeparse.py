"""Time texts of many loggers to one UTC instant.

Method: every text is tokenised into a *shape mask* (digit -> 9, upper-case
letter -> A, lower-case letter -> a, anything else itself).  Each distinct mask
of a batch is mapped to a parser once (and kept for the life of the worker);
the parser is a list of byte ranges, so all texts of one mask are converted by
array arithmetic, and wall times go through compiled zone transition tables.

Results for odd cases: null, empty and unrecognised texts, and texts whose
fields are out of range, give null.  Texts may have any length; those of about
one length are converted together, so a very long one costs only its own bytes.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd

from .zones import ABBREVIATIONS, DEFAULT_ZONE, ZoneTables, compiled, resolve_zone

WIDTH = 48
_MONTHS = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("0") : ord("9") + 1] = ord("9")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("a") : ord("z") + 1] = ord("a")

_DATE = (
    r"(?P<ymd>(?P<y1>9999)(?P<s1>[-/.])(?P<m1>99?)(?P=s1)(?P<d1>99?))|(?P<dmy>(?P<a>99?)(?P<s2>[-/.])(?P<b>99?)(?P=s2)(?P<y2>9999|99))"
    r"|(?P<mon>(?P<d3>99?)[- ](?P<m3>[Aa][Aa]{2})[- ](?P<y3>9999))|(?P<packed>(?P<y4>9999)(?P<m4>99)(?P<d4>99))"
)
_TIME = r"(?P<time>(?P<h>99?):(?P<mi>99)(?::(?P<se>99)(?:[.,](?P<fr>9+))?)?|(?P<h2>99)(?P<mi2>99)(?P<se2>99)?)"
_ZONE = r"(?P<zone>A|(?: A{2,4})|(?: ?[+-]99:?99)|(?: ?[+-]99))?"
_MASK = re.compile(rf"(?:{_DATE})(?:(?P<sep>[ A])(?:{_TIME})(?P<half> ?[Aa]{{2}}(?![Aa]))?{_ZONE})?")
_EPOCH = re.compile(r"9{10}|9{13}|9{16}")
_SERIAL = re.compile(r"9{5}(?:\.9+)?")

# How day and month stand in a text.
FIXED, DAY_FIRST, MONTH_FIRST = 0, 1, 2


@dataclass(frozen=True)
class Parser:
    kind: str  # epoch, serial or fields
    fields: tuple = ()  # (name, first byte, end byte)
    order: int = FIXED


@functools.lru_cache(maxsize=65536)
def compile_mask(mask: str) -> Parser | None:
    """The parser of one shape mask, or None where no layout fits."""
    if _EPOCH.fullmatch(mask):
        return Parser("epoch", (("n", 0, len(mask)),))
    if _SERIAL.fullmatch(mask):
        return Parser("serial", (("day", 0, 5), ("part", 6, max(6, len(mask)))))
    m = _MASK.fullmatch(mask)
    if not m:
        return None
    at = lambda name, *groups: [(name, *m.span(g)) for g in groups if m[g] is not None]
    order = FIXED if not m["dmy"] else MONTH_FIRST if m["half"] else DAY_FIRST
    fields = at("year", "y1", "y2", "y3", "y4") + at("month", "m1", "m4") + at("name", "m3") + at("day", "d1", "d3", "d4") + at("a", "a") + at("b", "b")
    if m["time"]:
        fields += at("sep", "sep") + at("hour", "h", "h2") + at("minute", "mi", "mi2") + at("second", "se", "se2") + at("fraction", "fr")
        if m["half"]:
            fields.append(("half", m.end("half") - 2, m.end("half")))
        if m["zone"]:
            z = m["zone"]
            a = m.start("zone") + len(z) - len(z.lstrip())
            fields.append(("offset" if z.strip()[0] in "+-" else "abbreviation", a, m.end("zone")))
    return Parser("fields", tuple(fields), order)


def shape_masks(texts: np.ndarray) -> np.ndarray:
    """Shape masks of an array of byte strings, vectorised."""
    n, w = len(texts), texts.dtype.itemsize
    return _CLASS[texts.view(np.uint8).reshape(n, w)].reshape(-1).view(f"S{w}")


def _digits(codes: np.ndarray) -> np.ndarray:
    v = np.zeros(len(codes), np.int64)
    for k in range(codes.shape[1]):
        v = v * 10 + (codes[:, k].astype(np.int64) - 48)
    return v


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Days since 1970 of a civil date, and whether the date exists."""
    ok = (m >= 1) & (m <= 12) & (d >= 1) & (y >= 1)
    mm = np.clip(m, 1, 12)
    month0 = (np.clip(y, 1, 9999) - 1970) * 12 + mm - 1
    first = month0.astype("datetime64[M]").astype("datetime64[D]").astype(np.int64)
    length = (month0 + 1).astype("datetime64[M]").astype("datetime64[D]").astype(np.int64) - first
    return first + np.clip(d, 1, 31) - 1, ok & (d <= length)


def _lookup(codes: np.ndarray, of) -> np.ndarray:
    """Map the byte strings in ``codes`` by a function of each distinct one."""
    flat = np.ascontiguousarray(codes).reshape(-1).view(f"S{codes.shape[1]}")
    values, inverse = np.unique(flat, return_inverse=True)
    return np.array([of(v.decode("latin-1")) for v in values], np.int64)[inverse]


NONE = np.iinfo(np.int64).min


def parse_fields(texts: np.ndarray, expected: np.ndarray, shift: np.ndarray, month_first: np.ndarray | None = None):
    """Wall microseconds, offset seconds (NONE: no zone in the text) and validity.

    ``expected`` is the day (since 1970, NONE if unknown) that the reading is
    booked on and ``shift`` how many days later the text may stand (1 for
    readings stamped at the midnight that ends the day).  They tell day from
    month; where they can't, ``month_first`` (1, 0 or -1 for unknown, e.g. from
    the rest of the delivery) and then the layout's usual order decide.
    """
    n, w = len(texts), texts.dtype.itemsize
    wall, offset = np.full(n, NONE), np.full(n, NONE)
    codes = texts.view(np.uint8).reshape(n, w)
    masks, inverse = np.unique(shape_masks(texts), return_inverse=True)
    order = np.argsort(inverse, kind="stable")
    bounds = np.searchsorted(inverse[order], np.arange(len(masks) + 1))
    for k, mask in enumerate(masks):
        parser = compile_mask(mask.decode("latin-1"))
        if parser is None:
            continue
        rows = order[bounds[k] : bounds[k + 1]]
        c = codes[rows]
        f = {name: c[:, a:b] for name, a, b in parser.fields}
        if parser.kind == "epoch":
            wall[rows] = _digits(f["n"]) * 10 ** (16 - f["n"].shape[1])
            offset[rows] = 0
            continue
        if parser.kind == "serial":
            decimals = f["part"][:, :15]
            part = _digits(decimals) if decimals.shape[1] else np.zeros(len(rows), np.int64)
            # To the millisecond: the decimals of a day number do not carry more.
            ms = np.rint(part * (86_400_000.0 / 10 ** decimals.shape[1])).astype(np.int64)
            wall[rows] = ((_digits(f["day"]) - 25569) * 86_400_000 + ms) * 1000
            continue
        year = _digits(f["year"])
        if f["year"].shape[1] == 2:
            year += np.where(year < 70, 2000, 1900)
        if parser.order == FIXED:
            month = _lookup(f["name"], lambda v: _MONTHS.get(v.lower(), 0)) if "name" in f else _digits(f["month"])
            day, ok = _days(year, month, _digits(f["day"]))
        else:
            a, b = _digits(f["a"]), _digits(f["b"])
            (d1, ok1), (d2, ok2) = _days(year, b, a), _days(year, a, b)
            e, lag = expected[rows], shift[rows]
            near = lambda d: np.abs(d - e - lag * 0.5) <= 0.5
            near1, near2 = ok1 & (e != NONE) & near(d1), ok2 & (e != NONE) & near(d2)
            month_before = np.full(len(rows), parser.order == MONTH_FIRST)
            if month_first is not None:
                known = month_first[rows]
                month_before = np.where(known >= 0, known == 1, month_before)
            second = np.where(near1 != near2, near2, np.where(ok1 != ok2, ok2, month_before))
            day, ok = np.where(second, d2, d1), np.where(second, ok2, ok1)
        us = np.zeros(len(rows), np.int64)
        if "hour" in f:
            hour, minute = _digits(f["hour"]), _digits(f["minute"])
            sec = _digits(f["second"]) if "second" in f else np.zeros(len(rows), np.int64)
            sep = f["sep"][:, 0]
            ok = ok & ((sep == ord("T")) | (sep == ord(" ")))
            if "half" in f:
                half = _lookup(f["half"], lambda v: {"am": 0, "pm": 1}.get(v.lower(), 9))
                ok = ok & (half < 9) & (hour >= 1) & (hour <= 12)
                hour = hour % 12 + 12 * half
            ok = ok & (minute < 60) & (sec <= 60) & ((hour < 24) | ((hour == 24) & (minute == 0) & (sec == 0)))
            us = ((hour * 60 + minute) * 60 + sec) * 1_000_000
            if "fraction" in f:
                digits = f["fraction"][:, :6]  # what is below a microsecond is dropped
                us = us + _digits(digits) * 10 ** (6 - digits.shape[1])
        if "offset" in f:
            o = f["offset"]
            d = o[:, 1:][:, [i for i in range(o.shape[1] - 1) if chr(mask[parser.fields[-1][1] + 1 + i]) == "9"]]
            v = _digits(d)
            v = np.where(d.shape[1] == 2, v * 3600, v // 100 * 3600 + v % 100 * 60)
            offset[rows] = np.where(o[:, 0] == ord("-"), -v, v)
        elif "abbreviation" in f:
            minutes = _lookup(f["abbreviation"], lambda v: ABBREVIATIONS.get(v, NONE))
            ok = ok & (minutes != NONE)
            offset[rows] = np.where(minutes != NONE, minutes * 60, NONE)
        wall[rows] = np.where(ok, day * 86_400_000_000 + us, NONE)
    return wall, offset


def by_width(texts: pd.Series) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and fixed-width bytes of texts of about one length (doubling from
    ``WIDTH``); null texts are empty."""
    raw = [b"" if t is None or t != t else t.strip().encode("utf-8", "replace") for t in texts.tolist()]
    width = np.full(len(raw), WIDTH)
    for i in np.flatnonzero(np.fromiter(map(len, raw), np.int64, len(raw)) > WIDTH):
        width[i] = WIDTH << (-(-len(raw[i]) // WIDTH) - 1).bit_length()
    if (width == WIDTH).all():
        return [(np.arange(len(raw)), np.array(raw or [b""], f"S{WIDTH}")[: len(raw)])]
    rows = [np.flatnonzero(width == w) for w in np.unique(width)]
    return [(r, np.array([raw[i] for i in r], f"S{width[r[0]]}")) for r in rows]


def to_instants(texts, expected, shift, zones, month_first=None, tables: ZoneTables | None = None) -> pd.DataFrame:
    """Earlier and later UTC microseconds (nullable) of time texts.

    The two differ only for a wall time that occurs twice.  ``tables`` are zone
    tables compiled elsewhere; zones and years that they lack are compiled here.
    """
    if not len(texts):
        return pd.DataFrame({"first_us": pd.array([], "Int64"), "last_us": pd.array([], "Int64")})
    tables = tables or compiled([])
    wall, offset = np.full(len(texts), NONE), np.full(len(texts), NONE)
    for rows, data in by_width(texts):
        wall[rows], offset[rows] = parse_fields(data, expected[rows], shift[rows], None if month_first is None else month_first[rows])
    first = np.where(offset != NONE, wall - np.where(offset != NONE, offset, 0) * 1_000_000, wall)
    last = first.copy()
    local = (offset == NONE) & (wall != NONE)
    if local.any():
        names, inverse = np.unique(zones.fillna("").to_numpy(dtype=object).astype(str), return_inverse=True)
        for k, name in enumerate(names):
            rows = np.flatnonzero(local & (inverse == k))
            if len(rows):
                first[rows], last[rows] = tables.to_utc(resolve_zone(name, DEFAULT_ZONE), wall[rows])
    bad = wall == NONE
    return pd.DataFrame({"first_us": pd.array(np.where(bad, 0, first), "Int64"), "last_us": pd.array(np.where(bad, 0, last), "Int64")}).mask(pd.Series(bad))
