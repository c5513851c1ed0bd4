"""Versioned zone transition tables.

A zone is compiled into two sorted arrays for each block of fifty years: the UTC
seconds at which its offset changes and the offsets that hold from then on.  The
driver compiles the zones of the parks for the usual blocks; the set carries the
version of the time-zone data that it was built from, is bounded by the number
of existing zones and not by the data, and travels to the executors with the
conversion function.  Wall times of other years get their block where they occur.
"""

from __future__ import annotations

import datetime as dt
import functools
import os
from dataclasses import dataclass
from zoneinfo import TZPATH, ZoneInfo, available_timezones

import numpy as np

DEFAULT_ZONE = "Europe/Athens"

# Windows zone names used by loggers, with the IANA zone of the
# same rules.
WINDOWS_ZONES = {
    "w. europe standard time": "Europe/Berlin",
    "central europe standard time": "Europe/Budapest",
    "central european standard time": "Europe/Warsaw",
    "romance standard time": "Europe/Paris",
    "gmt standard time": "Europe/London",
    "greenwich standard time": "Atlantic/Reykjavik",
    "gtb standard time": "Europe/Bucharest",
    "e. europe standard time": "Europe/Chisinau",
    "fle standard time": "Europe/Kyiv",
    "turkey standard time": "Europe/Istanbul",
    "egypt standard time": "Africa/Cairo",
    "israel standard time": "Asia/Jerusalem",
    "middle east standard time": "Asia/Beirut",
    "russian standard time": "Europe/Moscow",
    "utc": "UTC",
}

# Zone abbreviations in time texts, minutes east of UTC.
ABBREVIATIONS = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0,
    "WET": 0, "WEST": 60, "BST": 60,
    "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120,
    "EET": 120, "EEST": 180, "MSK": 180,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}


@functools.cache
def _known() -> dict[str, str]:
    return {z.lower(): z for z in available_timezones()}


def resolve_zone(name: str | None, default: str = DEFAULT_ZONE) -> str:
    """IANA name for a zone text; padding and case are ignored, Windows names
    are translated, and null, empty or unknown texts give ``default``."""
    key = (name or "").strip().lower()
    if not key:
        return default
    return WINDOWS_ZONES.get(key) or _known().get(key) or default


@dataclass(frozen=True)
class ZoneTable:
    """``starts[i]`` is the UTC second from which ``offsets[i]`` (s) holds."""

    starts: np.ndarray
    offsets: np.ndarray

    def to_utc(self, local_us: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Earlier and later UTC instants (us) of wall times (us).

        They differ only for a wall time that occurs twice.  A wall time that
        does not exist stands for the first instant after the gap.
        """
        second = np.int64(1_000_000)
        if len(self.starts) == 1:
            utc = local_us - self.offsets[0] * second
            return utc, utc
        at = self.starts[1:] * second
        before, after = self.offsets[:-1] * second, self.offsets[1:] * second
        # In wall time, a transition reaches from at + min to at + max of the two offsets.
        lo, hi = at + np.minimum(before, after), at + np.maximum(before, after)
        i = np.searchsorted(hi, local_us, side="right")  # the first transition not wholly past
        utc = local_us - self.offsets[np.minimum(i, len(self.offsets) - 1)] * second
        j = np.minimum(i, len(at) - 1)
        inside = (i < len(at)) & (local_us >= lo[j])
        gap = inside & (after[j] > before[j])
        twice = inside & (after[j] < before[j])
        first = np.where(gap, at[j], utc)
        return first, np.where(twice, local_us - after[j], first)


#: Years of a block, and the blocks that the driver compiles ahead: 1950 to 2099.
BLOCK, USUAL = 50, (39, 40, 41)
_YEAR_US = 31_556_952_000_000


def block_of(local_us: np.ndarray) -> np.ndarray:
    """Number of the block of years of wall times, exact but for the hours around a block's edge."""
    return (local_us // _YEAR_US + 1970) // BLOCK


@functools.lru_cache(maxsize=4096)
def zone_table(name: str, block: int = 40) -> ZoneTable:
    """Compile the transitions of one zone in one block of years, with a year on
    both sides; the day in which the offset changes is halved to the second."""
    zone, utc = ZoneInfo(name), dt.timezone.utc
    offset = lambda s: int((EPOCH + dt.timedelta(seconds=s)).astimezone(zone).utcoffset().total_seconds())
    year = lambda y: int((dt.datetime(min(9998, max(2, y)), 1, 1, tzinfo=utc) - EPOCH).total_seconds())
    begin, end = year(block * BLOCK - 1), year((block + 1) * BLOCK + 1)
    starts, offsets = [np.iinfo(np.int64).min // 4_000_000], [offset(begin)]
    t, known = begin, offset(begin)
    while t < end:
        hi = t + 86400
        new = offset(hi)
        if new != known:
            lo = t
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (lo, mid) if offset(mid) != known else (mid, hi)
            starts.append(hi)
            offsets.append(offset(hi))
            t, known = hi, offset(hi)
        else:
            t = hi
    return ZoneTable(np.array(starts, np.int64), np.array(offsets, np.int64))


EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


@dataclass(frozen=True)
class ZoneTables:
    """Compiled tables by zone and block, with the version of their data."""

    version: str
    tables: dict

    def to_utc(self, name: str, local_us: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, last = np.empty_like(local_us), np.empty_like(local_us)
        blocks = block_of(local_us)
        for b in np.unique(blocks):
            rows = blocks == b
            table = self.tables.get((name, int(b))) or zone_table(name, int(b))
            first[rows], last[rows] = table.to_utc(local_us[rows])
        return first, last


def compiled(names: list[str], blocks: tuple[int, ...] = USUAL) -> ZoneTables:
    return ZoneTables(tables_version(), {(n, b): zone_table(n, b) for n in dict.fromkeys(names) for b in blocks})


@functools.cache
def tables_version() -> str:
    """Version of the zone data that the tables are built from."""
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        pass
    for folder in TZPATH:  # the system's data name their version in a header
        try:
            with open(os.path.join(folder, "tzdata.zi")) as f:
                return f.readline().split()[-1]
        except OSError:
            continue
    return "system"
