"""Units as a graph of affine conversions, and plain signal names.

Edges carry exact affine functions ``y = a x + b``.  For each canonical target
the shortest composition from every unit is precomputed (breadth first), every
cycle is checked to be the identity, and the result is a fixed table of some
hundred rows with which readings are equi-joined on (unit text, target).
"""

from __future__ import annotations

import functools
from collections import deque
from fractions import Fraction as Fr

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Conversions between units, (unit, unit, a, b): y = a x + b.
EDGES = [
    ("wh", "kwh", Fr(1, 1000), 0), ("kwh", "mwh", Fr(1, 1000), 0), ("mwh", "gwh", Fr(1, 1000), 0),
    ("mj", "kwh", Fr(10, 36), 0), ("gj", "mj", 1000, 0), ("kj", "mj", Fr(1, 1000), 0), ("gj", "mwh", Fr(10, 36), 0),
    ("w", "kw", Fr(1, 1000), 0), ("kw", "mw", Fr(1, 1000), 0), ("mw", "gw", Fr(1, 1000), 0),
    ("kw_m_2", "w_m_2", 1000, 0), ("mw_cm_2", "w_m_2", 10, 0), ("mw_cm_2", "kw_m_2", Fr(1, 100), 0),
    ("km_h", "m_s_1", Fr(10, 36), 0), ("knot", "km_h", Fr(1852, 1000), 0), ("mph", "km_h", Fr(1609344, 1000000), 0), ("knot", "m_s_1", Fr(1852, 3600), 0),
    ("k", "c", 1, Fr(-27315, 100)), ("f", "c", Fr(5, 9), Fr(-160, 9)), ("f", "k", Fr(5, 9), Fr(45967, 180)),
    ("percent", "fraction", Fr(1, 100), 0), ("permille", "percent", Fr(1, 10), 0), ("permille", "fraction", Fr(1, 1000), 0),
]

# Spellings of the units (lower case, blanks and a leading "u_" removed).
SPELLINGS = {
    "wh": ["w*h", "watthour"], "kwh": ["kw*h"], "mwh": ["mw*h"], "gwh": ["gw*h"],
    "mj": [], "gj": [], "kj": [],
    "w": ["watt", "watts"], "kw": ["kilowatt"], "mw": ["megawatt"], "gw": [],
    "w_m_2": ["w/m2", "w/m²", "w*m^-2", "w/m^2", "w_m2", "w/sqm"], "kw_m_2": ["kw/m2", "kw/m²", "kw*m^-2", "kw/m^2", "kw_m2"], "mw_cm_2": ["mw/cm2", "mw/cm²", "mw*cm^-2", "mw/cm^2", "mw_cm2"],
    "m_s_1": ["m/s", "m*s^-1", "ms-1"], "km_h": ["km/h", "kmh", "kph", "km*h^-1"], "knot": ["knots", "kn", "kt"], "mph": ["mi/h", "miles_h"],
    "c": ["degc", "°c", "celsius", "deg_c", "℃"], "f": ["degf", "°f", "fahrenheit", "deg_f", "℉"], "k": ["kelvin", "degk", "°k"],
    "fraction": ["pct", "p.u.", "pu", "ratio"], "percent": ["%"], "permille": ["‰"],
    "num": ["count", "-", "1"],
}

# Which signals are measured in which common unit.
TARGETS = [
    (r"energy", "kwh"), (r"power", "kw"), (r"irradiance", "w_m_2"), (r"availability|soiling_ratio|_ratio$", "fraction"),
    (r"temperature", "c"), (r"wind_speed|_speed$", "m_s_1"), (r"count|state", "num"),
]

#: Unit texts that may end a signal name after underscores ("count" may not: it is part of names).
SUFFIXES = (
    "kwh wh mwh gwh mj gj watt kw mw w kw_m_2 w_m_2 mw_cm2 mw_cm_2 m_s_1 km_h knots knot kn mph "
    "celsius degc c kelvin k fahrenheit degf f fraction percent permille pct"
).split()


def compose(f: tuple, g: tuple) -> tuple:
    """The affine function g after f."""
    return g[0] * f[0], g[0] * f[1] + g[1]


@functools.cache
def conversions(edges: tuple = None) -> dict[tuple[str, str], tuple[Fr, Fr]]:
    """(unit, target) -> (a, b) for all connected pairs, over shortest paths.

    Raises ValueError where two paths between the same units disagree.
    """
    graph: dict[str, list] = {}
    for u, v, a, b in edges or EDGES:
        a, b = Fr(a), Fr(b)
        graph.setdefault(u, []).append((v, (a, b)))
        graph.setdefault(v, []).append((u, (1 / a, -b / a)))
    out = {}
    for start in graph:
        known, queue = {start: (Fr(1), Fr(0))}, deque([start])
        while queue:
            u = queue.popleft()
            for v, f in graph[u]:
                g = compose(known[u], f)
                if v not in known:
                    known[v] = g
                    queue.append(v)
                elif known[v] != g:
                    raise ValueError(f"conversions around {u} and {v} do not close")
        out |= {(start, v): f for v, f in known.items()}
    out[("num", "num")] = (Fr(1), Fr(0))
    return out


def conversion_rows() -> list[tuple[str, str, float, float]]:
    """(unit text, target, factor, offset) for every spelling and common unit."""
    targets = {t for _, t in TARGETS}
    return [
        (text, target, float(a), float(b))
        for (unit, target), (a, b) in sorted(conversions().items())
        if target in targets
        for text in dict.fromkeys([unit, *SPELLINGS.get(unit, [])])
    ]


def conversion_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(conversion_rows(), "unit_key string, target string, factor double, shift double")


def unit_key(unit: Column) -> Column:
    """The unit text as the conversion table spells it."""
    return F.regexp_replace(F.regexp_replace(F.lower(unit), r"\s+", ""), "^u_+", "")


def split_signal(name: Column) -> tuple[Column, Column]:
    """Plain signal name and the unit text inside the name ('' if none)."""
    low = F.lower(F.trim(name))
    suffix = "(?:" + "|".join(SUFFIXES) + ")"
    bracket, tail = r"^(.*?)\s*[\(\[]\s*(.*?)\s*[\)\]]$", rf"^(.+?)_{{1,2}}({suffix})$"
    inside = F.regexp_extract(low, bracket, 2)
    base = F.when(inside != "", F.regexp_extract(low, bracket, 1)).otherwise(low)
    ending = F.when(inside == "", F.regexp_extract(low, tail, 2)).otherwise("")
    plain = F.when(ending != "", F.regexp_extract(low, tail, 1)).otherwise(base)
    plain = F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(plain != "", plain), unit_key(F.when(inside != "", inside).otherwise(ending))


def target_of(signal: Column) -> Column:
    """Common unit of a plain signal name; null for unknown kinds."""
    out = F.lit(None).cast("string")
    for pattern, target in reversed(TARGETS):
        out = F.when(signal.rlike(pattern), target).otherwise(out)
    return out
