"""Names: headers of exports, capacities in labels, park keys.

Column expressions where rows carry the names, plain functions where only the
columns of a file do.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ``park__<int>_kwp__signal[__unit]``; the unit may be missing.
HEADER = r"^(.+?)__(\d+)_kwp__(.+?)(?:__([^_].*?))?$"
#: A capacity in a label is a number, a gap, and a unit of power with or without "peak".
NUMBER, GAP, POWER = r"(\d+(?:[.,_]\d+)?)", r"[\s_]*", r"(k|m)wp?"
CAPACITY = NUMBER + GAP + POWER
TIME_COLUMNS = ("ts", "timestamp", "time", "datetime")


def header_parts(name: Column) -> dict[str, Column]:
    """Park, capacity, signal and unit of a wide column's name (null where absent)."""
    part = lambda i: F.nullif(F.regexp_extract(name, HEADER, i), F.lit(""))
    return {"park_id": F.lower(F.trim(part(1))), "park_capacity_kwp": part(2).cast("double"), "signal_name": part(3), "unit": part(4)}


def kwp_in_label(label: Column, default: float | None = None) -> Column:
    """Capacity in kWp that a label names; MW count a thousandfold, ``,`` and
    ``_`` are decimal marks; ``default`` where there is none."""
    low = F.lower(label)
    number = F.regexp_replace(F.regexp_extract(low, CAPACITY, 1), "[,_]", ".")
    factor = F.when(F.regexp_extract(low, CAPACITY, 2) == "m", 1000.0).otherwise(1.0)
    value = F.when(number != "", number.cast("double") * factor)
    return F.coalesce(value, F.lit(default).cast("double"))


def park_key(park: Column) -> Column:
    """Key under which parks of two sources meet: no ``p_``, no capacity."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(park)), "^p_", ""), r"_\d+_?kwp", "")


def snake_case(text: Column) -> Column:
    """Lower case, runs of other characters as one ``_``, ASCII letters and digits only."""
    out = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(out.rlike("^[0-9]"), F.concat(F.lit("p_"), out)).otherwise(out)


def plain_label(park: Column) -> Column:
    """Title of a park for a chart: words in title case, capacity in brackets."""
    words = F.initcap(F.trim(F.regexp_replace(park_key(park), "_", " ")))
    kwp = F.regexp_extract(park, r"_(\d+)_kwp", 1)
    return F.when(kwp != "", F.concat(words, F.lit(" ("), kwp, F.lit(" kWp)"))).otherwise(words)


def abbreviated(text: Column, most: int = 4) -> Column:
    """Each word of a snake-case name cut to ``most`` letters."""
    return F.array_join(F.transform(F.split(text, "_"), lambda w: F.substring(w, 1, most)), "_")


def distinct_words(text: Column) -> Column:
    """A snake-case name with repeated words dropped, the first ones kept."""
    return F.array_join(F.array_distinct(F.split(F.lower(text), "_")), "_")


def without_park(words: list[str], park: list[str]) -> list[str]:
    """A signal's words without the park's that lead them, in one of three forms:
    the park as one compound word (``alphasun``), word by word, or the park's
    letters spread over other words (``alpha sunpower`` after ``alpha sun power``).
    Words that would leave nothing stay."""
    if not park:
        return words
    joined = "".join(park)
    if words and words[0] == joined and len(words) > 1:
        return words[1:]
    k = 0
    while k < min(len(words), len(park)) and words[k] == park[k]:
        k += 1
    if k:
        return words[k:] or words
    text = ""
    for k, w in enumerate(words[:-1]):
        text += w
        if text == joined:
            return words[k + 1 :]
        if not joined.startswith(text):
            break
    return words


def slug(text: str) -> str:
    """Lower-case ASCII words joined by ``_``; for reasons and labels in file names."""
    plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()
    return re.sub("[^a-z0-9]+", "_", plain).strip("_")


def file_name(text: str, most: int = 120) -> str:
    """A name that every file system takes: other characters become ``_``; case,
    dots and dashes stay; never empty."""
    plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
    return re.sub(r"[^A-Za-z0-9._-]+", "_", plain).strip("._ ")[:most] or "unnamed"


def sanitized(header: str, parks: dict[str, float] | None = None) -> str:
    """Column name for a vendor header such as ``[Park 805 KWp] Park Signal (kWh)``.

    The park's words that the signal repeats are dropped; the capacity comes
    from ``parks`` (snake-case park -> kWp), else from the header; a time
    column becomes ``datetime``.
    """
    if header.strip().lower() in TIME_COLUMNS:
        return "datetime"
    snake = lambda t: re.sub(r"[^a-z0-9]+", "_", unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower()).strip("_")
    m = re.fullmatch(r"\s*\[(.*?)\]\s*(.*?)\s*(?:\(([^()]*)\))?\s*", header)
    if not m:
        return snake(header)
    park, rest, unit = m[1], m[2], (m[3] or "").strip()
    cap = re.search(CAPACITY, f"{park} ".lower())
    bare = snake(re.sub(CAPACITY, " ", park.lower()))
    kwp = (parks or {}).get(snake(park)) or (parks or {}).get(bare)
    if kwp is None and cap:
        kwp = float(re.sub("[,_]", ".", cap[1])) * (1000 if cap[2] == "m" else 1)
    words = [w for w in snake(re.sub(CAPACITY, " ", rest.lower())).split("_") if w]
    words = without_park(words, bare.split("_"))
    unit = "pct" if unit == "%" else snake(unit.replace("^-", " "))
    parts = [bare, f"{round(kwp)}_kwp" if kwp else "", "_".join(words), unit]
    return "__".join(p for p in parts if p)


def sanitized_all(headers: list[str], parks: dict[str, float] | None = None) -> list[str]:
    """Names of the headers; names that meet again get ``_1``, ``_2`` and so on."""
    seen: dict[str, int] = {}
    out = []
    for h in headers:
        name = sanitized(h, parks)
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(f"{name}_{n}" if n else name)
    return out
