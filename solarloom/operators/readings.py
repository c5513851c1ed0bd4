"""Readings in common units: the frame that most operators start from.

Units come from the ``unit`` column, else from the text inside the signal name;
the conversion is an equi-join with the precomputed table of
``functions.units``.  Then the numbers themselves are heard: per source,
delivery and month (a group that one file bounds) a robust level is compared
with what such a signal shows over all sources, and where it is plainly on
another scale the whole group is rescaled.  Zeros, signs and NaN never count
towards the level.

One pass over the table (``profile_of``) gives the distinct names, the levels
of all groups, and their counts; everything else is derived from that small
table, so that an operator reads the fact twice: for the profile and for itself.

Defined results: null ``unit``, empty, unknown or foreign units mean the common
unit; null names, dates and parks give rows that are no readings
(``is_reading`` false) and are kept; null, NaN and infinite values are no
readings either; a null ``run_id`` has the scale that its texts say.  Only
needed columns are taken from the table, so extra ones never clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.units import conversion_table, split_signal, target_of, unit_key
from .sizing import BROADCAST_ROWS, checked_side, checkpointed

DELIVERY = ["park_id", "signal", "run_id", "_month"]


@dataclass(frozen=True)
class ScaleRule:
    """A kind of signal and the other scales that its deliveries may be on.

    Its level is the median over all sources of the kind, per kWp of the park
    if ``per_kwp``; ``prior`` is used where fewer than ``LEAST_SOURCES`` sources
    tell a level.  ``quantile`` of a delivery's positive readings is compared
    with it; ``powers`` are the decades by which a delivery may be off;
    ``least`` readings are needed to call a delivery too low (a few night
    readings of power are low as well).
    """

    pattern: str
    prior: float
    powers: tuple[int, ...]
    per_kwp: bool = False
    quantile: float = 0.5
    least: int = 1


SCALE_RULES = (
    ScaleRule("^inverter_.*energy$", 350.0, (-6, -3, 3, 6)),
    ScaleRule("energy_export$", 2.5, (-6, -3, 3, 6), per_kwp=True),
    ScaleRule("energy_import$", 0.017, (-6, -3, 3, 6), per_kwp=True),
    ScaleRule("^active_power$", 0.4, (-6, -3, 3, 6), per_kwp=True, quantile=0.8, least=4),
    ScaleRule("irradiance", 140.0, (-3, 3)),
    ScaleRule("^availability$|^soiling_ratio$", 1.0, (2, 3)),
)
#: A delivery must be off by more than FAR decades, and NEAR one of the powers.
FAR, NEAR = 1.5, 0.85
#: Sources of a kind that tell its level; with fewer the prior holds.
LEAST_SOURCES = 8
#: Signals whose nights count: the level is a high quantile of all absolute values.
NIGHTLY = r"^active[^a-z0-9]+power"
QUANTILES = (0.5, 0.8)
#: Error codes of loggers; they say nothing about a scale.
SENTINELS = (9999.0, 99999.0, 999999.0, 9999999.0, 999.0)


def described(names: DataFrame) -> DataFrame:
    """Names and units with ``signal``, ``_a`` and ``_b`` (label conversion to
    the common unit) and ``_rule`` (number of the scale rule, or null)."""
    signal, inside = split_signal(F.col("signal_name"))
    own = F.coalesce(unit_key(F.col("unit")), F.lit(""))
    df = names.withColumns({"signal": signal, "_inside": inside, "_own": own}).withColumn("_target", target_of(F.col("signal")))
    conv = conversion_table(df.sparkSession)  # fixed, some hundred rows
    side = lambda p: F.broadcast(conv.select(F.col("unit_key").alias(f"_{p}"), F.col("target").alias("_target"), F.col("factor").alias(f"_{p}_a"), F.col("shift").alias(f"_{p}_b")))
    df = df.join(side("inside"), ["_inside", "_target"], "left").join(side("own"), ["_own", "_target"], "left")
    a = F.coalesce("_inside_a", "_own_a", F.lit(1.0))
    b = F.when(F.col("_inside_a").isNotNull(), F.col("_inside_b")).otherwise(F.coalesce("_own_b", F.lit(0.0)))
    df = df.withColumns({"_a": a, "_b": b, "_rule": rule_number()})
    return df.drop("_inside", "_own", "_target", "_inside_a", "_own_a", "_inside_b", "_own_b")


@dataclass(frozen=True)
class Profile:
    """One pass over a table of readings, kept in the shared folder.

    ``groups``: park, raw name, raw unit, run and month with ``_rows``, ``_n``
    (readings that tell a scale), ``_q`` (their ``QUANTILES``) and ``_kwp``;
    ``names``: the distinct raw names and units, described; ``n_rows``: rows of
    the table.  Both grow with files and months, not with readings.
    """

    groups: DataFrame
    names: DataFrame
    n_names: int
    n_rows: int


def finite_value() -> Column:
    return F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != F.lit(float("inf")))


def profile_of(silver: DataFrame) -> Profile:
    """One scan with map-side partial aggregation; no group is gathered."""
    rows = silver.select("park_id", "signal_name", "unit", "run_id", F.trunc("interval_start_date", "month").alias("_month"), "value", "park_capacity_kwp")
    # Negative readings say something only where they are ordinary (power at night).
    tells = finite_value() & (F.col("value") != 0) & ~F.abs("value").isin(*SENTINELS) & ((F.col("value") > 0) | F.lower(F.trim("signal_name")).rlike(NIGHTLY))
    use = F.when(tells & F.col("_month").isNotNull(), F.abs("value"))
    groups = rows.groupBy("park_id", "signal_name", "unit", "run_id", "_month").agg(
        F.count("*").alias("_rows"), F.count(use).alias("_n"), F.percentile_approx(use, F.array(*map(F.lit, QUANTILES)), F.lit(10_000)).alias("_q"),
        F.max(F.when(F.col("park_capacity_kwp") > 0, F.col("park_capacity_kwp"))).alias("_kwp"),
    )
    groups = checkpointed(groups)
    names = checkpointed(described(groups.groupBy("signal_name", "unit").agg(F.sum("_rows").alias("_rows"))))
    n = names.agg(F.count("*").alias("n"), F.sum("_rows").alias("rows")).first()
    return Profile(groups, names.drop("_rows"), n["n"], n["rows"] or 0)


def described_rows(df: DataFrame, names: DataFrame, n_names: int, **more: Column) -> DataFrame:
    """Rows with the columns of ``described`` and of ``more`` (expressions over
    ``signal``).

    Names and units repeat without end, so each distinct pair is parsed once
    and rows look it up.  The lookup is broadcast only as it was counted and is
    small; else every row is parsed in place, without any join.
    """
    if n_names > BROADCAST_ROWS:
        return described(df).withColumns(more)
    names = names.withColumns(more)
    same = F.col("r.signal_name").eqNullSafe(F.col("n.signal_name")) & F.col("r.unit").eqNullSafe(F.col("n.unit"))
    added = [F.col(f"n.{c}") for c in names.columns if c not in ("signal_name", "unit")]
    return df.alias("r").join(F.broadcast(names.alias("n")), same, "left").select("r.*", *added)


def marked(df: DataFrame) -> DataFrame:
    reading = F.col("park_id").isNotNull() & F.col("signal").isNotNull() & F.col("interval_start_date").isNotNull() & finite_value()
    return df.withColumn("is_reading", reading)


def with_signals(df: DataFrame, **more: Column) -> DataFrame:
    """Add plain ``signal``, ``_a``, ``_b``, ``_rule``, the columns of ``more``
    and ``is_reading``; the names alone are collected first."""
    names = checkpointed(described(df.select("signal_name", "unit").distinct()))
    return marked(described_rows(df, names, names.count(), **more))


def labelled() -> Column:
    """The value in the common unit as the unit texts say."""
    plain = (F.col("_a") == 1.0) & (F.col("_b") == 0.0)
    return F.when(plain, F.col("value")).otherwise(F.col("value") * F.col("_a") + F.col("_b"))


def rule_number(rules: tuple[ScaleRule, ...] = SCALE_RULES) -> Column:
    out = F.lit(None).cast("int")
    for k in reversed(range(len(rules))):
        out = F.when(F.col("signal").rlike(rules[k].pattern), F.lit(k)).otherwise(out)
    return out


def of_rule(f, rules: tuple[ScaleRule, ...] = SCALE_RULES) -> Column:
    """A property of the row's scale rule."""
    return F.get(F.array(*[F.lit(f(r)) for r in rules]), F.col("_rule"))


def deliveries(profile: Profile, rules: tuple[ScaleRule, ...] = SCALE_RULES) -> DataFrame:
    """(source, delivery, month) with ``_rule``, ``_n`` and ``_log``, the decade
    of its level (per kWp where the rule says so).

    Several spellings of one name in a delivery count by their readings.
    """
    g = described_rows(profile.groups.filter("_n > 0 and park_id is not null"), profile.names, profile.n_names)
    g = g.filter(F.col("_rule").isNotNull())
    level = F.get("_q", of_rule(lambda r: QUANTILES.index(r.quantile), rules)) * F.col("_a")
    g = g.withColumn("_level", level).groupBy(*DELIVERY, "_rule").agg(F.sum("_n").alias("_n"), F.percentile("_level", F.lit(0.5), F.col("_n")).alias("_level"), F.max("_kwp").alias("_kwp"))
    size = F.when(of_rule(lambda r: r.per_kwp, rules), F.coalesce("_kwp", capacity_in_name())).otherwise(F.lit(1.0))
    return g.select(*DELIVERY, "_rule", "_n", F.when((F.col("_level") > 0) & (size > 0), F.log10("_level") - F.log10(size)).alias("_log"))


def kind_levels(groups: DataFrame, rules: tuple[ScaleRule, ...] = SCALE_RULES) -> DataFrame:
    """``_rule, _usual``: the decade that a kind of signal is usually on, the
    median over its sources of each source's median; a handful of rows."""
    own = groups.filter(F.col("_log").isNotNull() & (F.col("_n") >= of_rule(lambda r: r.least, rules)))
    own = own.groupBy("_rule", "park_id", "signal").agg(F.percentile_approx("_log", F.lit(0.5), F.lit(1_000)).alias("_own"))
    usual = own.groupBy("_rule").agg(F.percentile_approx("_own", F.lit(0.5), F.lit(10_000)).alias("_m"), F.count("*").alias("_sources"))
    prior = F.log10(of_rule(lambda r: float(r.prior), rules))
    return usual.select("_rule", F.when(F.col("_sources") >= LEAST_SOURCES, F.col("_m")).otherwise(prior).alias("_usual"))


def scale_exceptions(profile: Profile, rules: tuple[ScaleRule, ...] = SCALE_RULES) -> DataFrame:
    """(source, delivery, month) -> ``_scale``: only groups on another scale."""
    groups = deliveries(profile, rules)
    groups = groups.join(F.broadcast(kind_levels(groups, rules)), "_rule")  # one row a rule
    groups = groups.withColumn("_off", F.col("_log") - F.col("_usual"))
    powers = F.get(F.array(*[F.array(*map(F.lit, r.powers)) for r in rules]), F.col("_rule"))
    near = F.filter(powers, lambda e: (F.abs(F.col("_off") - e) <= NEAR) & ((e > 0) | (F.col("_n") >= of_rule(lambda r: r.least, rules))))
    groups = groups.filter(F.abs("_off") > FAR).withColumn("_power", F.get(near, F.lit(0)))
    return groups.filter(F.col("_power").isNotNull()).select(*DELIVERY, F.pow(F.lit(10.0), -F.col("_power")).alias("_scale"))


def capacity_in_name() -> Column:
    """Capacity that a park's name tells, or null."""
    return F.nullif(F.regexp_extract("park_id", r"_(\d{1,9})_kwp", 1), F.lit("")).cast("double")


class CommonUnits:
    """Rows of a table in common units; the profile and the groups on another
    scale are found once and serve any number of frames over the table."""

    def __init__(self, silver: DataFrame, rules: tuple[ScaleRule, ...] = SCALE_RULES):
        self.silver, self.profile = silver, profile_of(silver)
        self.odd = checked_side(scale_exceptions(self.profile, rules))

    def run_ranges(self, batches: int) -> list[tuple[str, str]]:
        """First and last run of each of at most ``batches`` ranges of runs with
        about equally many rows; from the profile's counts, by the first bytes of
        the ids.  A range is a batch for operators that take batches in order."""
        head = F.rpad(F.substring(F.encode("run_id", "UTF-8"), 1, 7), 7, F.lit(b"\x00"))
        groups = self.profile.groups.filter("run_id is not null").select("run_id", "_rows", F.conv(F.hex(head), 16, 10).cast("long").alias("head"))
        bounds = groups.agg(F.percentile("head", F.array(*[F.lit(k / batches) for k in range(1, batches)]), F.col("_rows")).alias("b")).first()["b"] if batches > 1 else []
        number = sum(((F.col("head") > F.lit(b)).cast("int") for b in sorted(set(bounds or []))), F.lit(0))
        return [(r["a"], r["z"]) for r in groups.groupBy(number.alias("k")).agg(F.min("run_id").alias("a"), F.max("run_id").alias("z")).orderBy("k").collect()]

    def rows(self, columns: list[str], only: Column | None = None, keep: Column | None = None, **more: Column) -> DataFrame:
        """The table with plain ``signal``, ``common`` (value in the common
        unit, null where the row is no reading), ``is_reading``, the asked
        columns and those of ``more`` (expressions over ``signal``).  ``only``
        (over the table) and ``keep`` (over the result) drop rows first."""
        need = ["park_id", "signal_name", "unit", "value", "interval_start_date", "run_id"]
        base = self.silver if only is None else self.silver.filter(only)
        base = marked(described_rows(base.select(*dict.fromkeys([*need, *columns])), self.profile.names, self.profile.n_names, **more))
        if keep is not None:
            base = base.filter(keep)
        base = base.withColumn("_month", F.trunc("interval_start_date", "month"))
        joined = base.join(self.odd, DELIVERY, "left")
        common = F.when(F.col("is_reading"), labelled() * F.coalesce("_scale", F.lit(1.0)))
        return joined.withColumn("common", common).select(*dict.fromkeys([*columns, "signal", "common", "is_reading", *more]))


def in_common_units(silver: DataFrame, columns: list[str], keep: Column | None = None, **more: Column) -> DataFrame:
    """``CommonUnits(silver).rows(...)`` for one use."""
    return CommonUnits(silver).rows(columns, keep=keep, **more)
