"""Exact quantiles of groups of any size.

No group's values are gathered: values are counted by group and bucket (map-side
first), the bucket that holds a rank is found in the running counts, and only
that bucket is refined, until it holds one value or at most ``GATHERED`` values,
which are then sorted.  A group costs some passes over its rows, never memory
that grows with them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .sizing import checked_side, checkpointed

#: Values of a bucket that are sorted at last, and buckets of a refinement.
GATHERED, BUCKETS = 50_000, 4_096


def _same(keys: list[str], a: str, b: str) -> Column:
    return reduce(Column.__and__, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])


def _first_bucket(v: Column) -> Column:
    """64 buckets an octave, in the order of the values; at most 270,000."""
    return F.signum(v) * F.when(v == 0, 0).otherwise(F.floor((F.log2(F.abs(v)) + 1100) * 64))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, quantiles: tuple[float, ...]) -> DataFrame:
    """``keys, n, q``: values that are not null, and their quantiles (an array in
    the order asked, linear between neighbours), null-safe in the keys."""
    keys = keys or ["_all"]
    rows = df.select(*[F.lit(0).alias(k) if k == "_all" else F.col(k) for k in keys], F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    stats = [F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    hist = rows.groupBy(*keys, _first_bucket(F.col("v")).alias("b")).agg(*stats)
    hist = checkpointed(_running(hist, keys).withColumn("total", F.sum("n").over(W.partitionBy(*keys))))
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(_position(q)), F.ceil(_position(q))) for q in quantiles])))
    inside = F.filter(ranks, lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")))
    at = hist.select(*keys, "total", F.explode(inside).alias("rank"), (F.col("upto") - F.col("n")).alias("before"), "n", "lo", "hi")
    done = []
    while True:
        at = checkpointed(at)
        small = (F.col("n") <= GATHERED) | (F.col("lo") == F.col("hi"))
        done.append(at.filter(small))
        at = at.filter(~small)
        if at.isEmpty():
            break
        ranges = checked_side(at.select(*keys, "lo", "hi").distinct())
        part = F.least(F.lit(BUCKETS - 1), F.floor((F.col("r.v") - F.col("s.lo")) / (F.col("s.hi") - F.col("s.lo")) * BUCKETS))
        within = rows.alias("r").join(ranges.alias("s"), _same(keys, "r", "s") & F.col("r.v").between(F.col("s.lo"), F.col("s.hi")))
        finer = within.select(*[F.col(f"r.{k}") for k in keys], F.col("s.lo").alias("from"), part.alias("b"), F.col("r.v").alias("v")).groupBy(*keys, "from", "b").agg(*stats)
        finer = _running(finer, [*keys, "from"])
        hit = _same(keys, "a", "f") & (F.col("a.lo") == F.col("f.from")) & (F.col("a.rank") - F.col("a.before") < F.col("f.upto")) & (F.col("a.rank") - F.col("a.before") >= F.col("f.upto") - F.col("f.n"))
        at = at.alias("a").join(finer.alias("f"), hit).select(*[F.col(f"a.{k}") for k in keys], "a.total", "a.rank", (F.col("a.before") + F.col("f.upto") - F.col("f.n")).alias("before"), "f.n", "f.lo", "f.hi")
    found = reduce(DataFrame.unionByName, done)
    one = found.filter(F.col("lo") == F.col("hi")).select(*keys, "total", "rank", F.col("lo").alias("v"))
    rest = found.filter(F.col("lo") < F.col("hi"))
    ranges = checked_side(rest.select(*keys, "lo", "hi").distinct())
    lists = rows.alias("r").join(ranges.alias("s"), _same(keys, "r", "s") & F.col("r.v").between(F.col("s.lo"), F.col("s.hi")))
    lists = lists.groupBy(*[F.col(f"s.{k}") for k in keys], "s.lo").agg(F.sort_array(F.collect_list("r.v")).alias("values"))  # at most GATHERED
    rest = rest.alias("a").join(lists.alias("l"), _same(keys, "a", "l") & (F.col("a.lo") == F.col("l.lo")))
    rest = rest.select(*[F.col(f"a.{k}") for k in keys], "a.total", "a.rank", F.get("l.values", (F.col("a.rank") - F.col("a.before")).cast("int")).alias("v"))
    out = one.unionByName(rest).groupBy(*keys, "total").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("_v"))
    values = []
    for q in quantiles:
        below, above = F.col("_v")[F.floor(_position(q))], F.col("_v")[F.ceil(_position(q))]
        values.append(below + (above - below) * (_position(q) - F.floor(_position(q))))
    return out.select(*[k for k in keys if k != "_all"], F.col("total").alias("n"), F.array(*values).alias("q"))


def _position(q: float) -> Column:
    return (F.col("total") - 1) * F.lit(float(q))


def _running(hist: DataFrame, part: list[str]) -> DataFrame:
    """Counts up to each bucket; a group has a bounded number of buckets."""
    return hist.withColumn("upto", F.sum("n").over(W.partitionBy(*part).orderBy("lo").rowsBetween(W.unboundedPreceding, 0)))


def with_quantiles(stats: DataFrame, df: DataFrame, keys: list[str], value: str, quantiles: tuple[float, ...]) -> DataFrame:
    """One row per group (``stats``) with the group's quantiles ``q``; groups
    without values have null."""
    q = exact_quantiles(df, keys, value, quantiles)
    if not keys:
        return stats.join(F.broadcast(q.select("q")), how="left")  # one row each
    return stats.alias("a").join(q.alias("b"), _same(keys, "a", "b"), "left").select("a.*", "b.q")
