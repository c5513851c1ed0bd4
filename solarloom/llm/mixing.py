"""Problem 9: mixing sources to target weights.

Sizes are tokens.  The mixture is as large as the caps allow: with size S,
share p and at most r repeats, the total is the least r S / p over the sources.
A source's quota is some whole repeats of all its documents plus a rest, and
the rest is the documents whose hash lies below a threshold.  Thresholds come
from nested histograms: tokens are summed by source and hash bucket, the bucket
in which the budget runs out is found, and only that bucket is refined.  No
document is sorted and nothing is brought to the driver.

A document larger than half of what is left waits, so what a threshold leaves
over is less than half of it; while that is more than ``NEAR`` of the rest, the
documents behind the threshold fill it the same way.  A quota that a source's
documents cannot fill is reported (``wanted_tokens`` beside ``tokens``).

Defined results: sources are compared trimmed, in lower case, with ``-`` and
blanks as ``_``; null sources, sources without target, and documents of no
tokens are not in the mixture.  A target source without documents contributes
nothing and is reported with size 0; it doesn't bound the total.  Null targets
and repeats count as 0.  Several rows of one target source: the shares add up
and the least cap holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.sizing import checked_side, checkpointed
from .encoding import encoded

#: Bits of a histogram level, and levels: 36 bits part some 10**10 documents.
BITS, LEVELS = 12, 3
#: Share of a rest that need not be filled.
NEAR = 0.002


def plain_source(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"[-\s]+", "_")


def targets_of(mix_targets: DataFrame) -> DataFrame:
    """``source, target_share, max_repeats`` of the sources with a share."""
    rows = mix_targets.filter(F.col("source").isNotNull()).groupBy(plain_source(F.col("source")).alias("source"))
    share, cap = F.coalesce("target_share", F.lit(0.0)), F.coalesce("max_repeats", F.lit(0))
    return rows.agg(F.sum(share).cast("double").alias("target_share"), F.min(cap).cast("int").alias("max_repeats")).filter("target_share > 0")


def sized(documents: DataFrame) -> DataFrame:
    """``doc_id, source, n_tokens, h`` of every document; ``h`` has 36 bits."""
    rows = encoded(documents.select("doc_id", plain_source(F.col("source")).alias("source"), "text"), ["doc_id", "source"], only_sizes=True)
    return rows.withColumn("h", F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("mix")), 64 - BITS * LEVELS))


def quotas(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, quota, whole, rest``: tokens wanted, whole repeats, tokens of the rest."""
    there = targets.join(sizes.filter("n > 0"), "source")
    total = there.agg(F.min(F.col("max_repeats") * F.col("n") / F.col("target_share")).alias("total"))
    quota = F.least(F.col("target_share") * F.col("total"), F.col("max_repeats") * F.col("n"))
    plan = there.join(F.broadcast(total)).withColumn("quota", quota)  # the total is one row
    whole = F.floor(F.col("quota") / F.col("n") + 1e-12)
    return plan.select("source", "quota", whole.cast("int").alias("whole"), F.greatest(F.lit(0.0), F.col("quota") - whole * F.col("n")).alias("rest"))


def filled(rows: DataFrame, state: DataFrame) -> DataFrame:
    """One filling: ``source, rest, lo, hi, most, left`` from ``source, rest, lo, most, left``.

    Documents of at most ``most`` tokens with lo <= h < hi are taken."""
    at = checkpointed(state.select("source", "rest", "lo", "most", "left", F.lit(0).cast("long").alias("prefix"), F.lit(True).alias("open")))
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        side = checked_side(at.filter("open").select("source", "lo", "most", "prefix"))
        inside = rows.join(side, "source").filter((F.col("h") >= F.col("lo")) & (F.col("n_tokens") <= F.col("most")))
        if level:
            inside = inside.filter(F.shiftright("h", shift + BITS) == F.col("prefix"))
        buckets = inside.groupBy("source", F.shiftright("h", shift).alias("b")).agg(F.sum("n_tokens").alias("n"))
        # At most 2**BITS buckets a source stand in a window.
        upto = F.sum("n").over(W.partitionBy("source").orderBy("b").rowsBetween(W.unboundedPreceding, 0))
        over = buckets.withColumn("upto", upto).join(checked_side(at.select("source", "left")), "source")
        ends = over.groupBy("source").agg(F.min(F.when(F.col("upto") > F.col("left"), F.col("b"))).alias("b"), F.max(F.when(F.col("upto") <= F.col("left"), F.col("upto"))).alias("taken"))
        at = at.join(ends, "source", "left")
        bound = F.when(F.col("open"), F.col("b"))  # null: all of it fits
        at = at.select("source", "rest", "lo", "most", F.when(F.col("open"), F.col("left") - F.coalesce("taken", F.lit(0))).otherwise(F.col("left")).alias("left"),
                       F.when(F.col("open"), F.coalesce(bound, F.shiftleft(F.col("prefix") + 1, BITS))).otherwise(F.shiftleft("prefix", BITS)).alias("prefix"), (F.col("open") & bound.isNotNull()).alias("open"))
        at = checkpointed(at)
    return at.select("source", "rest", "lo", F.col("prefix").alias("hi"), "most", "left")


def picks(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``source, picks``: the ranges of hashes whose documents come once more."""
    state = plan.filter("rest > 0").select("source", "rest", F.lit(0).cast("long").alias("lo"), F.col("rest").alias("most"), F.col("rest").alias("left"))
    done = None
    while True:
        step = filled(rows, state)
        done = step if done is None else done.unionByName(step)
        # Where no document fits any more, the threshold has come to the end.
        more = (F.col("left") > NEAR * F.col("rest")) & (F.col("hi") < F.lit(1 << (BITS * LEVELS)))
        state = step.filter(more).select("source", "rest", F.col("hi").alias("lo"), (F.col("left") / 2).alias("most"), "left")
        if state.isEmpty():
            return done.groupBy("source").agg(F.collect_list(F.struct("lo", "hi", "most")).alias("picks"))  # a filling each, some ten at most


def planned(documents: DataFrame, mix_targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents of the mixture with their repeats, and the sources' quotas."""
    targets = checked_side(targets_of(mix_targets))
    rows = checkpointed(sized(documents).filter(F.col("n_tokens") > 0).join(targets.select("source"), "source", "left_semi"))
    plan = checkpointed(quotas(rows.groupBy("source").agg(F.sum("n_tokens").alias("n")), targets))
    chosen = checked_side(plan.select("source", "whole").join(picks(rows, plan), "source", "left"))
    once_more = F.exists("picks", lambda p: (F.col("h") >= p["lo"]) & (F.col("h") < p["hi"]) & (F.col("n_tokens") <= p["most"]))
    mix = rows.join(chosen, "source").withColumn("repeats", F.col("whole") + F.coalesce(once_more, F.lit(False)).cast("int"))
    return mix.filter(F.col("repeats") > 0).select("doc_id", "source", "n_tokens", "repeats"), plan


def mixed(documents: DataFrame, mix_targets: DataFrame) -> DataFrame:
    """``doc_id, source, n_tokens, repeats``: the documents of the mixture."""
    return planned(documents, mix_targets)[0]


def shares(documents: DataFrame, mix_targets: DataFrame) -> DataFrame:
    """Target and actual share, wanted and reached tokens, documents and
    greatest repeats by source."""
    mix, plan = planned(documents, mix_targets)
    sums = mix.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("documents"), F.max("repeats").alias("most_repeats"))
    sums = checkpointed(sums)
    total = sums.agg(F.sum("tokens").alias("total"))
    out = targets_of(mix_targets).join(plan.select("source", "quota"), "source", "left").join(sums, "source", "left").join(F.broadcast(total))
    zero = lambda c, name=None: F.coalesce(F.col(c), F.lit(0)).alias(name or c)
    return out.select("source", "target_share", "max_repeats", zero("quota", "wanted_tokens"), zero("tokens"), zero("documents"), zero("most_repeats"), F.coalesce(F.try_divide("tokens", "total"), F.lit(0.0)).alias("actual_share"))
