"""Matching names by the words they share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def name_words(name: Column) -> Column:
    """Distinct lower-case words of a name, without numbers and capacities."""
    words = F.split(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " "), " ")
    return F.array_distinct(F.filter(words, lambda w: (w != "") & ~w.rlike("[0-9]") & ~w.isin("kw", "mw", "kwp", "mwp")))


def best_overlap(left: DataFrame, right: DataFrame, left_name: str, right_name: str, least: int = 2) -> DataFrame:
    """``left_name, right_name, n_words``: for each left name the right name with
    most words in common, at least ``least``; ties go to the first by name.

    The names meet on their words (an equi-join), never pair by pair.
    """
    words = lambda df, c: df.select(F.col(c)).filter(F.col(c).isNotNull()).distinct().select(c, F.explode(name_words(F.col(c))).alias("word"))
    pairs = words(left, left_name).join(words(right, right_name), "word").groupBy(left_name, right_name).agg(F.count("*").alias("n_words"))
    best = F.min(F.struct((-F.col("n_words")).alias("k"), F.col(right_name).alias("name")))
    found = pairs.filter(F.col("n_words") >= least).groupBy(left_name).agg(best.alias("b"))
    return found.select(left_name, F.col("b.name").alias(right_name), (-F.col("b.k")).alias("n_words"))


def plain_name(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^a-z0-9]+", "")


def _inner_texts(df: DataFrame, name: str, least: int) -> DataFrame:
    """Every substring of a name of at least ``least`` characters (names are short)."""
    n = F.length(name)
    spans = F.flatten(F.transform(F.sequence(F.lit(1), n - least + 1), lambda a: F.transform(F.sequence(F.lit(least), n - a + 1), lambda m: F.substring(F.col(name), a, m))))
    return df.filter(n >= least).withColumn("inside", F.explode(F.array_distinct(spans)))


def lookup(names: DataFrame, parks: DataFrame, near: float = 0.1, least: int = 3) -> DataFrame:
    """``name, park_id, rank``: for each name (with ``kwp``) the park of the same
    plain name (1), else of a capacity within ``near`` (2), else whose plain name
    holds the other's or lies in it (3); the first park by id.

    All three are equi-joins: on the name, on a cell of the capacity, and on the
    substrings of the longer name."""
    left = names.select("name", plain_name(F.col("name")).alias("k"), "kwp")
    right = parks.filter(F.col("park_name").isNotNull()).select("park_id", plain_name(F.col("park_name")).alias("k"), "capacity_kwp").distinct()
    same = left.filter("k <> ''").join(right, "k").select("name", "park_id", F.lit(1).alias("rank"))
    cell = lambda c: F.floor(c / near)
    around = left.filter("kwp is not null").withColumn("cell", F.explode(F.array(*[cell(F.col("kwp")) + d for d in (-1, 0, 1)])))
    sized = around.join(right.withColumn("cell", cell(F.col("capacity_kwp"))), "cell").filter(F.abs(F.col("kwp") - F.col("capacity_kwp")) <= near).select("name", "park_id", F.lit(2).alias("rank"))
    long = F.length("k") >= least
    holds = _inner_texts(left, "k", least).join(right.filter(long).select("park_id", F.col("k").alias("inside")), "inside")
    within = _inner_texts(right, "k", least).join(left.filter(long).select("name", F.col("k").alias("inside")), "inside")
    third = holds.select("name", "park_id").unionByName(within.select("name", "park_id")).withColumn("rank", F.lit(3))
    best = F.min(F.struct("rank", "park_id")).alias("b")
    return same.unionByName(sized).unionByName(third).groupBy("name").agg(best).select("name", "b.park_id", "b.rank")
