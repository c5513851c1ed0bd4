"""Series of days packed as one row per entity and time tile.

The input is pre-aggregated to one cell per entity and day (with map-side
partial aggregation, so that a hot entity is spread), then cut into tiles of a
fixed number of days with a halo of preceding and following days.  A row holds
its tile's cells as two arrays; tiles without any cell inside the entity's
period exist as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def day_number(c: Column | str) -> Column:
    return F.unix_date(F.col(c) if isinstance(c, str) else c)


def packed(cells: DataFrame, keys: list[str], tile_days: int, before: int, after: int = 0) -> DataFrame:
    """``keys, tile, first, last, days, values`` from cells ``keys, day, v``.

    ``day`` counts days since 1970; ``first`` and ``last`` are the entity's
    period over all tiles.
    """
    tile = lambda c: F.floor(c / F.lit(tile_days)).cast("int")
    d = F.col("day")
    spread = F.array_distinct(F.array(tile(d), tile(d + before), tile(d - after)))
    members = cells.select(*keys, F.explode(spread).alias("tile"), F.struct("day", "v").alias("cell"))
    # One exchange by entity serves the grouping and the windows; an entity has at most a cell a day.
    lists = members.repartition(*keys).groupBy(*keys, "tile").agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    entity = W.partitionBy(*keys)
    lists = lists.select(
        *keys, "tile", "cells",
        F.min(F.get(F.col("cells.day"), F.lit(0))).over(entity).alias("first"),
        F.max(F.element_at(F.col("cells.day"), -1)).over(entity).alias("last"),
        F.lead("tile").over(entity.orderBy("tile")).alias("_next"),
    )
    lists = lists.filter(F.col("tile").between(tile(F.col("first")), tile(F.col("last"))))
    # Tiles in which no day has a cell follow the tile before them.
    upto = F.least(F.coalesce(F.col("_next") - 1, F.col("tile")), tile(F.col("last")))
    every = lists.select(*keys, "tile", "first", "last", "cells", F.explode(F.sequence("tile", F.greatest("tile", upto))).alias("_tile"))
    own = F.col("tile") == F.col("_tile")
    days = F.when(own, F.col("cells.day")).otherwise(F.array().cast("array<int>"))
    values = F.when(own, F.col("cells.v")).otherwise(F.array().cast("array<double>"))
    return every.select(*keys, F.col("_tile").alias("tile"), "first", "last", days.alias("days"), values.alias("values"))
