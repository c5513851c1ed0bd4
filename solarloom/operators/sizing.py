"""Checked broadcasts, bucket counts and lineage cuts."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when it was counted and has at most so many rows.
BROADCAST_ROWS = 100_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only in local mode, where it may be unset (as in tests), a folder of our own
    is made; on a cluster other machines could not see it, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if folder:
        store = sc._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        # A path without scheme lies on the cluster's default file system, for us as for Spark.
        return (folder if ":" in folder.split("/")[0] or store.startswith("file:") else store.rstrip("/") + folder).rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if _OWN.get(sc.applicationId) is None:
        _OWN[sc.applicationId] = tempfile.mkdtemp(prefix="solarloom-")
    return _OWN[sc.applicationId]


_OWN: dict[str, str] = {}


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours, on whatever file system it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def checked_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The side of a join, computed once; hinted for broadcast only if it was
    counted and is small, else joined by shuffle."""
    cut = checkpointed(df)
    return F.broadcast(cut) if cut.count() <= max_rows else cut.hint("merge")


def bucket_count(rows: int, rows_per_bucket: int = 40_000, least: int = 12) -> int:
    """How many buckets hold ``rows`` at about ``rows_per_bucket`` each."""
    return max(least, math.ceil(rows / rows_per_bucket))


def bucket_of(n: int, *keys: Column | str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
