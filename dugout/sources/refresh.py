"""Marts that follow their staging tables: only the partitions with changed rows are rewritten.

A mart has a table of digests, one line per row of its staging table: the key, the partition of
the mart that the row flows into, and a hash of all its columns. Rows that are new, changed, moved
or gone differ there, and their partitions are built again from the whole rows of staging. The
digests are replaced last, in one step; if a refresh fails before, the next one finds the same
differences again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, StructType

from ..session import settle
from .schemas import INT, TEXT, record
from .tables import open_table, replace_table
from .versions import live_path, remove_folders

_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_DIGESTS = record(key=TEXT, part=TEXT, digest=DecimalType(30, 0), times=INT)


def digests(staged: DataFrame, keys: Sequence[str], part: Column) -> DataFrame:
    """One line per key and partition: the hash of its row, or the sum of those of repeated rows."""
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    # A map has no hash; none of the staging tables has one.
    rows = staged.select(key.alias("key"), part.cast("string").alias("part"), F.xxhash64(*staged.columns).alias("hash"))
    return rows.groupBy("key", "part").agg(
        F.sum(F.col("hash").cast("decimal(20,0)")).alias("digest"), F.count("*").alias("times")
    )


def changed_parts(old: DataFrame, new: DataFrame) -> DataFrame:
    """``part`` of every line that is in one of both only."""
    sides = old.withColumn("side", F.lit(1)).unionByName(new.withColumn("side", F.lit(-1)))
    same = ["key", "part", "digest", "times"]
    return sides.groupBy(*same).agg(F.sum("side").alias("side")).filter("side <> 0").select("part").distinct()


def refresh_mart(
    staged: DataFrame,
    root: str,
    name: str,
    keys: Sequence[str],
    part: Column,
    build: Callable[[DataFrame], DataFrame],
) -> int:
    """Bring the stored mart up to date with ``staged``; returns how many partitions were rewritten.

    ``build`` makes the mart's rows from staging rows; ``part`` must gather all rows that one
    of its rows depends on (the league, where ranks within leagues are built). A row whose
    ``part`` is NULL lies in a partition of its own kind. The mart has one column more,
    ``part``, as text.
    """
    spark = staged.sparkSession
    level = F.coalesce(part.cast("string"), F.lit("none"))
    new = settle(digests(staged, keys, level), "digests")
    old = open_table(spark, root, f"{name}_digests", _DIGESTS)
    # Numbers of partitions, not of rows; read several times.
    parts = settle(changed_parts(old, new), "parts")
    total = parts.count()
    if total:
        rows = staged.withColumn("part", level).join(parts, "part", "left_semi")
        made = build(rows.drop("part"))
        fresh = settle(made.withColumn("part", level), "fresh")
        path = live_path(spark, root, name)
        writer = fresh.hint("rebalance", "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        # Tasks move their files to the staging folder themselves; partitions are still replaced at the end.
        writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("part").parquet(path)
        # Partitions that have no rows any more; as a rule none.
        left = parts.join(fresh.select("part").distinct(), "part", "left_anti")
        remove_folders(spark, [f"{path}/part={_escaped(spark, row['part'])}" for row in left.toLocalIterator()])
        replace_table(new, root, f"{name}_digests")
    return total


def _escaped(spark, value: str) -> str:
    """A partition value as folders are named after it."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def read_mart(spark, root: str, name: str, schema: StructType) -> DataFrame:
    """The rows of a refreshed mart without their partition."""
    whole = StructType([*schema.fields, record(part=TEXT).fields[0]])
    # A task lists many folders: one for each of them takes the scheduler longer than the listing.
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(max(1, spark.sparkContext.defaultParallelism) * 4))
    try:
        return open_table(spark, root, name, whole, ["part"]).drop("part")
    finally:
        spark.conf.set(_LISTING, before)
