"""Stored tables: where they live, how they are read and written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.ranking import nulls_last
from .envelopes import FEEDS, Feed
from .schemas import TEXT, record
from .versions import live_path, live_version, new_version, publish, table_path, version_path


# Folder levels of a raw table.
LANDED = ("source", "batch", "run_id")
# Table of the runs that landed batches have.
RUNS = "runs"
RUN_SCHEMA = record(run_id=TEXT, table=TEXT, version=TEXT, source=TEXT, batch=TEXT)
# Version of a table that was never replaced, in its notes.
FIRST = "first"


def read_table(
    spark: SparkSession, root: str, name: str, schema: StructType | None = None
) -> DataFrame:
    """The current rows of a stored table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(live_path(spark, root, name))


def open_table(
    spark: SparkSession,
    root: str,
    name: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """A stored table that may not have been written yet; it is made empty then."""
    empty = spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*partition_by)
    path = live_path(spark, root, name)
    empty.parquet(path)
    return spark.read.schema(schema).parquet(path)


def replace_table(df: DataFrame, root: str, name: str, partition_by: Sequence[str] = ()) -> None:
    """Store a model, replacing what was there, all at once: if the new rows can't be written,
    the old ones stay."""
    version = new_version()
    df.write.partitionBy(*partition_by).parquet(version_path(root, name, version))
    publish(df.sparkSession, root, name, version)


def append_table(df: DataFrame, root: str, name: str, partition_by: str | None = None) -> None:
    """Add rows to a stored model and keep what was there.

    With ``partition_by`` the rows are rebalanced on that column first, so that a
    partition gets a few files of decent size and not one from every task.
    """
    path = live_path(df.sparkSession, root, name)
    if partition_by:
        df.hint("rebalance", partition_by).write.mode("append").partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("append").parquet(path)


def save_model(df: DataFrame, name: str, materialized: str = "table") -> None:
    """A model in the session catalog: a stored table, or a view evaluated on read."""
    if materialized == "view":
        df.createOrReplaceTempView(name)
    else:
        df.write.mode("overwrite").saveAsTable(name)


def raw_schema(feed: Feed) -> StructType:
    """Columns of a raw table: the feed's, and where the row came from."""
    schema = StructType(list(feed.schema.fields))
    for name in LANDED:
        schema = schema.add(name, "string")
    return schema


def note_runs(runs: DataFrame, root: str, name: str, version: str, source: str, batch: str) -> None:
    """Write down the run ids that a landed batch of a table's version has; a batch replaces its
    own note. Notes of other versions count no more."""
    path = f"{table_path(root, RUNS)}/table={name}/version={version or FIRST}/source={source}/batch={batch}"
    runs.select("run_id").coalesce(1).write.mode("overwrite").parquet(path)


def read_raw(spark: SparkSession, root: str, feed: Feed | str, history: bool = False) -> DataFrame:
    """A raw table: the latest run's snapshot for replaced feeds, all rows for the others.

    The latest run id is looked up in the notes of the landed batches of the table's current
    version, one line each, so only its partitions of the raw table are opened.
    """
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    version = live_version(spark, root, feed.table)
    rows = open_table(spark, root, feed.table, raw_schema(feed), LANDED)
    if not feed.replace or history:
        return rows
    noted = open_table(spark, root, RUNS, RUN_SCHEMA, ["table", "version", "source", "batch"])
    own = noted.filter((F.col("table") == feed.table) & (F.col("version") == (version or FIRST)))
    latest = own.agg(F.max("run_id")).first()[0]  # one value
    return rows.filter(F.col("run_id") == F.lit(latest))


def run_query(spark: SparkSession, sql: str, **args) -> DataFrame:
    """Ad-hoc SQL with named parameters (``:name``)."""
    return spark.sql(sql, args=args) if args else spark.sql(sql)


def standings_order() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in ("league_name", "division_name", "division_rank")]


def player_stats_order() -> list[Column]:
    return [nulls_last("ops", desc=True)]


def game_results_order() -> list[Column]:
    return [F.col("game_date").desc_nulls_first()]


def pitching_leaders_order(starters_first: bool = False) -> list[Column]:
    """By role name as the reports read it, or starters first as the mart is defined."""
    role: Column = F.when(F.col("role") == "Starter", 1).otherwise(2) if starters_first else F.col("role")
    return [role.asc_nulls_last(), nulls_last("era")]


def standings_in_order(mart: DataFrame) -> DataFrame:
    return mart.orderBy(*standings_order())


def player_stats_in_order(mart: DataFrame) -> DataFrame:
    return mart.orderBy(*player_stats_order())


def game_results_in_order(mart: DataFrame) -> DataFrame:
    return mart.orderBy(*game_results_order())


def pitching_leaders_in_order(mart: DataFrame, starters_first: bool = False) -> DataFrame:
    return mart.orderBy(*pitching_leaders_order(starters_first))


def qualified(df: DataFrame, metric: str, floor: float, columns: list[str]) -> DataFrame:
    """Projected scan with a threshold; both reach the file reader."""
    return df.filter(F.col(metric) >= F.lit(floor)).select(*columns)
