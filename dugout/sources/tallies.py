"""What the checks need to know of a table, kept by batch as it lands.

A batch leaves one line: its rows, the NULLs of each column and its newest moment, all counted
while it is written. Lines add up, so volume, null and freshness checks read a line per batch and
not the table. A batch that is landed again replaces its rows and its line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import LongType, MapType, StringType, TimestampNTZType

from .schemas import INT, TEXT, record
from .tables import open_table
from .versions import live_path, table_path

TALLIES = "tallies"
_LINE = record(n_rows=LongType(), nulls=MapType(StringType(), LongType()), newest=INT)
_STORED = record(n_rows=LongType(), nulls=MapType(StringType(), LongType()), newest=TimestampNTZType(), table=TEXT, batch=TEXT)


def land_counted(
    rows: DataFrame, root: str, name: str, batch: str, columns: Sequence[str], newest: str | None = None
) -> None:
    """Store a batch of a table with the line of its counts, in one pass over its rows.

    ``columns`` are those whose NULLs are counted, ``newest`` a moment of which the greatest is
    kept. The line is written last: a batch without a line did not end.
    """
    spark, seen = rows.sparkSession, Observation()
    latest = F.lit(None).cast("long") if newest is None else F.unix_micros(F.col(newest).cast("timestamp"))
    nulls = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]
    counted = rows.observe(seen, F.count("*").alias("n_rows"), F.max(latest).alias("newest"), *nulls)
    counted.write.mode("overwrite").parquet(f"{live_path(spark, root, name)}/batch={batch}")
    got = seen.get
    line = (got["n_rows"], {c: got[f"n{i}"] for i, c in enumerate(columns)}, got["newest"])
    moment = F.timestamp_micros("newest").cast("timestamp_ntz").alias("newest")
    made = spark.createDataFrame([line], _LINE).select("n_rows", "nulls", moment)
    made.coalesce(1).write.mode("overwrite").parquet(f"{table_path(root, TALLIES)}/table={name}/batch={batch}")


def read_tallies(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The lines of all batches of a table. ``quality.freshness`` takes them, by ``newest``."""
    return open_table(spark, root, TALLIES, _STORED, ["table", "batch"]).filter(F.col("table") == name)


def kept_counts(lines: DataFrame) -> DataFrame:
    """``table_name`` and ``n_rows``; a table without batches has no line."""
    return lines.groupBy(F.col("table").alias("table_name")).agg(F.sum("n_rows").alias("n_rows"))


def kept_nulls(lines: DataFrame) -> DataFrame:
    """``column, n_rows, n_nulls, null_pct`` as ``quality.null_profile`` gives them."""
    each = lines.select("n_rows", F.explode("nulls").alias("column", "n_nulls"))
    sums = each.groupBy("column").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"))
    return sums.withColumn("null_pct", F.try_divide(F.col("n_nulls") * F.lit(100.0), F.col("n_rows")))
