"""Series over time: rates of counters with resets, and how far consumers were behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.monitor import lag_over_time
from ..operators.series import counter_increases, window_rates
from ..session import scratch_path
from ..streaming import live
from .registry import case, table

_SERIES = ["topic", "partition"]

_RATE_SQL = """
    WITH samples AS (SELECT event_type AS topic, user_id % 4 AS partition, ts, max(event_id % 3000) AS total
        FROM events GROUP BY ALL),
    steps AS (SELECT *, lag(ts) OVER series AS since, lag(total) OVER series AS held FROM samples
        WINDOW series AS (PARTITION BY topic, partition ORDER BY ts)),
    increases AS (SELECT topic, partition, epoch_us(since) AS a, epoch_us(ts) AS b,
        CASE WHEN total >= held THEN total - held ELSE total END AS increase FROM steps WHERE since IS NOT NULL),
    parts AS (SELECT *, unnest(range(a // 300000000, (b - 1) // 300000000 + 1)) AS w FROM increases)
    SELECT make_timestamp(w * 300000000) AS window_start, topic, partition,
        round(sum(increase * ((least(b, (w + 1) * 300000000) - greatest(a, w * 300000000))::DOUBLE / (b - a))) / 300, 6) AS per_second
    FROM parts GROUP BY ALL"""


def _samples(events: DataFrame) -> DataFrame:
    """Counters by topic and partition that start anew every three thousand messages."""
    return events.select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).alias("partition"),
        F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 3000).alias("total"),
    )


def _shown(rates: DataFrame) -> DataFrame:
    return rates.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), *_SERIES,
        F.round("per_second", 6).alias("per_second"),
    )


@case(_RATE_SQL)
def counter_rate_5m(spark: SparkSession, folder: str) -> DataFrame:
    """Five-minute rates of sampled counters, resets and window edges included."""
    increases = counter_increases(_samples(table(spark, folder, "events")), _SERIES)
    return _shown(window_rates(increases, _SERIES))


@case(_RATE_SQL)
def stream_counter_rate_5m(spark: SparkSession, folder: str) -> DataFrame:
    """The same on a stream, with the last sample of every counter as its state."""
    root = scratch_path(spark, "counters")
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/events.parquet*")
    increases = live.stream_increases(_samples(stream), _SERIES)
    live.store_increases(increases, f"{root}/increases", f"{root}/checkpoint").awaitTermination()
    stored = spark.read.schema(increases.schema).parquet(f"{root}/increases").drop("batch")
    return _shown(window_rates(stored, _SERIES))


@case("""
    WITH ends AS (SELECT event_type AS topic, user_id % 4 AS partition, ts, max(event_id) AS "end" FROM events GROUP BY ALL),
    commits AS (SELECT event_id % 3 AS g, event_type AS topic, user_id % 4 AS partition, ts, max(event_id) AS done
        FROM events WHERE value < 5 GROUP BY ALL),
    begins AS (SELECT topic, partition, min("end") AS b FROM ends GROUP BY ALL),
    every AS (SELECT g, ends.*, b FROM (SELECT DISTINCT g, topic FROM commits) t JOIN ends USING (topic) JOIN begins USING (topic, partition))
    SELECT e.g AS "group", e.topic, e.partition, e.ts, e."end" - coalesce(c.done, b - 1) AS behind
    FROM every e ASOF LEFT JOIN commits c
        ON e.g = c.g AND e.topic = c.topic AND e.partition = c.partition AND e.ts >= c.ts""")
def backlog_over_time(spark: SparkSession, folder: str) -> DataFrame:
    """How far each of three groups was behind whenever a message came."""
    events = table(spark, folder, "events")
    place = [F.col("event_type").alias("topic"), (F.col("user_id") % 4).alias("partition"), "ts"]
    ends = events.select(*place, F.col("event_id").alias("end"))
    low = events.filter(F.col("value") < 5)
    commits = low.select((F.col("event_id") % 3).alias("group"), *place, F.col("event_id").alias("done"))
    return lag_over_time(ends, commits)
