"""Streams: each query runs a stream over the whole event table until it is drained,
writes to the shared scratch folder and returns what was written."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import quality
from ..operators.monitor import topic_counts
from ..plans import staging
from ..session import scratch_path
from ..sources import schemas
from ..sources.envelopes import Feed, to_messages
from ..sources.tables import raw_schema, read_table
from ..streaming import land, live
from .registry import case, table
from .roles import EVENT_TYPES, PLAYS_SQL, as_raw_plays

EVENT_FEEDS = tuple(
    Feed(kind, lambda: F.col("event_id").cast("string"), False, schemas.flat("event_id value"))
    for kind in EVENT_TYPES
)


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as a stream, whether it is one file or a folder of files."""
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/events.parquet*")


def _messages(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("topic"),
        F.col("event_id").cast("string").alias("key"),
        F.to_json(F.struct("event_id", "value")).alias("value"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("r1").alias("run_id"),
    )


def _landed(spark: SparkSession, root: str) -> DataFrame:
    tables = [
        read_table(spark, root, feed.table, raw_schema(feed)).withColumn("topic", F.lit(feed.name))
        for feed in EVENT_FEEDS
    ]
    return reduce(DataFrame.unionByName, tables)


@case("""
    SELECT event_type AS topic, count(*) AS n_messages, sum(event_id)::BIGINT AS ids,
           sum(value::DECIMAL(18,2))::DOUBLE AS total
    FROM events GROUP BY event_type""")
def stream_route(spark, folder):
    """A message stream routed to one raw table per topic."""
    root = scratch_path(spark, "route")
    stream = _messages(_event_stream(spark, folder))
    land.land_stream(
        stream, f"{root}/tables", f"{root}/checkpoint", feeds=EVENT_FEEDS
    ).awaitTermination()
    return (
        _landed(spark, f"{root}/tables")
        .groupBy("topic")
        .agg(
            F.count("*").alias("n_messages"),
            F.sum("event_id").cast("bigint").alias("ids"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        )
    )


@case("SELECT event_type AS topic, count(*) AS n_messages FROM events GROUP BY event_type")
def stream_resume_no_repeat(spark, folder):
    """Messages that arrive in two parts, drained by three runs on one checkpoint."""
    root = scratch_path(spark, "resume")
    messages = _messages(table(spark, folder, "events"))
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    for part in (messages.filter(early), messages.filter(~early), None):
        if part is not None:
            land.write_messages(part, f"{root}/messages")
        stream = land.read_messages(spark, f"{root}/messages")
        land.land_stream(
            stream, f"{root}/tables", f"{root}/checkpoint", feeds=EVENT_FEEDS
        ).awaitTermination()
    return topic_counts(_landed(spark, f"{root}/tables"))


@case(PLAYS_SQL)
def stream_game_events(spark, folder):
    """The play staging model on a stream in which every play comes twice, in two files each."""
    root = scratch_path(spark, "plays")
    lines = table(spark, folder, "lineitem")
    lines.unionByName(lines).write.parquet(f"{root}/landed")
    stream = spark.readStream.schema(lines.schema).parquet(f"{root}/landed")
    live.stage_plays(as_raw_plays(stream), root, f"{root}/checkpoint").awaitTermination()
    columns = staging.typed_events(as_raw_plays(lines)).schema
    return read_table(spark, root, "stg_game_events", columns).drop("game_block", "batch")


@case("""
    SELECT event_type AS topic, count(*) AS n_messages, count_if(value < 10)::BIGINT AS n_bad FROM events
    WHERE event_type <> 'signup' GROUP BY event_type
    UNION ALL
    SELECT 'unknown', count(*), count(*) FROM events WHERE event_type = 'signup' HAVING count(*) > 0""")
def landing_counts(spark, folder):
    """Landed and unreadable messages by topic; nobody has asked for one of the topics."""
    root = scratch_path(spark, "counts")
    sent = _messages(_event_stream(spark, folder))
    low = F.get_json_object("value", "$.value").cast("double") < 10
    sent = sent.withColumn("value", F.when(low, F.lit("{} x")).otherwise(F.col("value")))
    known = tuple(feed for feed in EVENT_FEEDS if feed.name != "signup")
    land.land_stream(sent, f"{root}/tables", f"{root}/checkpoint", feeds=known).awaitTermination()
    counts = land.landing_counts(spark, f"{root}/tables").groupBy("topic")
    return counts.agg(F.sum("n_messages").alias("n_messages"), F.sum("n_bad").alias("n_bad"))


@case("SELECT event_id, event_type, value FROM events")
def stream_dedup(spark, folder):
    """Every message sent twice, stored once."""
    root = scratch_path(spark, "dedup")
    once = _event_stream(spark, folder).select("event_id", "event_type", "value")
    twice = once.union(_event_stream(spark, folder).select("event_id", "event_type", "value"))
    live.append_unseen(twice, root, "events", f"{root}/checkpoint", "event_id").awaitTermination()
    return read_table(spark, root, "events", once.schema)


@case("""
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS n,
           round(count(*) / 300, 6) AS per_second
    FROM events GROUP BY 1, 2""")
def stream_rate_5m(spark, folder):
    """Five-minute message rates computed on the stream."""
    root = scratch_path(spark, "rate")
    events = _event_stream(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    rates = live.rate_stream(events, "ts", "event_type")
    live.store_windows(rates, f"{root}/rates", f"{root}/checkpoint").awaitTermination()
    latest = live.latest_windows(spark, f"{root}/rates", rates.schema, ["window_start", "event_type"])
    return latest.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "event_type", "n", F.round("per_second", 6).alias("per_second"),
    )


@case("""
    SELECT 'early' AS feed, count_if(c_acctbal <= 0)::BIGINT AS published, count_if(c_acctbal <= 0)::BIGINT AS read FROM customer
    UNION ALL SELECT 'late', count(*), count(*) FROM customer""")
def publish_counts(spark, folder):
    """Messages published per feed, as counted while they were written and as read again."""
    root = scratch_path(spark, "published")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    rows = {"early": customers.filter("c_acctbal <= 0"), "late": customers}
    key = lambda: F.col("c_custkey").cast("string")
    sent = {
        name: land.write_messages(to_messages(df, Feed(name, key, True, df.schema), "r1", F.lit(datetime(2026, 4, 1))), root)
        for name, df in rows.items()
    }
    counted = spark.createDataFrame(sorted(sent.items()), "feed string, published long")
    read = topic_counts(spark.read.schema(schemas.ENVELOPE).json(root)).select(F.col("topic").alias("feed"), F.col("n_messages").alias("read"))
    return counted.join(read, "feed")


@case("SELECT 4::BIGINT AS batches, count(*) AS n_messages, 1::BIGINT AS most_files FROM events")
def micro_batch_size(spark, folder):
    """Messages in four files, read one file a micro-batch."""
    root = scratch_path(spark, "batches")
    land.write_messages(_messages(table(spark, folder, "events")).repartition(4), f"{root}/messages")
    stream = land.read_messages(spark, f"{root}/messages", max_files=1)
    land.land_stream(stream, f"{root}/tables", f"{root}/checkpoint", feeds=EVENT_FEEDS).awaitTermination()
    counts = land.landing_counts(spark, f"{root}/tables")
    files = spark.read.schema(schemas.ENVELOPE).json(f"{root}/messages").select(F.input_file_name().alias("f")).distinct()
    batches = F.count_distinct("batch").cast("bigint")
    found = counts.agg(batches.alias("batches"), F.sum("n_messages").alias("n_messages"))
    each = files.agg(F.count("*").alias("files"))
    return found.crossJoin(each).select("batches", "n_messages", F.ceil(F.col("files") / F.col("batches")).alias("most_files"))


@case("""
    SELECT 'complete' AS input_name, count(*) AS n_rows, NULL AS missing FROM customer
    UNION ALL SELECT 'short', NULL, 'short: missing expected columns [''c_phone'', ''nothing'']'""")
def required_columns(spark, folder):
    """An input with all required columns, and one without two of them, which is refused."""
    customers = table(spark, folder, "customer")
    report = quality.input_report(customers, "complete", ["c_custkey", "c_name"])
    try:
        quality.input_report(customers.select("c_custkey"), "short", ["c_custkey", "c_phone", "nothing"])
        refused = None
    except quality.CheckFailed as error:
        refused = str(error)
    lines = spark.createDataFrame([("short", None, refused)], "input_name string, n_rows long, missing string")
    return report.select("input_name", "n_rows", F.lit(None).cast("string").alias("missing")).unionByName(lines)
