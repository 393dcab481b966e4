"""Land message envelopes in the raw tables, streamed or in one batch.

A raw table is a folder of batch folders, each split by run id:
``raw_teams/source=feed/batch=12/run_id=2026-04-01T10/...``. A micro-batch owns its
folder and overwrites it, so a batch that is replayed after a failure lands once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import CheckFailed
from ..session import settle
from ..sources import schemas
from ..sources.envelopes import FEEDS, Feed, bad_rows, decode, good_rows
from ..sources.schemas import ENVELOPE
from ..sources.tables import LANDED, note_runs, open_table
from ..sources.versions import live_path, live_version, new_version, publish, table_path, version_path

QUARANTINE = "quarantine"
LANDING = "landing"
# Topic of the counts of messages that no feed has asked for.
UNKNOWN = "unknown"


def read_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of envelopes landed as JSON lines; ``max_files`` limits a micro-batch."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def write_messages(messages: DataFrame, path: str) -> int:
    """Append envelopes as JSON lines, where no connector to a message log is at hand.

    Returns how many, counted while they are written.
    """
    sent = Observation()
    counted = messages.observe(sent, F.count("*").alias("n"))
    counted.write.mode("append").option("ignoreNullFields", "false").json(path)
    return sent.get["n"]


def _store(rows: DataFrame, root: str, name: str, source: str, batch: str) -> None:
    path = live_path(rows.sparkSession, root, name)
    rows.write.mode("overwrite").partitionBy("run_id").parquet(f"{path}/source={source}/batch={batch}")


def land_batch(
    messages: DataFrame,
    root: str,
    source: str,
    batch: str,
    feeds: Iterable[Feed] = tuple(FEEDS.values()),
) -> None:
    """Route one batch of envelopes to its tables, and count its messages in ``landing``.

    Unreadable messages and messages of unknown topics go to the quarantine table. Every
    table is written from the batch's own stored copy, so a topic's good rows are decoded
    once. The counts are written last: a batch without counts did not end.
    """
    spark, feeds = messages.sparkSession, tuple(feeds)
    known = F.col("topic").isin([f.name for f in feeds])
    rows = settle(messages, "batch")
    present = {r["topic"] for r in rows.filter(known).select("topic").distinct().collect()}  # of the feeds
    lines = []
    for feed in (f for f in feeds if f.name in present):
        seen, stored = Observation(), Observation()
        decoded = decode(rows.filter(F.col("topic") == feed.name), feed.schema).observe(
            seen, F.count("*").alias("n"), F.count_if("is_bad").alias("bad")
        )
        # The runs are gathered while the rows are written, so that no row is read again.
        good = good_rows(decoded, feed.schema).observe(stored, F.collect_set("run_id").alias("runs"))
        _store(good, root, feed.table, source, batch)
        runs = spark.createDataFrame([(run,) for run in stored.get["runs"]], "run_id string")  # of one batch
        note_runs(runs, root, feed.table, live_version(spark, root, feed.table), source, batch)
        if seen.get["bad"]:
            _store(bad_rows(decoded), root, QUARANTINE, f"{source}-{feed.name}", batch)
        lines.append((feed.name, seen.get["n"], seen.get["bad"]))
    unknown = rows.filter(~F.coalesce(known, F.lit(False)))
    if not unknown.isEmpty():
        seen = Observation()
        _store(unknown.observe(seen, F.count("*").alias("n")), root, QUARANTINE, f"{source}-{UNKNOWN}", batch)
        lines.append((UNKNOWN, seen.get["n"], seen.get["n"]))
    counts = spark.createDataFrame(lines, "topic string, n_messages long, n_bad long")
    path = f"{table_path(root, LANDING)}/source={source}/batch={batch}"
    counts.coalesce(1).write.mode("overwrite").parquet(path)


def land_stream(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    source: str = "feed",
    feeds: Iterable[Feed] = tuple(FEEDS.values()),
) -> StreamingQuery:
    """Drain what has arrived since the last run, then stop.

    The checkpoint remembers the position; ``source`` belongs to the checkpoint and
    keeps its batch folders apart from those of other streams. Unreadable messages never
    fail a batch, which would come again for ever; ``require_readable`` looks at the counts
    after the drain.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        land_batch(batch, root, source, f"{batch_id:012d}", feeds)

    return (
        messages.writeStream.foreachBatch(route)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def landing_counts(spark: SparkSession, root: str) -> DataFrame:
    """Messages and bad messages of every landed batch by topic."""
    schema = schemas.record(topic=schemas.TEXT, n_messages=schemas.INT, n_bad=schemas.INT, source=schemas.TEXT, batch=schemas.TEXT)
    return open_table(spark, root, LANDING, schema, ["source", "batch"])


def last_batch(spark: SparkSession, root: str, source: str = "feed") -> str:
    """The newest counted batch of a stream, an empty text before the first."""
    newest = landing_counts(spark, root).filter(F.col("source") == source).agg(F.max("batch")).first()[0]
    return newest or ""


def require_readable(spark: SparkSession, root: str, after: str, source: str = "feed") -> None:
    """Raise if batches after ``after`` had unreadable messages. All of them are stored."""
    new = landing_counts(spark, root).filter((F.col("source") == source) & (F.col("batch") > after))
    bad = new.groupBy("topic").agg(F.sum("n_bad").alias("n")).filter("n > 0").orderBy("topic").collect()
    if bad:  # a line per topic
        raise CheckFailed("unreadable messages: " + ", ".join(f"{r['topic']} {r['n']}" for r in bad))


def land_rows(rows: DataFrame, root: str, feed: Feed, run_id: str) -> None:
    """Store flattened rows without a message log in between.

    They replace whatever the table held, also where a run's messages are appended, and
    whatever its runs were called. A write that fails leaves the old rows.
    """
    spark, version = rows.sparkSession, new_version()
    typed = rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in feed.schema.fields],
        F.lit(run_id).alias("run_id"),
    )
    whole = typed.withColumns({"source": F.lit("direct"), "batch": F.lit(run_id)})
    whole.write.partitionBy(*LANDED).parquet(version_path(root, feed.table, version))
    note_runs(spark.createDataFrame([(run_id,)], "run_id string"), root, feed.table, version, "direct", run_id)
    publish(spark, root, feed.table, version)
