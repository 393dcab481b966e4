"""Streaming forms of incremental staging, deduplication and message rates."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType, TimestampType

from ..operators.bitmaps import keep_unmarked, merge_bitmaps, seen_bitmaps
from ..operators.dedup import columns_as_order, keep_first, keep_unseen
from ..operators.monitor import message_rate
from ..plans.staging import single_plays
from ..session import settle
from ..sources.schemas import INT, TEXT, record
from ..sources.tables import append_table, open_table
from ..sources.versions import live_path


def append_unseen(
    stream: DataFrame,
    root: str,
    table: str,
    checkpoint: str,
    key: str,
    prune_by: str | None = None,
    order: Callable[[DataFrame], Sequence[Column]] | None = None,
) -> StreamingQuery:
    """Add rows with new keys to a table; the first row stored for a key stays.

    Of the copies in one batch the first in ``order`` stays, by default that of all columns.
    No watermark: a key is refused however late its copy comes. A replayed batch finds
    its keys in the table and adds nothing. ``prune_by`` partitions the table, so that a
    batch reads the keys of the partitions it touches and not the whole history.
    """

    levels = [prune_by] if prune_by else []

    def add(batch: DataFrame, _: int) -> None:
        known = open_table(batch.sparkSession, root, table, batch.schema, levels)
        first = order(batch) if order else columns_as_order(batch, [key])
        single = keep_first(batch, [key], first)
        append_table(keep_unseen(single, known, key, prune_by), root, table, prune_by)

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


PLAY_LEVELS = ("batch",)
SEEN_SCHEMA = record(game_pk=INT, game_block=INT, bucket=INT, bits=BinaryType(), batch=TEXT)


def seen_table(table: str) -> str:
    """Table of the bitmaps of the plays that ``table`` holds."""
    return f"{table}_seen"


def add_plays(raw: DataFrame, root: str, batch: str, table: str = "stg_game_events") -> None:
    """Add the plays of a batch that the table does not hold yet.

    The copies within the batch go first, and what remains is written, so the raw plays are read
    once. What the table holds is looked up in the bitmaps of the batches before, of the blocks
    of games that occur in this one. Plays and then bitmaps are written to folders of the batch's
    own, which a replay overwrites; it leaves out its own bitmaps and finds the same plays. Files
    are sorted by block: their statistics tell where one lies, and there are as many as the rows
    fill, however many blocks a batch has.
    """
    spark = raw.sparkSession
    stored = open_table(spark, root, seen_table(table), SEEN_SCHEMA, PLAY_LEVELS)
    arrived = settle(single_plays(raw), "plays")
    least, most = arrived.agg(F.min("game_block"), F.max("game_block")).first()  # one row
    others = stored.filter((F.col("batch") != batch) & F.col("game_block").between(F.lit(least), F.lit(most)))
    fresh = arrived
    if not others.isEmpty():
        known = others.join(arrived.select("game_block").distinct(), "game_block", "left_semi")
        fresh = keep_unmarked(arrived, merge_bitmaps(known, "game_pk"), "game_pk", "at_bat_index")
    path, seen = (f"{live_path(spark, root, name)}/batch={batch}" for name in (table, seen_table(table)))
    fresh.sortWithinPartitions("game_block").write.mode("overwrite").parquet(path)
    written = spark.read.schema(fresh.schema).parquet(path)
    bitmaps = seen_bitmaps(written, "game_pk", "at_bat_index", ["game_block"])
    bitmaps.repartitionByRange("game_block").sortWithinPartitions("game_block").write.mode("overwrite").parquet(seen)


def stage_plays(raw: DataFrame, root: str, checkpoint: str, table: str = "stg_game_events") -> StreamingQuery:
    """The play staging model on a stream of raw plays.

    Types, keys and the choice among copies are those of ``staging.stg_game_events``; copies
    that come in later batches are refused, however late they are.
    """
    return (
        raw.writeStream.foreachBatch(lambda batch, number: add_plays(batch, root, f"{number:012d}", table))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedup_within(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """First arrival per key with bounded state.

    Keys are forgotten ``delay`` after their event time, and rows later than that are
    dropped. ``append_unseen`` has neither limit. ``time`` must be a zoned timestamp.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def rate_stream(
    stream: DataFrame,
    time: str = "ts",
    topic: str = "topic",
    width: int = 300,
    slide: int | None = None,
    delay: str = "10 minutes",
) -> DataFrame:
    """Windowed message rate on a stream; the watermark bounds the open windows.

    Messages that come more than ``delay`` behind the newest one are dropped.
    """
    return message_rate(stream.withWatermark(time, delay), time, topic, width, slide)


def stream_increases(
    samples: DataFrame, by: Sequence[str], time: str = "ts", value: str = "total", idle: str = "1 day"
) -> DataFrame:
    """``by``, ``since``, ``time`` and ``increase`` of counters, as ``counter_increases`` has them.

    The state of a counter is its last sample. A timer removes it once the watermark, an
    ``idle`` time behind the newest sample, has passed it; a counter that comes back later
    begins anew. Samples that are not newer than the last one of their counter are left out.
    ``time`` must be a zoned timestamp.
    """
    zoned = StructType([samples.schema[c] for c in by])
    schema = StructType([*zoned.fields, StructField("since", TimestampType()), samples.schema[time], StructField("increase", DoubleType())])
    last = StructType([StructField("at", LongType()), StructField("value", DoubleType())])

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        at, held = state.get if state.exists else (None, None)
        rows = pd.concat(frames).groupby(time, as_index=False)[value].max().sort_values(time)
        moments = rows[time].astype("int64") // (1000 if rows[time].dtype == "datetime64[ns]" else 1)
        if at is not None:
            rows, moments = rows[moments > at], moments[moments > at]
        if not len(rows):
            return
        values = rows[value].astype(float)
        before, since = values.shift(), rows[time].shift()
        if at is not None:
            before.iloc[0], since.iloc[0] = held, pd.Timestamp(at, unit="us")
        increase = (values - before).where(values >= before, values)
        made = pd.DataFrame({**dict(zip(by, key)), "since": since, time: rows[time], "increase": increase})
        newest = int(moments.iloc[-1])
        state.update((newest, float(values.iloc[-1])))
        state.setTimeoutTimestamp(max(newest // 1000, state.getCurrentWatermarkMs()) + 1)
        yield made[before.notna().to_numpy()]

    fine = samples.filter(F.col(time).isNotNull() & F.col(value).isNotNull())
    fine = fine.withWatermark(time, idle).select(*by, time, F.col(value).cast("double").alias(value))
    return fine.groupBy(*by).applyInPandasWithState(step, schema, last, "append", GroupStateTimeout.EventTimeTimeout)


def store_increases(increases: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write increases as they come; a replayed batch overwrites its folder."""
    return (
        increases.writeStream.foreachBatch(lambda rows, number: rows.write.mode("overwrite").parquet(f"{path}/batch={number:012d}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def store_windows(rates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write windows as they change; ``latest_windows`` reads the last state of each.

    Update mode also delivers windows that are still open, which append mode holds back.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")

    return (
        rates.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_windows(
    spark: SparkSession, path: str, schema: StructType, keys: list[str]
) -> DataFrame:
    """The newest stored state of every window."""
    with_batch = StructType(list(schema.fields)).add("batch", "string")
    stored = spark.read.schema(with_batch).parquet(path)
    return keep_first(stored, keys, [F.col("batch").desc()]).drop("batch")
