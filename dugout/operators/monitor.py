"""Pipeline series: message rates, backlog and counts. All work on batch and stream input."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from .series import asof


def message_rate(
    messages: DataFrame,
    time: str = "ts",
    topic: str = "topic",
    width: int = 300,
    slide: int | None = None,
) -> DataFrame:
    """Messages per second by topic and window of ``width`` seconds.

    ``slide`` starts a window every so many seconds, so that they overlap. In batch, the
    messages are then counted per slide first and only these counts are spread over the
    windows, where a direct sliding window would copy every message into each of them.
    """
    amount = F.lit(1)
    if slide and not messages.isStreaming and width % slide == 0:
        step = F.window(time, f"{slide} seconds")
        messages = messages.groupBy(step.alias("w"), F.col(topic)).agg(
            F.count("*").alias("__n")
        ).select(F.col("w.start").alias(time), topic, "__n")
        amount = F.col("__n")
    frame = F.window(time, f"{width} seconds", f"{slide or width} seconds")
    return (
        messages.groupBy(frame.alias("w"), F.col(topic))
        .agg(F.sum(amount).alias("n"))
        .select(
            F.col("w.start").alias("window_start"),
            topic,
            "n",
            (F.col("n") / F.lit(float(width))).alias("per_second"),
        )
    )


def backlog(landed: DataFrame, processed: DataFrame, key: str, topic: str) -> DataFrame:
    """Landed messages that were not processed yet, by topic."""
    return (
        landed.select(key, topic)
        .join(processed.select(key).distinct(), key, "left_anti")
        .groupBy(topic)
        .agg(F.count("*").alias("backlog"))
    )


def lag_by_partition(
    landed: DataFrame, reached: DataFrame, offset: str = "offset", group: str = "group"
) -> DataFrame:
    """Messages behind by consumer group, topic and partition.

    ``landed`` has a row per message with topic, partition and offset, ``reached`` the last
    offset that each group has done. A group that has done nothing of a partition is behind
    by all of it.
    """
    place = ["topic", "partition"]
    ends = landed.groupBy(*place).agg(F.max(offset).alias("end"), F.min(offset).alias("begin"))
    done = reached.groupBy(group, *place).agg(F.max(offset).alias("done"))
    every = reached.select(group, "topic").distinct().join(ends, "topic")
    behind = F.col("end") - F.coalesce("done", F.col("begin") - 1)
    return every.join(done, [group, *place], "left").select(group, *place, behind.alias("behind"))


def lag_by_group(lag: DataFrame, group: str = "group") -> DataFrame:
    """Messages behind by consumer group, over all its topics."""
    return lag.groupBy(group).agg(F.sum("behind").alias("behind"))


def lag_by_group_topic(lag: DataFrame, group: str = "group") -> DataFrame:
    """Messages behind by consumer group and topic."""
    return lag.groupBy(group, "topic").agg(F.sum("behind").alias("behind"))


def lag_over_time(ends: DataFrame, commits: DataFrame, time: str = "ts", group: str = "group") -> DataFrame:
    """Messages behind by consumer group, topic and partition at every time that the end of the
    log was sampled.

    ``ends`` has topic, partition, time and ``end``, the last offset then; ``commits`` has the
    group besides, and ``done``, the last offset that it had worked off. A group is behind by
    all that was sampled until its first commit. Groups follow the topics they commit to.
    """
    place = ["topic", "partition"]
    sampled = ends.groupBy(*place, time).agg(F.max("end").alias("end"))
    begin = sampled.groupBy(*place).agg(F.min("end").alias("begin"))
    groups = commits.select(group, "topic").distinct()  # a few per topic
    every = sampled.join(begin, place).join(groups, "topic")
    found = asof(every, commits, [group, *place], time, ["done"])
    behind = F.col("end") - F.coalesce("done", F.col("begin") - 1)
    return found.select(group, *place, time, behind.alias("behind"))


def topic_counts(messages: DataFrame, topic: str = "topic") -> DataFrame:
    """Messages per topic."""
    return messages.groupBy(topic).agg(F.count("*").alias("n_messages"))


def topic_total(messages: DataFrame, topic: str = "topic") -> DataFrame:
    """Number of topics that have messages."""
    return messages.agg(F.count_distinct(topic).alias("n_topics"))


def stream_lag(progress: Mapping) -> list[tuple[str, int, int]]:
    """``(topic, partition, messages behind)`` from a query's progress report.

    Reads the latest and the reached offsets that a topic source reports; sources
    without per-partition offsets give no lines.
    """
    import json

    def offsets(value):
        value = json.loads(value) if isinstance(value, str) else value
        return value if isinstance(value, Mapping) else {}

    lines = []
    for source in progress.get("sources", []):
        reached = offsets(source.get("endOffset"))
        for topic, parts in offsets(source.get("latestOffset")).items():
            if not isinstance(parts, Mapping):
                continue
            for part, latest in parts.items():
                done = reached.get(topic, {}).get(part, 0)
                lines.append((topic, int(part), int(latest) - int(done)))
    return sorted(lines)
