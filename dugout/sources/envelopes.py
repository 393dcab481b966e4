"""Keyed JSON messages: one envelope per feed row, and back."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from ..functions.parse import composite_key, or_default
from .schemas import RAW

CORRUPT = "_corrupt"


@dataclass(frozen=True)
class Feed:
    """How a feed travels: topic and table name, key, and whether a run replaces it."""

    name: str
    key: Callable[[], Column]
    replace: bool
    schema: StructType = field(repr=False)

    @property
    def table(self) -> str:
        return f"raw_{self.name}"


def _feed(name: str, key: Callable[[], Column], replace: bool) -> Feed:
    return Feed(name, key, replace, RAW[name])


def _plain(column: str) -> Callable[[], Column]:
    return lambda: F.col(column).cast("string")


# Snapshots are replaced by each run; schedule and plays accumulate.
FEEDS = {
    feed.name: feed
    for feed in (
        _feed("teams", _plain("team_id"), True),
        _feed("standings", _plain("team_id"), True),
        _feed("schedule", _plain("game_pk"), False),
        _feed(
            "game_events",
            lambda: composite_key("game_pk", or_default("at_bat_index", 0)),
            False,
        ),
        _feed("hitting_stats", _plain("player_id"), True),
        _feed("pitching_stats", _plain("player_id"), True),
    )
}


def to_messages(
    rows: DataFrame, feed: Feed, run_id: str, ts: Column, prefix: str = ""
) -> DataFrame:
    """Rows as envelopes; missing values are written as null, not left out.

    ``prefix`` goes in front of the topic name, to match an existing naming scheme.
    """
    return rows.select(
        F.lit(prefix + feed.name).alias("topic"),
        feed.key().alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"),
        ts.cast("timestamp").alias("ts"),
        F.lit(run_id).alias("run_id"),
    )


def decode(messages: DataFrame, schema: StructType) -> DataFrame:
    """Parse message values next to the envelope: ``row`` struct and ``is_bad`` flag.

    Good is exactly one JSON object of the expected shape; a valid row of NULLs is not bad.
    Missing and blank text, other JSON values, and text behind the object are bad. A parser
    stops behind the first value, so the text is put into an object of its own that ends with
    the text's checksum: only if nothing follows the text's object is the checksum reached.
    """
    whole = StructType().add("row", schema).add("end", "string").add(CORRUPT, "string")
    end = F.md5("value")
    wrapped = F.concat(F.lit('{"row":'), F.col("value"), F.lit(',"end":"'), end, F.lit('"}'))
    parsed = F.from_json(wrapped, whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    read = messages.withColumn("__read", parsed)
    good = F.col("__read.row").isNotNull() & F.col(f"__read.{CORRUPT}").isNull() & (F.col("__read.end") == end)
    return read.select(
        *messages.columns, F.col("__read.row").alias("row"), (~F.coalesce(good, F.lit(False))).alias("is_bad")
    )


def good_rows(decoded: DataFrame, schema: StructType) -> DataFrame:
    """The parsed columns of readable messages, with their envelope's run id."""
    return decoded.filter(~F.col("is_bad")).select(
        *[F.col(f"row.{name}").alias(name) for name in schema.names], "run_id"
    )


def bad_rows(decoded: DataFrame) -> DataFrame:
    """The envelopes of unreadable messages."""
    return decoded.filter("is_bad").select("topic", "key", "value", "ts", "run_id")


def topic_options(
    servers: str, topics: list[str], max_offsets: int | None = None
) -> dict[str, str]:
    """Reader options for a topic source that starts at the earliest message."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def from_topics(raw: DataFrame, prefix: str = "") -> DataFrame:
    """Envelopes from the columns a topic source delivers; the run id is a message header."""
    run = F.filter(F.col("headers"), lambda h: h["key"] == F.lit("run_id"))
    return raw.select(
        F.regexp_replace("topic", f"^{prefix}", "").alias("topic") if prefix else F.col("topic"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ts"),
        F.get(run, F.lit(0))["value"].cast("string").alias("run_id"),
    )


def read_topics(
    spark: SparkSession, servers: str, max_offsets: int | None = None, prefix: str = ""
) -> DataFrame:
    """Stream of envelopes from the six topics. Needs the Kafka connector on the class path."""
    topics = [prefix + name for name in FEEDS]
    reader: DataStreamReader = spark.readStream.format("kafka").option("includeHeaders", "true")
    return from_topics(reader.options(**topic_options(servers, topics, max_offsets)).load(), prefix)


def to_topics(messages: DataFrame) -> DataFrame:
    """The columns a topic sink takes."""
    header = F.array(
        F.struct(F.lit("run_id").alias("key"), F.col("run_id").cast("binary").alias("value"))
    )
    return messages.select("topic", "key", "value", header.alias("headers"))


def write_topics(messages: DataFrame, servers: str) -> None:
    """Publish envelopes. Needs the Kafka connector on the class path."""
    (
        to_topics(messages)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("includeHeaders", "true")
        .save()
    )
