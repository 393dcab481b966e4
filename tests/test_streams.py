import json
import os

import pytest
from conftest import listed
from pyspark.sql import functions as F

from dugout.operators.quality import CheckFailed
from dugout.sources.tables import read_raw, read_table
from dugout.streaming import land, live

SCHEMA = "id bigint, block bigint, ts timestamp, topic string"


def send(folder, name, *messages):
    os.makedirs(folder, exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(m) for m in messages))


def message(topic, key, run="r1", value=None):
    return {"topic": topic, "key": str(key), "value": value or json.dumps({"team_id": key, "game_pk": key}), "ts": "2026-04-01T00:00:00Z", "run_id": run}


def drain(spark, tmp_path, max_files=None):
    stream = land.read_messages(spark, str(tmp_path / "messages"), max_files)
    query = land.land_stream(stream, str(tmp_path / "tables"), str(tmp_path / "checkpoint"))
    query.awaitTermination()


def test_stream_routes_and_resumes(spark, tmp_path):
    for i in range(4):
        send(tmp_path / "messages", f"m{i}", *[message("teams", i * 3 + j) for j in range(3)], message("schedule", i), message("other", i))
    drain(spark, tmp_path, max_files=1)
    root = str(tmp_path / "tables")
    # Four micro-batches of one run make one snapshot.
    assert read_raw(spark, root, "teams").count() == 12
    drain(spark, tmp_path)
    assert read_raw(spark, root, "schedule").count() == 4
    send(tmp_path / "messages", "m9", message("teams", 1, "r2"), message("schedule", 1, "r2"))
    drain(spark, tmp_path)
    assert listed(read_raw(spark, root, "teams"), "team_id", "run_id") == [(1.0, "r2")]
    assert read_raw(spark, root, "schedule").count() == 5


def test_replayed_batch_lands_once(spark, tmp_path):
    sent = spark.createDataFrame([("teams", "1", '{"team_id": 1}', None, "r1")], "topic string, key string, value string, ts timestamp, run_id string")
    for _ in range(2):
        land.land_batch(sent, str(tmp_path), "feed", "000000000007")
    assert listed(land.landing_counts(spark, str(tmp_path)), "topic", "n_messages", "n_bad") == [("teams", 1, 0)]
    assert read_raw(spark, str(tmp_path), "teams", history=True).count() == 1


def test_bad_messages_are_set_aside(spark, tmp_path):
    send(tmp_path / "messages", "m", message("teams", 1), message("teams", 2, value="not json"), message("schedule", 3, value="{"))
    drain(spark, tmp_path)
    assert read_raw(spark, str(tmp_path / "tables"), "teams").count() == 1
    aside = read_table(spark, str(tmp_path / "tables"), land.QUARANTINE)
    assert listed(aside, "topic", "key") == [("schedule", "3"), ("teams", "2")]


def test_unreadable_messages_fail_the_run_that_landed_them(spark, tmp_path):
    root = str(tmp_path / "tables")
    send(tmp_path / "messages", "m", message("teams", 1), message("teams", 2, value="not json"), message("odd", 3))
    before = land.last_batch(spark, root)
    drain(spark, tmp_path)
    with pytest.raises(CheckFailed, match="odd|teams 1, unknown 1"):
        land.require_readable(spark, root, before)
    assert read_raw(spark, root, "teams").count() == 1
    aside = read_table(spark, root, land.QUARANTINE)
    assert listed(aside, "topic", "key") == [("odd", "3"), ("teams", "2")]
    # The batch is done with: later runs go on behind it.
    send(tmp_path / "messages", "n", message("teams", 4))
    before = land.last_batch(spark, root)
    drain(spark, tmp_path)
    land.require_readable(spark, root, before)
    assert read_raw(spark, root, "teams").count() == 2


def events(spark, folder, *batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "id bigint, ts string, topic string").selectExpr(
            "id", "id div 10 AS block", "CAST(ts AS timestamp) AS ts", "topic"
        ).coalesce(1).write.mode("append").parquet(str(folder))


@pytest.mark.parametrize("prune_by", [None, "block"])
def test_append_unseen_keeps_the_first_and_refuses_late_copies(spark, tmp_path, prune_by):
    source = tmp_path / "in"

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
        live.append_unseen(stream, str(tmp_path), "out", str(tmp_path / "check"), "id", prune_by).awaitTermination()
        return listed(read_table(spark, str(tmp_path), "out"), "id", "topic")

    events(spark, source, [(1, "2026-04-01 10:00:00", "a"), (1, "2026-04-01 10:00:00", "a"), (25, "2026-04-01 10:00:00", "a"), (None, "2026-04-01 10:00:00", "a")])
    assert run() == [(1, "a"), (25, "a")]
    events(spark, source, [(1, "2020-01-01 00:00:00", "z"), (2, "2020-01-01 00:00:00", "z")])
    assert run() == [(1, "a"), (2, "z"), (25, "a")]
    assert run() == [(1, "a"), (2, "z"), (25, "a")]


def test_dedup_within_watermark(spark, tmp_path):
    events(spark, tmp_path / "in", [(1, "2026-04-01 10:00:00", "a"), (1, "2026-04-01 10:00:30", "a"), (2, "2026-04-01 10:00:00", "a")])
    stream = live.dedup_within(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), "id", "ts", "10 minutes")
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert listed(spark.read.parquet(str(tmp_path / "out")), "id") == [(1,), (2,)]


@pytest.mark.parametrize("slide", [None, 60, 45])
def test_stream_rate_equals_batch_rate(spark, tmp_path, slide):
    from dugout.operators.monitor import message_rate

    rows = [(i, f"2026-04-01 10:{i % 40:02d}:10", "ab"[i % 2]) for i in range(80)]
    events(spark, tmp_path / "in", rows[:40], rows[40:])
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    rates = live.rate_stream(source, slide=slide, delay="2 hours")
    live.store_windows(rates, str(tmp_path / "rates"), str(tmp_path / "check")).awaitTermination()
    latest = live.latest_windows(spark, str(tmp_path / "rates"), rates.schema, ["window_start", "topic"])
    batch = message_rate(spark.read.schema(SCHEMA).parquet(str(tmp_path / "in")), slide=slide)
    assert listed(latest) == listed(batch)
