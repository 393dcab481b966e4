"""Series over time against plain Python."""

import json
import os
import random
from datetime import datetime, timedelta, timezone

from conftest import listed
from pyspark.sql import functions as F

from dugout.operators.monitor import lag_over_time
from dugout.operators.series import asof, counter_increases, window_rates
from dugout.streaming import live

START = datetime(2026, 4, 1, tzinfo=timezone.utc)


def moment(seconds):
    return START + timedelta(seconds=seconds)


def test_asof_over_chunks(spark):
    rng = random.Random(2)
    right = [(rng.choice("ab"), rng.randint(0, 9_000), rng.randint(0, 99)) for _ in range(200)] + [("a", 500, 1), ("a", 500, 7)]
    left = [(rng.choice("abc"), rng.randint(-50, 30_000), i) for i in range(200)] + [("a", 500, 900), (None, 5, 901)]
    lefts = spark.createDataFrame([(k, moment(s), i) for k, s, i in left] + [("a", None, 902)], "k string, ts timestamp, i int")
    rights = spark.createDataFrame([(k, moment(s), v) for k, s, v in right] + [("a", None, 5)], "k string, ts timestamp, v int")
    got = {r.i: r.v for r in asof(lefts, rights, ["k"], "ts", ["v"], chunk=600).collect()}
    for k, s, i in left:
        known = [(t, v) for q, t, v in right if q == k and t <= s]
        assert got[i] == (max(known)[1] if known else None)
    assert got[900] == 7 and got[901] is None and got[902] is None and len(got) == 203


def counters(seed=3, n=300):
    rng = random.Random(seed)
    rows = []
    for key in ("x", "y"):
        total, at = 0.0, 0.0
        for _ in range(n):
            at += rng.choice([1, 30, 290, 300, 1000, 5000])
            total = 0.5 if rng.random() < 0.05 else total + rng.randint(0, 40)
            rows.append((key, moment(at), total))
    return rows


def by_hand(rows, width):
    rates, increases = {}, 0
    for key in {k for k, *_ in rows}:
        own = sorted((t, v) for k, t, v in rows if k == key)
        for (a, held), (b, value) in zip(own, own[1:]):
            increases += 1
            grown = value - held if value >= held else value
            a, b = (a - START).total_seconds(), (b - START).total_seconds()
            w = a // width
            while w * width < b:
                inside = min(b, (w + 1) * width) - max(a, w * width)
                rates[key, w] = rates.get((key, w), 0) + grown * inside / (b - a) / width
                w += 1
    return rates, increases


def check(rates, rows, width=300):
    want, _ = by_hand(rows, width)
    got = {(r.k, (r.window_start.replace(tzinfo=timezone.utc) - START).total_seconds() / width): r.per_second for r in rates.collect()}
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in want)


def test_counter_rates_with_resets(spark):
    rows = counters()
    frame = spark.createDataFrame([*rows, *rows[:50], ("x", None, 1.0), ("z", moment(1), None), ("w", moment(1), 9.0)], "k string, ts timestamp, total double")
    increases = counter_increases(frame, ["k"], chunk=900)
    assert increases.count() == by_hand(rows, 300)[1]
    check(window_rates(increases, ["k"]).withColumn("window_start", F.col("window_start")), rows)


def test_counters_on_a_stream(spark, tmp_path):
    rows = sorted(counters(5, 120), key=lambda r: r[1])
    folder = tmp_path / "in"
    os.makedirs(folder)
    schema = "k string, ts timestamp, total double"

    def drain():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
        increases = live.stream_increases(stream, ["k"], idle="1000 days")
        live.store_increases(increases, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        return increases.schema

    for i in range(0, len(rows), 60):  # late and repeated samples change nothing
        part = rows[i : i + 60] + rows[max(0, i - 10) : i]
        lines = [json.dumps({"k": k, "ts": t.isoformat(), "total": v}) for k, t, v in part]
        (folder / f"{i:05d}.json").write_text("\n".join(lines))
        if i == 60:
            drain()
    found = drain()
    check(window_rates(spark.read.schema(found).parquet(str(tmp_path / "out")).drop("batch"), ["k"]), rows)


def test_lag_over_time(spark):
    ends = [("t", 0, moment(s), s // 10) for s in range(0, 100, 10)] + [("u", 1, moment(5), 50)]
    commits = [("g", "t", 0, moment(35), 2), ("g", "t", 0, moment(80), 8), ("h", "t", 0, moment(0), 0)]
    got = lag_over_time(
        spark.createDataFrame(ends, "topic string, partition int, ts timestamp, `end` long"),
        spark.createDataFrame(commits, "`group` string, topic string, partition int, ts timestamp, done long"),
    )
    want = {("g", s): s // 10 - (8 if s >= 80 else 2 if s >= 35 else -1) for s in range(0, 100, 10)}
    want |= {("h", s): s // 10 for s in range(0, 100, 10)}
    rows = {(r.group, int((r.ts.replace(tzinfo=timezone.utc) - START).total_seconds())): r.behind for r in got.collect()}
    assert rows == want
    assert listed(got.select("topic").distinct()) == [("t",)]
