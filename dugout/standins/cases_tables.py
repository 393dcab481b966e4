"""Stored tables: replaced as a whole, extended by unseen keys, refreshed where rows changed,
checked from kept counts, and watched for changes of their fields."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import quality
from ..operators.drift import batch_fields, field_changes
from ..plans import marts, staging
from ..session import scratch_path, settle
from ..sources import schemas
from ..sources.envelopes import Feed
from ..sources.refresh import read_mart, refresh_mart
from ..sources.tables import read_raw, read_table, replace_table
from ..sources.tallies import kept_counts, kept_nulls, land_counted, read_tallies
from ..streaming import land, live
from .registry import case, table
from .roles import PLAYS_SQL, RESULTS_SQL, TYPED_PLAYS_SQL, as_raw_plays, games

_SNAPSHOTS = {
    name: Feed(name, lambda: F.col("c_custkey").cast("string"), True, schemas.flat("c_custkey c_nationkey"))
    for name in ("early", "late")
}


@case("SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def replace_after_failure(spark: SparkSession, folder: str) -> DataFrame:
    """A table after a replacement that fails while it is written: the rows are the old ones."""
    root = scratch_path(spark, "replaced")
    rows = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    replace_table(rows.limit(0), root, "customers")
    replace_table(rows, root, "customers")
    broken = F.when(F.col("c_custkey") > 0, F.raise_error(F.lit("the write fails"))).cast("bigint")
    try:
        replace_table(rows.withColumn("c_nationkey", broken), root, "customers")
    except Exception as error:
        if "the write fails" not in str(error):
            raise
    return read_table(spark, root, "customers", rows.schema)


@case("""
    SELECT 'early' AS feed, 'a1' AS run_id, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer WHERE c_acctbal > 0
    UNION ALL
    SELECT 'late', 'z1', count(*), sum(c_custkey)::BIGINT FROM customer WHERE c_acctbal > 0""")
def direct_after_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots that were landed by messages and then directly, by runs whose ids sort before
    and behind those of the messages: the direct rows are the snapshot."""
    root = scratch_path(spark, "direct")
    rows = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    for name, direct in (("early", "a1"), ("late", "z1")):
        sent = rows.select(
            F.lit(name).alias("topic"), F.col("c_custkey").cast("string").alias("key"),
            F.to_json(F.struct("c_custkey", "c_nationkey")).alias("value"),
            F.lit(None).cast("timestamp").alias("ts"), F.lit("m1").alias("run_id"),
        )
        land.land_batch(sent, root, "feed", name, tuple(_SNAPSHOTS.values()))
        land.land_rows(rows.filter("c_acctbal > 0"), root, _SNAPSHOTS[name], direct)
    found = [
        read_raw(spark, root, feed).groupBy(F.lit(name).alias("feed"), "run_id")
        .agg(F.count("*").alias("n"), F.sum("c_custkey").cast("bigint").alias("keys"))
        for name, feed in _SNAPSHOTS.items()
    ]
    return found[0].unionByName(found[1])


_STORED = "l_shipdate < TIMESTAMP '1998-01-01'"


@case(f"""
    WITH stored AS ({PLAYS_SQL.replace(TYPED_PLAYS_SQL, f"{TYPED_PLAYS_SQL} AND {_STORED}")})
    SELECT * FROM stored UNION ALL
    SELECT * FROM ({PLAYS_SQL}) p WHERE event_id NOT IN (SELECT event_id FROM stored)""")
def plays_by_bitmap(spark: SparkSession, folder: str) -> DataFrame:
    """Plays that arrive in two batches, the second one twice and with all plays of the first:
    what is stored is looked up in bitmaps of the games."""
    root = scratch_path(spark, "bitmaps")
    lines = table(spark, folder, "lineitem")
    early = lines.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    for batch, rows in (("1", early), ("2", lines), ("2", lines)):
        live.add_plays(as_raw_plays(rows), root, batch)
    columns = staging.typed_events(as_raw_plays(lines)).schema
    return read_table(spark, root, "stg_game_events", columns).drop("game_block", "batch")


@case(f"""
    WITH r AS ({RESULTS_SQL}), one AS (SELECT min(game_pk) AS changed FROM r)
    SELECT game_pk, game_date, game_status, home_team_name, away_team_name,
           CASE WHEN game_pk = changed THEN away_score + 7 ELSE home_score END AS home_score, away_score, venue_name,
           CASE WHEN game_pk = changed THEN home_team_name ELSE winning_team END AS winning_team,
           CASE WHEN game_pk = changed THEN away_team_name ELSE losing_team END AS losing_team,
           CASE WHEN game_pk = changed THEN 7 ELSE run_differential END AS run_differential,
           1::BIGINT AS rewritten
    FROM r, one""")
def mart_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The game results after one game's score was changed, and how many of the mart's
    partitions were rewritten for it."""
    root, block = scratch_path(spark, "refresh"), F.floor(F.col("game_pk") / 1000)
    staged = settle(games(spark, folder), "staged")  # a stored table, read several times
    refresh_mart(staged, root, "results", ["game_pk"], block, marts.mart_game_results)
    changed = marts.mart_game_results(staged).agg(F.min("game_pk")).first()[0]
    score = F.when(F.col("game_pk") == changed, F.col("away_score") + 7).otherwise(F.col("home_score"))
    n = refresh_mart(staged.withColumn("home_score", score), root, "results", ["game_pk"], block, marts.mart_game_results)
    schema = marts.mart_game_results(staged).schema
    return read_mart(spark, root, "results", schema).withColumn("rewritten", F.lit(n).cast("bigint"))


@case("""
    SELECT 'volume' AS check_name, 'events' AS subject, count(*) AS amount,
           CASE WHEN count(*) >= 50 THEN 'ok' ELSE 'FAIL' END AS status FROM events
    UNION ALL SELECT 'nulls', 'value', count_if(value IS NULL OR value < 10)::BIGINT, NULL FROM events
    UNION ALL SELECT 'nulls', 'user_id', count_if(user_id IS NULL)::BIGINT, NULL FROM events
    UNION ALL SELECT 'freshness', 'ts', trunc(epoch(TIMESTAMP '2024-02-01 12:00:00' - max(ts)))::BIGINT,
           CASE WHEN TIMESTAMP '2024-02-01 12:00:00' - max(ts) > INTERVAL 48 HOUR THEN 'error'
                WHEN TIMESTAMP '2024-02-01 12:00:00' - max(ts) > INTERVAL 24 HOUR THEN 'warn' ELSE 'pass' END FROM events""")
def checks_from_tallies(spark: SparkSession, folder: str) -> DataFrame:
    """Volume, null and freshness checks of a table that landed in three batches, one of them
    twice, from the lines that the batches left; the table is not read."""
    root = scratch_path(spark, "tallies")
    low = F.when(F.col("value") >= 10, F.col("value"))
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", low.alias("value"))
    day = F.dayofmonth("ts")
    for batch, part in (("1", day <= 10), ("2", (day > 10) & (day <= 20)), ("3", (day > 20) | day.isNull()), ("2", (day > 10) & (day <= 20))):
        land_counted(events.filter(part), root, "events", batch, ["value", "user_id"], "ts")
    lines = read_tallies(spark, root, "events")
    volume = kept_counts(lines).select(
        F.lit("volume").alias("check_name"), F.col("table_name").alias("subject"), F.col("n_rows").alias("amount"),
        F.when(F.col("n_rows") >= 50, "ok").otherwise("FAIL").alias("status"),
    )
    nulls = kept_nulls(lines).select(F.lit("nulls"), "column", "n_nulls", F.lit(None).cast("string"))
    fresh = quality.freshness(lines, "newest", datetime(2024, 2, 1, 12))
    fresh = fresh.select(F.lit("freshness"), F.lit("ts"), F.round(F.col("age_hours") * 3600).cast("bigint"), "status")
    return volume.union(nulls).union(fresh)


_PERIOD_SQL = "CASE WHEN day(ts) <= 10 THEN '1' WHEN day(ts) <= 20 THEN '2' ELSE '3' END"


@case(f"""
    WITH m AS (SELECT {_PERIOD_SQL} AS batch, event_id, user_id FROM events),
    fields AS (
        SELECT batch, 'id' AS field, 'number' AS kind FROM m
        UNION SELECT batch, 'user', CASE batch WHEN '3' THEN 'text' ELSE 'number' END FROM m
        UNION SELECT batch, 'early', 'number' FROM m WHERE batch = '1'
        UNION SELECT batch, 'late', 'number' FROM m WHERE batch <> '1'),
    pairs AS (SELECT DISTINCT batch, lag(batch) OVER (ORDER BY batch) AS earlier FROM (SELECT DISTINCT batch FROM m) b),
    b AS (SELECT p.batch, f.field, f.kind FROM pairs p JOIN fields f ON f.batch = p.earlier),
    a AS (SELECT p.batch, f.field, f.kind FROM pairs p JOIN fields f ON f.batch = p.batch WHERE earlier IS NOT NULL)
    SELECT batch, field, CASE WHEN b.kind IS NULL THEN 'added' WHEN a.kind IS NULL THEN 'removed' ELSE 'retyped' END AS change
    FROM b FULL JOIN a USING (batch, field) WHERE b.kind IS DISTINCT FROM a.kind""")
def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Fields that messages of three periods gained, lost and changed the type of."""
    day = F.dayofmonth("ts")
    period = F.when(day <= 10, "1").when(day <= 20, "2").otherwise("3")
    number = F.concat(F.lit('"user":'), F.coalesce("user_id", F.lit(0)))
    fields = F.concat_ws(
        ",", F.concat(F.lit('"id":'), "event_id"),
        F.when(period == "3", F.regexp_replace(number, "([0-9]+)", '"$1"')).otherwise(number),
        F.when(period == "1", F.lit('"early":1')).otherwise(F.lit('"late":2')),
    )
    messages = table(spark, folder, "events").select(period.alias("batch"), F.concat(F.lit("{"), fields, F.lit("}")).alias("value"))
    return field_changes(batch_fields(messages, "batch", "value")).select("batch", "field", "change")
