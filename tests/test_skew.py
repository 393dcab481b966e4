"""One key holds a third of the rows: results stay right and the plan spreads the work."""

import pytest
from conftest import listed, plan
from pyspark.sql import functions as F

from dugout.operators.dedup import keep_first, keep_unseen
from dugout.operators.quality import repeated_keys
from dugout.plans import marts, predictions

N = 60_000


def hot(spread, key=7):
    return F.when(F.col("id") % 3 == 0, key).otherwise(F.col("id") % spread)


@pytest.fixture
def small_partitions(spark):
    """No broadcasts, and skew handling that starts at kilobytes."""
    changes = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in changes}
    for key, value in changes.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_leaderboard_splits_a_hot_team(spark, small_partitions):
    matchups = spark.range(0, N, 1, 16).select(
        F.col("id").alias("game_pk"), F.lit("Coors Field").alias("venue"), F.sha1(F.col("id").cast("string")).alias("matchup"),
        hot(1009).alias("batting_team_id"), hot(2003, 11).alias("pitcher_id"), F.lit("x").alias("pitcher_name"),
    )
    players = spark.range(5045).select(
        F.col("id").alias("player_id"), F.lit("b").alias("player_name"), (F.col("id") % 1009).alias("team_id"), F.lit("t").alias("team_name"),
        F.lit(5).alias("home_runs"), F.lit(200).alias("plate_appearances"), F.lit(0.3).alias("batting_avg"), F.lit(0.8).alias("ops"),
    )
    pitching = spark.range(1500).select(
        F.col("id").alias("player_id"), F.lit("p").alias("player_name"), F.lit("Starter").alias("role"),
        F.lit(5).alias("home_runs_allowed"), F.lit("100.1").alias("innings_pitched"),
    )
    board = predictions.hr_leaderboard(matchups, players, pitching)
    totals = board.groupBy("pitcher").agg(F.count("*"), F.max("matchup"))
    counts = {row[0]: row[1] for row in totals.collect()}
    assert sum(counts.values()) == N * 5
    assert plan(totals).count("skew=true") >= 1


def test_rank_of_a_hot_division(spark):
    teams = spark.range(0, N, 1, 16).select(
        "id", F.when(F.col("id") % 3 > 0, "big").otherwise("small").alias("division_name"), F.lit("L").alias("league_name"),
        F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 100).alias("wins"), (F.col("id") % 7).alias("losses"),
    )
    ranked = marts.mart_standings(teams)
    assert ranked.count() == N
    best = ranked.filter("league_rank = 1").agg(F.min("wins"), F.max("losses")).first()
    assert tuple(best) == (99, 0)
    worst = ranked.agg(F.max("league_rank")).first()[0]
    assert worst == N - ranked.filter("wins = 1 AND losses = 6").count() + 1


def test_rank_holds_no_rows_in_a_window(spark):
    teams = spark.range(100).select(F.lit("d").alias("division_name"), F.lit("l").alias("league_name"), F.col("id").alias("wins"), F.lit(0).alias("losses"))
    assert "Window" not in plan(marts.mart_standings(teams))


def test_copies_of_one_key(spark, small_partitions):
    plays = spark.range(0, N, 1, 16).select(hot(N, -1).alias("k"), "id")
    single = keep_first(plays, ["k"], [F.col("id").asc()])
    assert single.count() == N - N // 3 + 1
    assert single.filter("k = -1").first()["id"] == 0
    known = plays.filter("id % 2 = 0")
    fresh = keep_unseen(single, known, "k")
    assert fresh.count() == N // 3 and "HashAggregate" in plan(fresh)
    assert listed(repeated_keys(plays, "k")) == [(-1, N // 3)]
