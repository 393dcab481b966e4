import datetime

import pytest
from conftest import listed
from pyspark.sql import functions as F

from dugout.plans import history, marts, predictions, staging, summaries
from dugout.sources import tables
from dugout.sources.schemas import RAW


@pytest.fixture
def raw(spark):
    """Raw rows given as dicts; the other columns are missing."""

    def make(feed, *rows):
        return spark.createDataFrame([tuple(r.get(n) for n in RAW[feed].names) for r in rows], RAW[feed])

    return make


def test_schedule_keeps_the_most_advanced_state(raw):
    fetch = lambda pk, status, run, home=None, away=None: {"game_pk": float(pk), "game_date": "2026-04-08T23:05:00Z", "status": status, "home_score": home, "away_score": away, "run": run}
    rows = [
        fetch(1, "Scheduled", "r1"), fetch(1, "In Progress", "r2", 2.0, 1.0), fetch(1, "In Progress", "r3", 3.0, 1.0),
        fetch(1, "Final", "r4", 4.0, 1.0),
        fetch(2, "Scheduled", "r1"), fetch(2, "In Progress", "r2", 2.0, 1.0), fetch(2, "In Progress", "r3", 3.0, 1.0),
        fetch(3, "Manager Challenge", "r2"), fetch(3, "Pre-Game", "r1"),
    ]
    df = None
    for r in rows:
        one = raw("schedule", r).withColumn("run_id", F.lit(r["run"]))
        df = one if df is None else df.unionByName(one)
    got = listed(staging.stg_schedule(df), "game_pk", "game_status", "home_score", "away_score")
    assert got == [(1, "Final", 4, 1), (2, "In Progress", 3, 1), (3, "Pre-Game", None, None)]
    assert staging.stg_schedule(df).schema["game_date"].dataType.simpleString() == "timestamp_ntz"


def test_hitting_drops_missing_ids_and_cleans_rates(raw):
    df = raw(
        "hitting_stats", {"player_id": 1.0, "games": 40.0, "ops": ".700"}, {"player_id": 1.0, "games": 62.0, "ops": "-.--"},
        {"player_id": None, "games": 99.0}, {"player_id": float("nan"), "games": 99.0},
    )
    assert listed(staging.stg_hitting_stats(df), "player_id", "games", "ops") == [(1, 62, None)]


def plays(raw, *rows):
    base = {"is_complete": True, "inning": 1.0, "start_time": "2026-04-08T20:00:00Z", "end_time": "2026-04-08T20:01:00Z"}
    return raw("game_events", *[{**base, "game_pk": 9.0, **r} for r in rows])


def test_events_increment(raw):
    first = plays(raw, {"at_bat_index": 0.0, "event_type": "Walk"}, {"at_bat_index": 1.0, "is_complete": False}, {"at_bat_index": None})
    stored = staging.stg_game_events(first)
    assert listed(stored, "event_id", "event_type") == [("9_0", "Walk")]
    assert staging.stg_game_events(first, stored).count() == 0
    later = plays(raw, {"at_bat_index": 0.0, "event_type": "Single"}, {"at_bat_index": 1.0, "event_type": "Out"})
    assert listed(staging.stg_game_events(later, stored), "event_id", "event_type") == [("9_1", "Out")]
    with_null_key = stored.unionByName(stored.withColumn("event_id", F.lit(None).cast("string")))
    assert staging.stg_game_events(later, with_null_key).count() == 1


def test_events_keep_the_latest_copy(raw):
    df = plays(raw, {"at_bat_index": 0.0, "rbi": 1.0}, {"at_bat_index": 0.0, "rbi": 2.0, "end_time": "2026-04-08T20:02:00Z"})
    assert listed(staging.stg_game_events(df), "event_id", "rbi") == [("9_0", 2)]


@pytest.fixture
def results(values):
    when = datetime.datetime(2026, 4, 8, 20)
    schedule = values(
        "game_pk bigint, game_date timestamp_ntz, game_status string, home_team_name string, away_team_name string, home_score int, away_score int, venue_name string",
        (1, when, "Final", "H", "A", 4, 2, "V"), (2, when, "Game Over", "H", "A", 2, 4, "V"), (3, when, "Final", "H", "A", 3, 3, "V"),
        (4, when, "Final", "H", "A", None, 1, "V"), (5, when, "In Progress", "H", "A", 5, 1, "V"),
        (6, when + datetime.timedelta(days=1), "Final", "H", "B", 9, 7, "V"),
    )
    return marts.mart_game_results(schedule)


def test_game_results(results):
    got = listed(results, "game_pk", "winning_team", "losing_team", "run_differential")
    assert got == [(1, "H", "A", 2), (2, "A", "H", 2), (3, "Tie", "Tie", 0), (6, "H", "B", 2)]


def test_games_summary(results):
    got = {r["figure"]: (r["headline"], r["detail"]) for r in summaries.games_summary(results).collect()}
    assert got == {
        "Games": ("4", "completed"), "Avg Runs": ("8.5", "per game"),
        "Biggest Win": ("2 runs", "H"), "Closest Game": ("0 run", "Tie"),
    }
    assert listed(summaries.wins_by_team(results)) == [("A", 1), ("H", 2), ("Tie", 1)]
    assert listed(summaries.game_log(results), "game_date", "score")[0] == ("2026-04-08", "2 – 4")


def test_team_trend(results):
    got = listed(history.team_trend(results), "team", F.date_format("day", "MM-dd"), "wins_to_date", "losses_to_date")
    assert got == [("A", "04-08", 1, 1), ("B", "04-09", 0, 1), ("H", "04-08", 1, 1), ("H", "04-09", 2, 1)]


def test_role_and_leaders(values):
    pitching = values(
        "player_id int, player_name string, games int, games_started int, wins int, saves int, strikeouts int, era decimal(6,2)",
        (1, "a", 10, 5, 3, 0, 8, None), (2, "b", 10, 4, 9, 7, 8, None), (3, "c", 0, 0, 9, 9, 99, None), (4, "d", 2, 2, 3, 0, 1, None),
    ).withColumn("era", F.when(F.col("player_id") != 1, F.col("player_id").cast("decimal(6,2)")))
    mart = marts.mart_pitching_leaders(pitching)
    assert listed(mart, "player_id", "role") == [(1, "Starter"), (2, "Reliever"), (4, "Starter")]
    got = {r["figure"]: (r["headline"], r["detail"]) for r in summaries.pitching_summary(mart).collect()}
    # The listing is by role name, so a reliever precedes a starter of the same strikeouts.
    assert got == {"ERA Leader": ("d", "ERA 4.00"), "K Leader": ("b", "8 K"), "Win Leader": ("d", "3 W"), "Save Leader": ("b", "7 SV")}
    assert [r["player_id"] for r in tables.pitching_leaders_in_order(mart, starters_first=True).collect()] == [4, 1, 2]
    assert [r["player_id"] for r in tables.pitching_leaders_in_order(mart).collect()] == [2, 4, 1]
    assert [r["player_id"] for r in summaries.top_starters(mart).collect()] == [4]


def leaderboard(values, players, pitchers, sides, **parameters):
    batting = values("player_id int, player_name string, team_id int, team_name string, home_runs int, plate_appearances int, batting_avg decimal(5,3), ops decimal(5,3)", *players)
    pitching = values("player_id int, player_name string, role string, home_runs_allowed int, innings_pitched string", *pitchers)
    matchups = values("game_pk bigint, venue string, matchup string, batting_team_id int, pitcher_id int, pitcher_name string", *sides)
    return predictions.hr_leaderboard(matchups, batting, pitching, **parameters)


def test_leaderboard(values):
    board = leaderboard(
        values,
        [(1, "Bat", 7, "T", 60, 200, None, None), (2, "Few", 7, "T", 9, 19, None, None)],
        [(50, "Ace", "Starter", 10, "100.0"), (51, "Pen", "Reliever", 90, "10.0"), (52, "Hot", "Starter", 1000, "100.0")],
        [
            (1, "Coors Field", "A @ B", 7, 99, "Feed"), (2, "Nowhere", "A @ C", 7, 51, "Pen feed"), (3, "Nowhere", "A @ D", 7, None, "TBD"),
            (4, "Nowhere", "A @ E", 7, 50, "x"), (5, "Nowhere", "A @ F", 7, 52, "x"),
        ],
    )
    rate = 66.8 / 400
    got = {r["game_pk"]: r for r in board.collect()}
    assert sorted(got) == [1, 2, 4, 5]
    assert (got[1]["hr_prob"], got[1]["hr_prob_pct"], got[1]["pitcher"], got[1]["park_factor"]) == (round(rate * 0.034 / 0.034 * 1.35, 4), "22.5%", "Feed", 1.35)
    assert (got[2]["hr_prob"], got[2]["pitcher"]) == (pytest.approx(rate, abs=1e-4), "Pen feed")
    assert got[4]["hr_prob"] == pytest.approx(rate * (10 / 430) / 0.034, abs=1e-4) and got[4]["pitcher"] == "Ace"
    assert got[5]["hr_prob"] == 0.25
    assert [r["game_pk"] for r in predictions.top_picks(board, 2).collect()] == [5, 1]
    text = {r["figure"]: r["headline"] for r in summaries.leaderboard_summary(board).collect()}
    assert text["Games Today"] == "4" and text["Best Park Today"] == "Field" and text["Top Candidate"] == "Bat"


def test_empty_leaderboard_has_no_figures(values):
    board = leaderboard(values, [(1, "Bat", 7, "T", 60, 200, None, None)], [(50, "Ace", "Starter", 1, "1.0")], [(1, "V", "m", 8, 50, "x")])
    assert board.count() == 0 and summaries.leaderboard_summary(board).count() == 0


def test_probability_stays_in_range(spark, values):
    players = [(i, f"b{i}", i % 5, "T", i % 40, 20 + i, None, None) for i in range(60)]
    pitchers = [(i, f"p{i}", "Starter", i * 3, f"{i}.{i % 3}") for i in range(10)]
    sides = [(i, "Coors Field", "m", i % 5, i % 15, "x") for i in range(30)]
    probabilities = [r["hr_prob"] for r in leaderboard(values, players, pitchers, sides).collect()]
    assert len(probabilities) == 30 * 12 and all(0 <= p <= 0.25 for p in probabilities)


def test_batting_summary_and_order(values):
    players = values(
        "player_id int, player_name string, batting_avg decimal(5,3), home_runs int, ops decimal(5,3), plate_appearances int",
        (1, "a", None, 5, None, 50), (2, "b", None, 5, None, 50), (3, "c", None, 1, None, 9),
    ).withColumns({"batting_avg": (F.col("player_id") / 10).cast("decimal(5,3)"), "ops": F.when(F.col("player_id") > 1, F.col("player_id") / 5).cast("decimal(5,3)")})
    got = {r["figure"]: (r["headline"], r["detail"]) for r in summaries.batting_summary(players).collect()}
    assert got == {"AVG Leader": ("c", "AVG 0.300"), "HR Leader": ("b", "5 HR"), "OPS Leader": ("c", "OPS 0.600")}
    assert [r["player_id"] for r in tables.player_stats_in_order(players).collect()] == [3, 2, 1]
    assert [r["player_id"] for r in summaries.top_batters(players).collect()] == [2, 3]


def test_play_rollups(raw):
    events = staging.stg_game_events(plays(
        raw,
        {"at_bat_index": 0.0, "event_type": "Single", "batter_id": 1.0, "pitcher_id": 5.0, "rbi": 1.0},
        {"at_bat_index": 1.0, "event_type": "Walk", "batter_id": 1.0, "pitcher_id": 5.0},
        {"at_bat_index": 2.0, "event_type": "Strikeout", "batter_id": 1.0, "pitcher_id": 6.0, "start_time": "2026-04-09T20:00:00Z"},
    ))
    assert listed(history.pitcher_matchups(events), "pitcher_id", "batter_id", "plate_appearances", "at_bats", "hits", "walks", "rbi") == [(5, 1, 2, 1, 1, 1, 1), (6, 1, 1, 1, 0, 0, 0)]
    assert listed(history.batting_from_plays(events), "hits", "at_bats", "batting_avg") == [(1, 2, 0.5)]
    assert listed(history.performance_over_time(events), "hits_to_date", "at_bats_to_date", "avg_to_date") == [(1, 1, 1.0), (1, 2, 0.5)]
    assert listed(summaries.plays_per_game(events)) == [(None, 3), (9, 3)]


def test_models_in_the_catalog(spark, values):
    tables.save_model(values("a int", 1, 2), "dugout_view", "view")
    tables.save_model(values("a int", 1, 2), "dugout_table")
    joined = tables.run_query(spark, "SELECT count(*) AS n FROM dugout_view JOIN dugout_table USING (a) WHERE a >= :low", low=2)
    assert joined.first()["n"] == 1
