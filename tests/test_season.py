from datetime import date, datetime

import pytest
from conftest import listed, season_documents

from pyspark.sql import functions as F

from dugout.operators.quality import CheckFailed
from dugout.plans import season, summaries
from dugout.plans.season import CONTRACTS, Paths
from dugout.sources.tables import open_table, read_raw

DAY = date(2026, 4, 10)


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    root = tmp_path_factory.mktemp("season")
    season_documents(root / "documents")
    return Paths(str(root / "documents"), str(root / "messages"), str(root / "tables"), str(root / "checkpoints"))


def run(spark, paths, run_id, hours=20, strict=True):
    return season.run(spark, paths, 2026, DAY, datetime(2026, 4, 8, 21 % 24).replace(day=8 + (21 + hours) // 24, hour=(21 + hours) % 24), run_id, strict)


def test_whole_run_twice(spark, paths):
    assert sum(len(r.get("not_null", [])) + len(r.get("unique", [])) for r in CONTRACTS.values()) == 52
    tables = run(spark, paths, "2026-04-10T01")
    assert [r["status"] for r in tables["contracts"].collect()] == ["pass"] * 52
    counts = {
        "raw_teams": 30, "raw_schedule": 12, "stg_schedule": 6, "raw_hitting_stats": 91, "stg_hitting_stats": 90,
        "mart_standings": 30, "mart_game_results": 3, "mart_player_stats": 85, "mart_pitching_leaders": 30,
        "raw_game_events": 75, "stg_game_events": 72,
    }
    assert {name: tables[name].count() for name in counts} == counts
    assert listed(tables["mart_game_results"], "game_pk", "winning_team") == [(10, "Team 0"), (11, "Team 3"), (12, "Tie")]
    assert tables["mart_standings"].filter("division_rank = 1").select("division_name").distinct().count() == 6
    assert tables["freshness"].first()["status"] == "pass"
    assert tables["mart_player_stats"].filter("player_id = 1050").first()["games"] == 40

    assert listed(tables["published"]) == listed(tables["landed"], "topic", "n_messages")
    assert tables["landed"].filter("n_bad > 0").count() == 0

    again = run(spark, paths, "2026-04-10T02", hours=30)
    assert again["raw_schedule"].count() == 24
    assert again["freshness"].first()["status"] == "warn"
    for name in ("raw_teams", "stg_schedule", "stg_game_events", "mart_standings", "mart_player_stats"):
        assert again[name].count() == counts[name]

    with pytest.raises(CheckFailed, match="Freshness"):
        season.run_checks(again, datetime(2026, 4, 12))

    board = season.predict_day(spark, paths, again, DAY)
    # Teams 0 to 2 bat against known pitchers; the pitcher of team 3 is not announced.
    assert listed(board.select("team").distinct()) == [("Team 0",), ("Team 1",), ("Team 3",)]
    assert board.filter("venue = 'Coors Field'").select("park_factor").distinct().collect()[0][0] == 1.35
    assert summaries.leaderboard_summary(board).count() == 4
    pages = season.reports(again)
    assert listed(pages["standings_summary"], "figure")[0] == ("AL Leader",)
    assert pages["standings_summary"].count() == 4
    assert [r["wins"] for r in pages["wins_by_team"].collect()] == [1, 1, 1]
    assert [r["score"] for r in pages["game_log"].collect()].count("2 – 4") == 1
    assert pages["players"].first()["player_id"] == 1050


def test_events_are_staged_by_batch(spark, values, tmp_path):
    from dugout.sources.envelopes import FEEDS, to_messages
    from dugout.streaming.land import land_batch

    root = str(tmp_path)

    def stage(source, batch, *games):
        if games:
            rows = values("game_pk int, at_bat_index int, is_complete boolean, description string", *[(g, 0, True, batch) for g in games])
            land_batch(to_messages(rows, FEEDS["game_events"], "r1", F.current_timestamp()), root, source, batch)
        raw = read_raw(spark, root, "game_events")
        season.stage_events(spark, root, raw)
        return listed(open_table(spark, root, "stg_game_events", season.event_schema(raw), ["game_block"]), "event_id", "description")

    assert stage("feed", "5") == []
    assert stage("feed", "5", 1, 2) == [("1_0", "5"), ("2_0", "5")]
    assert stage("feed", "6", 2, 3001) == [("1_0", "5"), ("2_0", "5"), ("3001_0", "6")]
    # Another stream counts its batches from the start.
    assert stage("other", "0", 1, 4)[-1] == ("4_0", "0")
    assert len(stage("feed", "6")) == 4


def test_direct_run(spark, paths, tmp_path):
    direct = Paths(paths.documents, paths.messages, str(tmp_path / "tables"), paths.checkpoints)
    report = season.run_direct(spark, direct, 2026, DAY, "2026-04-10T01")
    assert listed(report, "input_name", "n_rows", "n_columns", "status") == [("schedule", 2, 10, "ok"), ("standings", 30, 12, "ok"), ("teams", 30, 11, "ok")]
    season.run_direct(spark, direct, 2026, DAY, "2026-04-10T02")
    assert read_raw(spark, direct.tables, "teams").count() == 30
    assert read_raw(spark, direct.tables, "schedule").count() == 2  # replaced, not appended


def test_first_day_of_a_season(spark, paths):
    assert season.feeds.first_game_day(2026) == date(2026, 3, 25)
    assert season.feeds.first_game_day(2025, date(2025, 3, 18)) == date(2025, 3, 18)
    with pytest.raises(ValueError, match="2025"):
        season.feed_rows(spark, paths, 2025, date(2025, 10, 1))


def test_bad_messages_fail_a_strict_run_once(spark, paths, tmp_path):
    own = Paths(paths.documents, *(str(tmp_path / n) for n in ("messages", "tables", "checkpoints")))
    (tmp_path / "messages").mkdir()
    (tmp_path / "messages" / "bad.json").write_text('{"topic": "teams", "key": "1", "value": "{} x", "ts": "2026-04-01T00:00:00Z", "run_id": "2026-04-10T00"}')
    with pytest.raises(CheckFailed, match="unreadable messages: teams 1"):
        run(spark, own, "2026-04-10T01")
    assert run(spark, own, "2026-04-10T02")["mart_standings"].count() == 30


def test_days_walked_back_are_in_the_schedule(spark, values):
    games = values(
        "game_day string, game_type string, game_pk int, status string",
        ("2026-04-05", "R", 1, "Final"), ("2026-04-06", "S", 2, "Final"), ("2026-04-07", "E", 3, "Postponed"),
        ("2026-04-08", "S", 4, "Scheduled"), ("2026-03-20", "R", 5, "Final"), ("2026-03-26", "S", 6, "Final"),
    ).withColumn("game_day", F.to_date("game_day"))
    for column in set(season.feeds.SCHEDULE_COLUMNS) - set(games.columns):
        games = games.withColumn(column, F.lit(None).cast("string"))
    got = season.season_games(games, date(2026, 3, 25), date(2026, 4, 8)).select("game_pk").collect()
    # Regular games so far, and everything since the day that had a finished game.
    assert sorted(r[0] for r in got) == [1, 2, 3, 4]
    got = season.season_games(games, date(2026, 3, 25), date(2026, 3, 24), back=3).select("game_pk").collect()
    assert sorted(r[0] for r in got) == []


def test_volume_failure_is_listed(spark, paths, tmp_path):
    season_documents(tmp_path / "documents")
    (tmp_path / "documents" / "teams" / "part.json").write_text('{"teams": [{"id": 1, "name": "A", "division": {"id": 200, "name": "D"}, "league": {"id": 103, "name": "L"}}]}')
    small = Paths(*(str(tmp_path / n) for n in ("documents", "messages", "tables", "checkpoints")))
    with pytest.raises(CheckFailed, match="raw_teams: 1 < 25"):
        run(spark, small, "2026-04-10T01")
