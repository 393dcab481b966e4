import json

from conftest import listed
from pyspark.sql import functions as F

from dugout.operators.reshape import union_feeds
from dugout.sources import feeds, schemas
from dugout.sources.envelopes import FEEDS, bad_rows, decode, from_topics, good_rows, to_messages, to_topics, topic_options
from dugout.sources.tables import raw_schema, read_raw
from dugout.streaming.land import land_batch


def documents(values, schema, *docs):
    text = values("text string", *[json.dumps(d) for d in docs])
    return feeds.parse_documents(text, "text", schema)


def test_teams_without_optional_objects(values):
    docs = documents(values, schemas.TEAMS_DOC, {"teams": [{"id": 1, "name": "A", "league": {"id": 103, "name": "L"}}, {"id": 2, "name": "B"}]}, {})
    flat = feeds.teams(docs, 2026)
    assert listed(flat, "team_id", "league_name", "venue_id", "season") == [(1, "L", None, 2026), (2, None, None, 2026)]


def test_standings_defaults_and_labels(values):
    record = {"division": {"id": 203}, "league": {"id": 9}, "teamRecords": [{"team": {"id": 1, "name": "A"}, "leagueRecord": {"wins": 3, "losses": 0, "pct": "1.000"}}]}
    bare = {"teamRecords": [{"team": {"id": 2, "name": "B"}}]}
    flat = feeds.standings(documents(values, schemas.STANDINGS_DOC, {"records": [record, bare]}), 2026)
    got = listed(flat, "team_id", "division", "league", "wins", F.col("win_pct").cast("string"), "games_back", "games_played")
    assert got == [(1, "NL West", "9", 3, "1.000", "-", 0), (2, None, None, 0, "0.000", "-", 0)]


def one_game(pk, day, status="Final", kind="R", **home):
    return {
        "date": day,
        "games": [{
            "gamePk": pk, "gameDate": f"{day}T02:10:00Z", "gameType": kind, "status": {"detailedState": status},
            "teams": {"home": {"team": {"id": 1, "name": "H"}, **home}, "away": {"team": {"id": 2, "name": "A"}, "score": 3}},
        }],
    }


def test_schedule_day_and_range(values):
    docs = documents(values, schemas.SCHEDULE_DOC, {"dates": [one_game(1, "2026-03-24"), one_game(2, "2026-03-25"), one_game(3, "2026-04-01", kind="S"), one_game(4, "2026-04-02", score=1)]})
    date = lambda d: F.lit(d).cast("date")
    assert listed(feeds.schedule(docs, date("2026-04-01")), "game_pk", "venue") == [(3, None)]
    season = feeds.season_schedule(docs, date("2026-04-02"))
    assert listed(season, "game_pk", "home_score", "away_score") == [(2, None, 3), (4, 1, 3)]


def test_probable_pitchers(values):
    docs = documents(values, schemas.SCHEDULE_DOC, {"dates": [one_game(4, "2026-04-02", probablePitcher={"id": 7, "fullName": "P"})]})
    flat = feeds.probable_pitchers(docs, F.lit("2026-04-02").cast("date"))
    got = listed(flat, "batting_team", "pitcher_id", "pitcher_name", "matchup", "venue")
    assert got == [("A", 7, "P", "A @ H", ""), ("H", None, "TBD", "A @ H", "")]


def test_stats_use_the_first_block(values):
    split = {"player": {"id": 1, "fullName": "X"}, "team": {"id": 2, "name": "T"}, "stat": {"gamesPlayed": 4, "avg": ".300"}}
    docs = documents(values, schemas.HITTING_DOC, {"stats": [{"splits": [split]}, {"splits": [split]}]}, {"stats": []}, {})
    assert listed(feeds.hitting_stats(docs, 2026), "player_id", "games", "batting_avg", "rbi") == [(1, 4, ".300", None)]


def test_plays_defaults(values):
    docs = documents(values, schemas.PLAYS_DOC, {"gamePk": 9, "liveData": {"plays": {"allPlays": [{"about": {"atBatIndex": 0}, "matchup": {}, "result": {"event": "Walk"}}]}}})
    assert listed(feeds.game_events(docs), "game_pk", "at_bat_index", "is_complete", "is_scoring", "event_type") == [(9, 0, False, False, "Walk")]


def test_message_keys_and_values(values):
    rows = values("game_pk bigint, at_bat_index int, event_type string", (9, 3, None), (9, None, "Walk"))
    sent = to_messages(rows, FEEDS["game_events"], "r1", F.lit("2026-04-01").cast("timestamp"), "sport.")
    assert listed(sent, "topic", "key", "run_id") == [("sport.game_events", "9_0", "r1"), ("sport.game_events", "9_3", "r1")]
    assert json.loads(sent.filter("key = '9_3'").first()["value"]) == {"game_pk": 9, "at_bat_index": 3, "event_type": None}


def test_topic_columns_round_trip(values):
    sent = values("topic string, key string, value string, run_id string", ("sport.teams", "1", "{}", "r1"))
    wire = to_topics(sent).withColumn("timestamp", F.lit("2026-04-01").cast("timestamp"))
    back = from_topics(wire.withColumn("key", F.col("key").cast("binary")), "sport.")
    assert listed(back, "topic", "key", "value", "run_id") == [("teams", "1", "{}", "r1")]
    options = topic_options("host:9092", ["a", "b"], 1000)
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "1000"


def test_decode_floats_nan_and_bad_text(values):
    schema = FEEDS["schedule"].schema
    sent = values(
        "topic string, key string, value string, ts timestamp, run_id string",
        ("schedule", "1", '{"game_pk": 1, "home_score": 5.0, "away_score": NaN}', None, "r1"),
        ("schedule", "2", "not json", None, "r1"), ("schedule", "3", None, None, "r1"), ("schedule", "4", "{}", None, "r1"),
        *[("schedule", f"b{i}", v, None, "r1") for i, v in enumerate(("", "  ", "null", "[]", '{"game_pk":1}{"game_pk":2}', '{"game_pk":1} x', '{"game_pk":1},"end":"1"} x', '{"game_pk":"x"}', "{"))],
    )
    decoded = decode(sent, schema)
    assert listed(bad_rows(decoded), "key") == [("2",), ("3",), *[(f"b{i}",) for i in range(9)]]
    assert listed(good_rows(decoded, schema), "game_pk", "home_score", F.isnan("away_score")) == [(None, None, False), (1.0, 5.0, True)]


def test_snapshot_keeps_the_latest_run_and_absent_topics(spark, values, tmp_path):
    def batch(number, run, *team_ids):
        rows = values("team_id int, team_name string", *[(i, run) for i in team_ids])
        land_batch(to_messages(rows, FEEDS["teams"], run, F.current_timestamp()), str(tmp_path), "feed", str(number))

    batch(0, "2026-04-01T00", 1, 2, 3)
    batch(1, "2026-04-01T01", 1, 2)
    games = values("game_pk int", 5)
    land_batch(to_messages(games, FEEDS["schedule"], "2026-04-01T02", F.current_timestamp()), str(tmp_path), "feed", "2")
    assert listed(read_raw(spark, str(tmp_path), "teams"), "team_id", "run_id") == [(1.0, "2026-04-01T01"), (2.0, "2026-04-01T01")]
    assert read_raw(spark, str(tmp_path), "teams", history=True).count() == 5
    assert read_raw(spark, str(tmp_path), "schedule").count() == 1
    assert read_raw(spark, str(tmp_path), "hitting_stats").schema == raw_schema(FEEDS["hitting_stats"])


def test_union_feeds_by_name(values):
    a, b = values("x int, y string", (1, "a")), values("y string, x int", ("b", 2))
    assert listed(union_feeds([a, b])) == [(1, "a"), (2, "b")]


def test_documents_are_opened_by_day(spark, tmp_path):
    from datetime import date

    for day in ("2026-04-08", "2026-04-09", "2026-04-10"):
        (tmp_path / "in" / f"day={day}").mkdir(parents=True)
        (tmp_path / "in" / f"day={day}" / "d.json").write_text('{"dates": [{"date": "%s", "games": [{"gamePk": %s}]}]}' % (day, day[-2:].lstrip("0")))
    rows = feeds.read_documents(spark, str(tmp_path / "in"), schemas.SCHEDULE_DOC, days=(date(2026, 4, 9), date(2026, 4, 10)))
    assert listed(feeds.games(rows), "game_pk") == [(10,), (9,)]
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(day" in text and "day" not in rows.columns
    (tmp_path / "flat").mkdir()
    (tmp_path / "flat" / "d.json").write_text('{"dates": [{"date": "2026-04-01", "games": [{"gamePk": 1}]}]}')
    flat = feeds.read_documents(spark, str(tmp_path / "flat"), schemas.SCHEDULE_DOC, days=(date(2026, 4, 9), date(2026, 4, 10)))
    assert listed(feeds.games(flat), "game_pk") == [(1,)]
