"""The whole run: documents, messages, raw, staging, marts, checks."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.lookups import FINISHED, LIVE
from ..operators import quality
from ..operators.reshape import latest_day_with, union_feeds
from ..session import settle
from ..sources import feeds, schemas
from ..sources.envelopes import FEEDS, to_messages
from ..sources.tables import (
    game_results_in_order, open_table, pitching_leaders_in_order,
    player_stats_in_order, read_raw, read_table, replace_table, standings_in_order,
)
from ..streaming.land import (
    land_rows, land_stream, landing_counts, last_batch, read_messages, require_readable, write_messages,
)
from ..streaming.live import PLAY_LEVELS, add_plays
from . import marts, predictions, staging, summaries

# Fixed value: days that a run looks back for playable games.
BACK_DAYS = 7
EVENT_BLOCK = "game_block"
EVENT_MARKS = "stg_game_events_marks"
EVENT_TIME = "end_time"
MARK_SCHEMA = schemas.record(source=schemas.TEXT, batch=schemas.TEXT)

# Smallest accepted row counts.
VOLUME_FLOORS = {
    "raw_teams": 25,
    "raw_standings": 25,
    "raw_game_events": 50,
    "mart_player_stats": 10,
    "mart_standings": 25,
}

# Column rules of every table.
CONTRACTS = {
    "raw_teams": {"not_null": ["team_id", "team_name", "league_name", "division_name"], "unique": ["team_id"]},
    "raw_standings": {"not_null": ["team_id", "wins", "losses", "win_pct"], "unique": ["team_id"]},
    "raw_schedule": {"not_null": ["game_pk", "home_team_id", "away_team_id", "status"]},
    "raw_hitting_stats": {"not_null": ["player_id", "player_name"]},
    "raw_pitching_stats": {"not_null": ["player_id", "player_name"]},
    "raw_game_events": {"not_null": ["game_pk", "at_bat_index", "batter_id", "pitcher_id"]},
    "stg_teams": {"not_null": ["team_id", "team_name"], "unique": ["team_id"]},
    "stg_standings": {"not_null": ["team_id", "wins", "losses", "win_pct"], "unique": ["team_id"]},
    "stg_schedule": {"not_null": ["game_pk"], "unique": ["game_pk"]},
    "stg_hitting_stats": {"not_null": ["player_id", "player_name"], "unique": ["player_id"]},
    "stg_pitching_stats": {"not_null": ["player_id", "player_name"], "unique": ["player_id"]},
    "stg_game_events": {"not_null": ["event_id", "game_pk", "inning"], "unique": ["event_id"]},
    "mart_standings": {"not_null": ["team_id", "division_rank", "league_rank"], "unique": ["team_id"]},
    "mart_game_results": {"not_null": ["game_pk"], "unique": ["game_pk"]},
    "mart_player_stats": {"not_null": ["player_id"], "unique": ["player_id"]},
    "mart_pitching_leaders": {"not_null": ["player_id"], "unique": ["player_id"]},
}

# Columns the direct ingest insists on.
REQUIRED = {
    "teams": ["team_id", "team_name", "division_name", "league_name"],
    "standings": ["team_id", "team_name", "wins", "losses", "win_pct"],
    "schedule": ["game_pk", "home_team_id", "away_team_id", "status"],
}


@dataclass(frozen=True)
class Paths:
    """Folders of a run. Documents lie in one folder per feed."""

    documents: str
    messages: str
    tables: str
    checkpoints: str

    def feed(self, name: str) -> str:
        return f"{self.documents.rstrip('/')}/{name}"


def playable_games(all_games: DataFrame, game_day: date, back: int = BACK_DAYS) -> DataFrame:
    """Finished or live games of the newest day that has any, at most ``back`` days ago."""
    return latest_day_with(
        all_games,
        "game_day",
        F.col("status").isin(*FINISHED, *LIVE),
        F.lit(game_day.isoformat()).cast("date"),
        back,
    )


def feed_documents(
    spark: SparkSession,
    paths: Paths,
    name: str,
    schema: StructType,
    whole_files: bool = False,
    days: tuple[date, date] | None = None,
) -> DataFrame:
    return feeds.read_documents(spark, paths.feed(name), schema, whole_files, days)


def plain_feeds(
    spark: SparkSession, paths: Paths, season: int, whole_files: bool = False
) -> dict[str, DataFrame]:
    """Teams, standings and statistics, which need no day."""
    plain = {
        "teams": (feeds.teams, "teams", schemas.TEAMS_DOC),
        "standings": (feeds.standings, "standings", schemas.STANDINGS_DOC),
        "hitting_stats": (feeds.hitting_stats, "hitting", schemas.HITTING_DOC),
        "pitching_stats": (feeds.pitching_stats, "pitching", schemas.PITCHING_DOC),
    }
    return {
        name: flatten(feed_documents(spark, paths, folder, schema, whole_files), season)
        for name, (flatten, folder, schema) in plain.items()
    }


def season_games(all_games: DataFrame, first_day: date, game_day: date, back: int = BACK_DAYS) -> DataFrame:
    """Rows of the schedule table: the season's regular games so far, all games of the day,
    and all games of the days that were walked back over for playable games."""
    today = F.lit(game_day.isoformat()).cast("date")
    oldest = F.date_sub(today, back)
    # The day the walk stopped at; its far end if no day had a playable game.
    reached = playable_games(all_games, game_day, back).agg(F.min("game_day")).scalar()
    near = all_games.filter(F.col("game_day").between(oldest, today))
    walked = near.filter(F.col("game_day") >= F.coalesce(reached, oldest))
    first = F.lit(first_day.isoformat()).cast("date")
    regular = all_games.filter(F.col("game_day").between(first, today) & (F.col("game_type") == "R"))
    return union_feeds([regular.select(*feeds.SCHEDULE_COLUMNS), walked.select(*feeds.SCHEDULE_COLUMNS)])


def feed_rows(
    spark: SparkSession,
    paths: Paths,
    season: int,
    game_day: date,
    whole_files: bool = False,
    first_day: date | None = None,
) -> dict[str, DataFrame]:
    """Flattened rows of all six feeds for one run."""
    first_day = feeds.first_game_day(season, first_day)
    oldest = game_day - timedelta(days=BACK_DAYS)
    # Parsed once: the schedule, the walk back and the plays' games come from these rows.
    days = (min(first_day, oldest), game_day)
    documents = feed_documents(spark, paths, "schedule", schemas.SCHEDULE_DOC, whole_files, days)
    all_games = settle(feeds.games(documents), "games")
    played = playable_games(all_games, game_day).select(F.col("game_pk").alias("gamePk"))
    # Written first, so that its size decides whether the documents must be shuffled.
    wanted = settle(played.distinct(), "played")
    documents = feed_documents(spark, paths, "plays", schemas.PLAYS_DOC, whole_files, (oldest, game_day))
    plays = documents.join(wanted, "gamePk", "left_semi")
    return {
        **plain_feeds(spark, paths, season, whole_files),
        "schedule": season_games(all_games, first_day, game_day),
        "game_events": feeds.game_events(plays),
    }


def publish(
    rows: dict[str, DataFrame], path: str, run_id: str, as_of: datetime
) -> dict[str, int]:
    """Write all feeds as keyed messages; returns messages per feed."""
    moment = F.lit(as_of)
    return {
        name: write_messages(to_messages(df, FEEDS[name], run_id, moment), path)
        for name, df in rows.items()
    }


def build_staging(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Staging tables, stored and read back: the marts and every check read them, and a
    stored table is deduplicated once. Plays are appended, the others replaced."""
    raw = {name: read_raw(spark, root, feed) for name, feed in FEEDS.items()}
    stage_events(spark, root, raw["game_events"])
    models = {
        "stg_teams": staging.stg_teams(raw["teams"]),
        "stg_standings": staging.stg_standings(raw["standings"]),
        "stg_schedule": staging.stg_schedule(raw["schedule"]),
        "stg_hitting_stats": staging.stg_hitting_stats(raw["hitting_stats"]),
        "stg_pitching_stats": staging.stg_pitching_stats(raw["pitching_stats"]),
    }
    stored = store_models(spark, root, models)
    plays = event_schema(raw["game_events"])
    return {**stored, "stg_game_events": open_table(spark, root, "stg_game_events", plays, PLAY_LEVELS)}


def event_schema(raw: DataFrame) -> StructType:
    """Columns of the stored plays."""
    levels = {EVENT_BLOCK: staging.game_block(), "batch": F.lit("")}
    return staging.typed_events(raw).withColumns(levels).schema


def stage_events(spark: SparkSession, root: str, raw: DataFrame) -> None:
    """Add the plays of the batches that landed since the last time.

    The marks, the last batch seen of every source, are written after the plays and name the
    folder of the plays that come next. If they are lost, the batches are read again and the
    folder is overwritten, so nothing is stored twice. Marks are one line per landing stream.
    """
    stored = open_table(spark, root, EVENT_MARKS, MARK_SCHEMA)
    marks = {row["source"]: row["batch"] for row in stored.collect()}
    new = ~F.col("source").isin(list(marks)) if marks else F.lit(True)
    for source, batch in marks.items():
        new = new | ((F.col("source") == source) & (F.col("batch") > batch))
    arrived = raw.filter(new)
    latest = arrived.groupBy("source").agg(F.max("batch").alias("batch")).collect()
    if not latest:
        return
    said = "\n".join(f"{source} {batch}" for source, batch in sorted(marks.items()))
    add_plays(arrived, root, hashlib.md5(said.encode()).hexdigest())
    marks.update({row["source"]: row["batch"] for row in latest})
    replace_table(spark.createDataFrame(list(marks.items()), MARK_SCHEMA), root, EVENT_MARKS)


def store_models(
    spark: SparkSession, root: str, models: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Replace the tables of the given models and read them back."""
    for name, df in models.items():
        replace_table(df, root, name)
    return {name: read_table(spark, root, name, df.schema) for name, df in models.items()}


def build_marts(spark: SparkSession, root: str, staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Mart tables, stored and read back."""
    models = {
        "mart_standings": marts.mart_standings(staged["stg_standings"]),
        "mart_game_results": marts.mart_game_results(staged["stg_schedule"]),
        "mart_player_stats": marts.mart_player_stats(staged["stg_hitting_stats"]),
        "mart_pitching_leaders": marts.mart_pitching_leaders(staged["stg_pitching_stats"]),
    }
    return store_models(spark, root, models)


def all_tables(
    spark: SparkSession, root: str, staged: dict[str, DataFrame], stored: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    raw = {feed.table: read_raw(spark, root, feed) for feed in FEEDS.values()}
    return {**raw, **staged, **stored}


def reports(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What the report pages show, apart from the predictions of a day."""
    standings, players = tables["mart_standings"], tables["mart_player_stats"]
    pitching, results = tables["mart_pitching_leaders"], tables["mart_game_results"]
    return {
        "standings_summary": summaries.standings_summary(standings),
        "standings": standings_in_order(standings),
        "batting_summary": summaries.batting_summary(players),
        "top_batters": summaries.top_batters(players),
        "players": player_stats_in_order(players),
        "pitching_summary": summaries.pitching_summary(pitching),
        "top_starters": summaries.top_starters(pitching),
        "pitchers": pitching_leaders_in_order(pitching),
        "games_summary": summaries.games_summary(results),
        "wins_by_team": summaries.wins_by_team(results).orderBy("wins", "team"),
        "game_log": summaries.game_log(game_results_in_order(results)),
    }


def predict_day(
    spark: SparkSession, paths: Paths, tables: dict[str, DataFrame], game_day: date,
    whole_files: bool = False,
) -> DataFrame:
    """Home-run leaderboard of one day's games."""
    days = (game_day, game_day)
    documents = feed_documents(spark, paths, "schedule", schemas.SCHEDULE_DOC, whole_files, days)
    sides = feeds.probable_pitchers(documents, F.lit(game_day.isoformat()).cast("date"))
    return predictions.hr_leaderboard(
        sides, tables["mart_player_stats"], tables["mart_pitching_leaders"]
    )


def run_checks(
    tables: dict[str, DataFrame], as_of: datetime, strict: bool = True
) -> dict[str, DataFrame]:
    """Column rules, freshness of the plays, and volume. ``strict`` raises on failures."""
    found = {
        "contracts": quality.contracts(tables, CONTRACTS),
        "freshness": quality.freshness(tables["raw_game_events"], EVENT_TIME, as_of),
        "volume": quality.volume(tables, VOLUME_FLOORS),
    }
    # Stored, so that looking at a report does not run its checks again.
    reports = {name: settle(report, name) for name, report in found.items()}
    if strict:
        quality.require(
            reports["contracts"],
            F.col("status") == "fail",
            F.concat_ws(" ", "table_name", "check_name", "column_name", F.col("failures").cast("string")),
            "Column checks failed:",
        )
        quality.require(
            reports["freshness"],
            F.col("status") == "error",
            F.concat(F.lit("newest play: "), F.coalesce(F.col("newest").cast("string"), F.lit("none"))),
            "Freshness check failed:",
        )
        quality.require(
            reports["volume"],
            F.col("status") == "FAIL",
            F.concat("table_name", F.lit(": "), "n_rows", F.lit(" < "), "min_rows"),
            "Volume checks failed:",
        )
    return reports


def run(
    spark: SparkSession,
    paths: Paths,
    season: int,
    game_day: date,
    as_of: datetime,
    run_id: str,
    strict: bool = True,
    whole_files: bool = False,
    first_day: date | None = None,
    max_files: int | None = 1000,
) -> dict[str, DataFrame]:
    """One scheduled run. Every run, also a repeated one, needs a run id that sorts after
    the ones before it: the snapshot tables show the messages of the greatest id.

    ``first_day`` is the season's first day; only that of 2026 is known without it. Besides
    the tables and reports the result has ``published`` and ``landed``, messages by topic.
    A micro-batch takes ``max_files`` message files. With ``strict``, unreadable messages
    raise after everything readable is stored, staged and counted, and only in the run that
    landed them.
    """
    rows = feed_rows(spark, paths, season, game_day, whole_files, first_day)
    sent = publish(rows, paths.messages, run_id, as_of)
    before = last_batch(spark, paths.tables)
    stream = read_messages(spark, paths.messages, max_files)
    land_stream(stream, paths.tables, f"{paths.checkpoints}/land").awaitTermination()
    staged = build_staging(spark, paths.tables)
    stored = build_marts(spark, paths.tables, staged)
    tables = all_tables(spark, paths.tables, staged, stored)
    new = landing_counts(spark, paths.tables).filter((F.col("source") == "feed") & (F.col("batch") > before))
    tables["published"] = spark.createDataFrame(sorted(sent.items()), "topic string, n_messages long")
    tables["landed"] = new.groupBy("topic").agg(F.sum("n_messages").alias("n_messages"), F.sum("n_bad").alias("n_bad"))
    if strict:
        require_readable(spark, paths.tables, before)
    return {**tables, **run_checks(tables, as_of, strict)}


def run_direct(
    spark: SparkSession,
    paths: Paths,
    season: int,
    game_day: date,
    run_id: str,
    whole_files: bool = False,
) -> DataFrame:
    """Teams, standings and the day's schedule without messages, each checked first.

    Each of the three tables is replaced, the schedule too."""
    rows = plain_feeds(spark, paths, season, whole_files)
    today = F.lit(game_day.isoformat()).cast("date")
    days = (game_day, game_day)
    documents = feed_documents(spark, paths, "schedule", schemas.SCHEDULE_DOC, whole_files, days)
    rows["schedule"] = feeds.schedule(documents, today)
    reports = []
    for name, required in REQUIRED.items():
        checked = settle(rows[name], name)
        reports.append(quality.input_report(checked, name, required))
        land_rows(checked, paths.tables, FEEDS[name], run_id)
    first, *rest = reports
    for report in rest:
        first = first.unionByName(report)
    return first
