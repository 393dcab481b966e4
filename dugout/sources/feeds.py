"""Nested feed documents to flat rows.

Input is a DataFrame of documents, one per row, as ``read_documents`` gives it. Every
flattener is a chain of explodes and field paths, so it runs inside the scan's tasks.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..functions import text
from ..functions.lookups import DIVISIONS, LEAGUES, label_or_code
from ..functions.parse import or_default, win_share
from ..operators.reshape import sides

# Fixed value: first day of the regular season 2026. Other seasons name theirs.
FIRST_GAME_DAYS = {2026: "2026-03-25"}


def read_documents(
    spark: SparkSession,
    path: str,
    schema: StructType,
    whole_files: bool = False,
    days: tuple[date, date] | None = None,
) -> DataFrame:
    """JSON documents: one per line (files can be split), or one per file.

    Documents may lie in ``day=2026-04-10`` folders. With ``days``, only folders from the
    first to the second day are opened, so that a run does not parse what earlier ones did;
    documents outside of such folders are always read.
    """
    full = schema if days is None else StructType([*schema.fields, StructField("day", DateType())])
    reader = spark.read.schema(full)
    rows = (reader.option("multiLine", True) if whole_files else reader).json(path)
    if days is None:
        return rows
    first, last = (F.lit(d.isoformat()).cast("date") for d in days)
    return rows.filter(F.col("day").isNull() | F.col("day").between(first, last)).select(*schema.names)


def parse_documents(documents: DataFrame, column: str, schema: StructType) -> DataFrame:
    """Documents held as text in ``column``, parsed to the fields of ``schema``."""
    return documents.select(F.from_json(column, schema).alias("doc")).select("doc.*")


def each(df: DataFrame, items: Column | str, name: str, *carry: Column | str) -> DataFrame:
    """One row per array element, as struct column ``name`` next to the ``carry`` columns.

    Outer explode and a filter on the element, because a plain explode makes the optimizer
    test the array for emptiness first, which parses a JSON document several times.
    """
    return df.select(*carry, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())


def teams(documents: DataFrame, season: int) -> DataFrame:
    """One row per team; missing division, league or venue objects give NULLs."""
    return each(documents, "teams", "t").select(
        F.col("t.id").alias("team_id"),
        F.col("t.name").alias("team_name"),
        F.col("t.abbreviation").alias("abbreviation"),
        F.col("t.teamCode").alias("team_code"),
        F.col("t.division.id").alias("division_id"),
        F.col("t.division.name").alias("division_name"),
        F.col("t.league.id").alias("league_id"),
        F.col("t.league.name").alias("league_name"),
        F.col("t.venue.id").alias("venue_id"),
        F.col("t.venue.name").alias("venue_name"),
        F.lit(season).alias("season"),
    )


def standings(documents: DataFrame, season: int) -> DataFrame:
    """One row per team record, with division and league of the enclosing record."""
    rows = each(
        each(documents, "records", "r"),
        "r.teamRecords",
        "t",
        F.col("r.division.id").alias("division_id"),
        F.col("r.league.id").alias("league_id"),
    )
    return rows.select(
        F.col("t.team.id").alias("team_id"),
        F.col("t.team.name").alias("team_name"),
        "division_id",
        label_or_code(F.col("division_id"), DIVISIONS).alias("division"),
        "league_id",
        label_or_code(F.col("league_id"), LEAGUES).alias("league"),
        or_default("t.leagueRecord.wins", 0).alias("wins"),
        or_default("t.leagueRecord.losses", 0).alias("losses"),
        win_share(or_default("t.leagueRecord.pct", "0")).alias("win_pct"),
        or_default("t.gamesBack", "-").alias("games_back"),
        or_default("t.gamesPlayed", 0).alias("games_played"),
        F.lit(season).alias("season"),
    )


def games(documents: DataFrame) -> DataFrame:
    """One row per game of the schedule feed, with its day, type and probable pitchers."""
    dates = each(documents, "dates", "d")
    rows = each(dates, "d.games", "g", F.col("d.date").alias("date"))
    return rows.select(
        F.to_date(F.coalesce(F.col("date"), F.substring("g.gameDate", 1, 10))).alias("game_day"),
        F.col("g.gameType").alias("game_type"),
        F.col("g.gamePk").alias("game_pk"),
        F.col("g.gameDate").alias("game_date"),
        F.col("g.status.detailedState").alias("status"),
        F.col("g.teams.home.team.id").alias("home_team_id"),
        F.col("g.teams.home.team.name").alias("home_team"),
        F.col("g.teams.away.team.id").alias("away_team_id"),
        F.col("g.teams.away.team.name").alias("away_team"),
        F.col("g.teams.home.score").alias("home_score"),
        F.col("g.teams.away.score").alias("away_score"),
        F.col("g.venue.name").alias("venue"),
        F.col("g.teams.home.probablePitcher").alias("home_pitcher"),
        F.col("g.teams.away.probablePitcher").alias("away_pitcher"),
    )


SCHEDULE_COLUMNS = [
    "game_pk", "game_date", "status", "home_team_id", "home_team",
    "away_team_id", "away_team", "home_score", "away_score", "venue",
]


def schedule(documents: DataFrame, day: Column, since: Column | None = None) -> DataFrame:
    """All games of one day, or of all days from ``since`` to it."""
    days = F.col("game_day") == day if since is None else F.col("game_day").between(since, day)
    return games(documents).filter(days).select(*SCHEDULE_COLUMNS)


def first_game_day(season: int, given: date | None = None) -> date:
    """The season's first day: as given, or the known one."""
    if given is None and season not in FIRST_GAME_DAYS:
        raise ValueError(f"the first game day of season {season} is not known, pass it")
    return given or date.fromisoformat(FIRST_GAME_DAYS[season])


def season_schedule(
    documents: DataFrame, end: Column, start: Column | None = None, game_type: str = "R"
) -> DataFrame:
    """Regular-season games between two days, both included.

    Without ``start`` it is the first day of 2026; ``first_game_day`` has that of a season.
    """
    start = F.lit(FIRST_GAME_DAYS[2026]).cast("date") if start is None else start
    return (
        games(documents)
        .filter(F.col("game_day").between(start, end) & (F.col("game_type") == game_type))
        .select(*SCHEDULE_COLUMNS)
    )


def _splits(documents: DataFrame) -> DataFrame:
    first = F.get(F.col("stats"), F.lit(0))
    return each(documents, first["splits"], "s")


def _stat_columns(fields: dict[str, str], season: int) -> list[Column]:
    return [
        F.col("s.player.id").alias("player_id"),
        F.col("s.player.fullName").alias("player_name"),
        F.col("s.team.id").alias("team_id"),
        F.col("s.team.name").alias("team_name"),
        *[F.col(f"s.stat.{field}").alias(name) for name, field in fields.items()],
        F.lit(season).alias("season"),
    ]


def hitting_stats(documents: DataFrame, season: int) -> DataFrame:
    """One row per player and team; rates stay text."""
    fields = {
        "games": "gamesPlayed", "at_bats": "atBats", "plate_appearances": "plateAppearances",
        "hits": "hits", "doubles": "doubles", "triples": "triples", "home_runs": "homeRuns",
        "rbi": "rbi", "walks": "baseOnBalls", "strikeouts": "strikeOuts",
        "stolen_bases": "stolenBases", "batting_avg": "avg", "obp": "obp", "slg": "slg",
        "ops": "ops",
    }
    return _splits(documents).select(*_stat_columns(fields, season))


def pitching_stats(documents: DataFrame, season: int) -> DataFrame:
    """One row per pitcher and team; rates and innings stay text."""
    fields = {
        "games": "gamesPlayed", "games_started": "gamesStarted", "wins": "wins",
        "losses": "losses", "saves": "saves", "innings_pitched": "inningsPitched",
        "hits_allowed": "hits", "earned_runs": "earnedRuns", "walks_allowed": "baseOnBalls",
        "strikeouts": "strikeOuts", "home_runs_allowed": "homeRuns", "era": "era",
        "whip": "whip", "k_per_9": "strikeoutsPer9Inn", "bb_per_9": "walksPer9Inn",
    }
    return _splits(documents).select(*_stat_columns(fields, season))


def game_events(documents: DataFrame) -> DataFrame:
    """One row per play; missing completion and scoring flags count as false."""
    plays = each(documents, "liveData.plays.allPlays", "p", "gamePk")
    return plays.select(
        F.col("gamePk").alias("game_pk"),
        F.col("p.about.atBatIndex").alias("at_bat_index"),
        F.col("p.about.inning").alias("inning"),
        F.col("p.about.halfInning").alias("half_inning"),
        F.col("p.about.startTime").alias("start_time"),
        F.col("p.about.endTime").alias("end_time"),
        or_default("p.about.isComplete", False).alias("is_complete"),
        or_default("p.about.isScoringPlay", False).alias("is_scoring"),
        F.col("p.result.event").alias("event_type"),
        F.col("p.result.description").alias("description"),
        F.col("p.result.rbi").alias("rbi"),
        F.col("p.result.homeScore").alias("home_score"),
        F.col("p.result.awayScore").alias("away_score"),
        F.col("p.matchup.batter.id").alias("batter_id"),
        F.col("p.matchup.batter.fullName").alias("batter_name"),
        F.col("p.matchup.pitcher.id").alias("pitcher_id"),
        F.col("p.matchup.pitcher.fullName").alias("pitcher_name"),
    )


def batting_sides(game_rows: DataFrame) -> DataFrame:
    """Two rows per game: each team at bat against the other team's probable pitcher."""

    def side(batting: str, pitching: str) -> dict[str, Column]:
        return {
            "game_pk": F.col("game_pk"),
            "venue": or_default("venue", ""),
            "matchup": text.matchup(F.col("away_team"), F.col("home_team")),
            "batting_team": F.col(f"{batting}_team"),
            "batting_team_id": F.col(f"{batting}_team_id"),
            "pitcher_id": F.col(f"{pitching}_pitcher.id"),
            "pitcher_name": or_default(f"{pitching}_pitcher.fullName", "TBD"),
            "game_status": F.col("status"),
        }

    return sides(game_rows, side("away", "home"), side("home", "away"))


def probable_pitchers(documents: DataFrame, day: Column, game_type: str = "R") -> DataFrame:
    """Batting sides of one day's regular-season games."""
    today = games(documents).filter(
        (F.col("game_day") == day) & (F.col("game_type") == game_type)
    )
    return batting_sides(today)
