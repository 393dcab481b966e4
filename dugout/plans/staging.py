"""Raw tables to typed, deduplicated staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.lookups import OTHER_STATUS_PRIORITY, STATUS_PRIORITY, priority
from ..functions.parse import composite_key, guarded_decimal, wall_time, whole
from ..operators.dedup import columns_as_order, keep_first, keep_unseen
from ..operators.ranking import by


def _ints(*names: str) -> list[Column]:
    return [whole(n).alias(n) for n in names]


def stg_teams(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole("team_id").alias("team_id"), "team_name", "abbreviation", "team_code",
        whole("division_id").alias("division_id"), "division_name",
        whole("league_id").alias("league_id"), "league_name",
        whole("venue_id").alias("venue_id"), "venue_name", whole("season").alias("season"),
    )


def stg_standings(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole("team_id").alias("team_id"), "team_name",
        whole("division_id").alias("division_id"), F.col("division").alias("division_name"),
        whole("league_id").alias("league_id"), F.col("league").alias("league_name"),
        *_ints("wins", "losses"),
        F.col("win_pct").cast("decimal(4,3)").alias("win_pct"),
        "games_back", *_ints("games_played", "season"),
    )


def stg_schedule(raw: DataFrame) -> DataFrame:
    """One row per game: the most advanced state, of those the latest landed.

    The landing run is the recency; equal rows are then ordered by all their columns.
    """
    typed = raw.select(
        whole("game_pk", "bigint").alias("game_pk"),
        wall_time("game_date").alias("game_date"),
        F.col("status").alias("game_status"),
        whole("home_team_id").alias("home_team_id"), F.col("home_team").alias("home_team_name"),
        whole("away_team_id").alias("away_team_id"), F.col("away_team").alias("away_team_name"),
        *_ints("home_score", "away_score"),
        F.col("venue").alias("venue_name"),
        (F.col("run_id") if "run_id" in raw.columns else F.lit("")).alias("run_id"),
    )
    state = priority(F.col("game_status"), STATUS_PRIORITY, OTHER_STATUS_PRIORITY)
    order = [state.asc(), F.col("run_id").desc_nulls_last(), *columns_as_order(typed, ["run_id", "game_pk"])]
    return keep_first(typed, ["game_pk"], order).drop("run_id")


def _most_games(typed: DataFrame) -> DataFrame:
    """One row per player: the most games, an unknown count before all others."""
    order = [by("games", desc=True), *columns_as_order(typed, ["games", "player_id"])]
    return keep_first(typed, ["player_id"], order)


def stg_hitting_stats(raw: DataFrame) -> DataFrame:
    typed = raw.filter(whole("player_id").isNotNull()).select(
        whole("player_id").alias("player_id"), "player_name",
        whole("team_id").alias("team_id"), "team_name",
        *_ints(
            "games", "at_bats", "plate_appearances", "hits", "doubles", "triples", "home_runs",
            "rbi", "walks", "strikeouts", "stolen_bases",
        ),
        *[guarded_decimal(c, 5, 3).alias(c) for c in ("batting_avg", "obp", "slg", "ops")],
        whole("season").alias("season"),
    )
    return _most_games(typed)


def stg_pitching_stats(raw: DataFrame) -> DataFrame:
    typed = raw.filter(whole("player_id").isNotNull()).select(
        whole("player_id").alias("player_id"), "player_name",
        whole("team_id").alias("team_id"), "team_name",
        *_ints("games", "games_started", "wins", "losses", "saves"),
        "innings_pitched",
        *_ints(
            "hits_allowed", "earned_runs", "walks_allowed", "strikeouts", "home_runs_allowed"
        ),
        guarded_decimal("era", 6, 2).alias("era"),
        guarded_decimal("whip", 5, 3).alias("whip"),
        guarded_decimal("k_per_9", 5, 2).alias("k_per_9"),
        guarded_decimal("bb_per_9", 5, 2).alias("bb_per_9"),
        whole("season").alias("season"),
    )
    return _most_games(typed)


def typed_events(raw: DataFrame) -> DataFrame:
    """Completed plays with their event id, typed but not deduplicated."""
    return raw.filter("is_complete").select(
        composite_key(whole("game_pk", "bigint"), whole("at_bat_index")).alias("event_id"),
        whole("game_pk", "bigint").alias("game_pk"),
        *_ints("at_bat_index", "inning"),
        "half_inning",
        wall_time("start_time").alias("start_time"),
        wall_time("end_time").alias("end_time"),
        "is_complete",
        F.col("is_scoring").alias("is_scoring_play"),
        "event_type",
        "description",
        *_ints("rbi", "home_score", "away_score", "batter_id"),
        "batter_name",
        whole("pitcher_id").alias("pitcher_id"),
        "pitcher_name",
    )


def event_order(events: DataFrame) -> list[Column]:
    """Which of several copies of a play stays: the latest end time, then a total order."""
    same = ["event_id", "game_pk", "at_bat_index", "end_time"]
    return [F.col("end_time").desc_nulls_last(), *columns_as_order(events, same)]


def stg_game_events(
    raw: DataFrame, existing: DataFrame | None = None, prune_by: str | None = None
) -> DataFrame:
    """One row per play; with ``existing`` only the plays it does not hold yet.

    Rows are deduplicated before the anti join, so copies of one play are gone by then.
    A stored play is never changed.
    """
    events = typed_events(raw).filter(F.col("event_id").isNotNull())
    single = keep_first(events, ["event_id"], event_order(events))
    if existing is None:
        return single
    if prune_by and prune_by not in single.columns:
        single = single.withColumn(prune_by, game_block())
    return keep_unseen(single, existing, "event_id", prune_by)


def single_plays(raw: DataFrame) -> DataFrame:
    """One row per play of a batch, with its ``game_block``."""
    return stg_game_events(raw).withColumn("game_block", game_block())


def game_block(size: int = 1000) -> Column:
    """What stored plays are sorted by: neighbouring game ids, so neighbouring days."""
    return F.floor(F.col("game_pk") / size).cast("bigint")
