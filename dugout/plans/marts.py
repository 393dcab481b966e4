"""Staging tables to mart tables. Stored tables carry no order; readers sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.lookups import FINISHED
from ..functions.rates import role
from ..operators.ranking import rank_within

MIN_MART_PA = 10


def mart_standings(standings: DataFrame) -> DataFrame:
    """Standings with ranks by wins, then fewer losses, within division and league."""
    return rank_within(
        standings,
        {"division_rank": ["division_name"], "league_rank": ["league_name"]},
        [("wins", True), ("losses", False)],
    )


def mart_game_results(schedule: DataFrame) -> DataFrame:
    """Finished games with both scores: winner, loser (or ``Tie``) and margin."""
    home, away = F.col("home_score"), F.col("away_score")
    finished = schedule.filter(
        F.col("game_status").isin(*FINISHED) & home.isNotNull() & away.isNotNull()
    )
    return finished.withColumns(
        {
            "winning_team": F.when(home > away, F.col("home_team_name"))
            .when(away > home, F.col("away_team_name"))
            .otherwise("Tie"),
            "losing_team": F.when(home > away, F.col("away_team_name"))
            .when(away > home, F.col("home_team_name"))
            .otherwise("Tie"),
            "run_differential": F.abs(home - away),
        }
    )


def mart_player_stats(hitting: DataFrame, min_pa: int = MIN_MART_PA) -> DataFrame:
    """Hitters with enough plate appearances."""
    return hitting.filter(F.col("plate_appearances") >= min_pa).select(
        "player_id", "player_name", "team_id", "team_name", "games", "plate_appearances",
        "at_bats", "hits", "doubles", "triples", "home_runs", "rbi", "walks", "strikeouts",
        "stolen_bases", "batting_avg", "obp", "slg", "ops", "season",
    )


def mart_pitching_leaders(pitching: DataFrame) -> DataFrame:
    """Pitchers that played, with their role."""
    return pitching.filter("games > 0").withColumn(
        "role", role(F.col("games"), F.col("games_started"))
    )
