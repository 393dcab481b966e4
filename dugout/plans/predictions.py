"""Home-run probability of every batter against the probable pitcher."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import rates, text
from ..functions.lookups import PARK_FACTORS, park_factor
from ..functions.parse import innings


def pitcher_rates(
    pitching: DataFrame,
    league: float = rates.LEAGUE_HR_RATE,
    batters_per_inning: float = rates.BATTERS_PER_INNING,
) -> DataFrame:
    """Home runs per batter faced (estimated from innings) of the starters."""
    faced = innings("innings_pitched") * F.lit(batters_per_inning)
    return pitching.filter(F.col("role") == "Starter").select(
        F.col("player_id").alias("starter_id"),
        F.col("player_name").alias("starter_name"),
        rates.rate_or(F.col("home_runs_allowed"), faced, league).alias("pitcher_rate"),
    )


def batter_rates(
    players: DataFrame,
    min_pa: int = rates.MIN_PLATE_APPEARANCES,
    league: float = rates.LEAGUE_HR_RATE,
    weight: int = rates.REGRESSION_PLATE_APPEARANCES,
) -> DataFrame:
    """Home-run rate of the qualified batters, pulled towards the league's."""
    return players.filter(F.col("plate_appearances") >= min_pa).select(
        F.col("player_name").alias("batter_name"),
        F.col("team_id").alias("batter_team_id"),
        F.col("team_name").alias("team"),
        F.col("home_runs").alias("season_hr"),
        F.col("plate_appearances").alias("season_pa"),
        "batting_avg",
        "ops",
        rates.shrunk_rate(
            F.col("home_runs"), F.col("plate_appearances"), league, weight
        ).alias("batter_rate"),
    )


def hr_probability(
    batter: Column,
    pitcher: Column,
    park: Column,
    league: float = rates.LEAGUE_HR_RATE,
    cap: float = rates.MAX_HR_PROBABILITY,
) -> Column:
    return rates.capped(batter * pitcher / F.lit(league) * park, cap)


def hr_leaderboard(
    matchups: DataFrame,
    players: DataFrame,
    pitching: DataFrame,
    parks: Mapping[str, float] = PARK_FACTORS,
    min_pa: int = rates.MIN_PLATE_APPEARANCES,
    league: float = rates.LEAGUE_HR_RATE,
    cap: float = rates.MAX_HR_PROBABILITY,
    weight: int = rates.REGRESSION_PLATE_APPEARANCES,
    batters_per_inning: float = rates.BATTERS_PER_INNING,
) -> DataFrame:
    """All batters of every side with a probable pitcher; unordered, see ``top_picks``.

    A pitcher who is not a known starter counts with the league rate and the feed's name.
    A side meets one roster, so the output grows with the matchups. Neither join carries
    a broadcast hint: small sides are broadcast by their measured size, and a team or
    pitcher with very many matchups is split by the adaptive skew join.
    """
    known = matchups.filter(F.col("pitcher_id").isNotNull())
    starters = pitcher_rates(pitching, league, batters_per_inning)
    batters = batter_rates(players, min_pa, league, weight)
    faced = known.join(starters, F.col("pitcher_id") == F.col("starter_id"), "left")
    pairs = faced.join(batters, F.col("batting_team_id") == F.col("batter_team_id"), "inner")
    park = park_factor(F.col("venue"), parks)
    rate = F.coalesce(F.col("pitcher_rate"), F.lit(league))
    scored = pairs.withColumn("p", hr_probability(F.col("batter_rate"), rate, park, league, cap))
    return scored.select(
        "batter_name",
        "team",
        F.coalesce("starter_name", "pitcher_name").alias("pitcher"),
        "matchup",
        "venue",
        F.round(park, 2).alias("park_factor"),
        F.round("p", 4).alias("hr_prob"),
        text.percent(F.col("p")).alias("hr_prob_pct"),
        "season_hr",
        "season_pa",
        "batting_avg",
        "ops",
        "game_pk",
    )


def pick_order() -> list[Column]:
    """Highest probability first; name, game and opponent decide between equals."""
    return [
        F.col("hr_prob").desc_nulls_last(), F.col("batter_name").asc_nulls_last(),
        F.col("game_pk").asc_nulls_last(), F.col("pitcher").asc_nulls_last(),
        F.col("team").asc_nulls_last(),
    ]


def top_picks(leaderboard: DataFrame, n: int = 20) -> DataFrame:
    return leaderboard.orderBy(*pick_order()).limit(n)
