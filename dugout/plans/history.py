"""Play-by-play rollups: head-to-head, batting lines, performance and team trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Play results of the feed.
HITS = ("Single", "Double", "Triple", "Home Run")
WALKS = ("Walk", "Intent Walk")
STRIKEOUTS = ("Strikeout", "Strikeout Double Play")
NOT_AT_BAT = (*WALKS, "Hit By Pitch", "Sac Fly", "Sac Bunt", "Catcher Interference")


def _line() -> list[Column]:
    result = F.col("event_type")
    return [
        F.count("*").alias("plate_appearances"),
        F.count_if(~result.isin(*NOT_AT_BAT)).alias("at_bats"),
        F.count_if(result.isin(*HITS)).alias("hits"),
        F.count_if(result == "Home Run").alias("home_runs"),
        F.count_if(result.isin(*WALKS)).alias("walks"),
        F.count_if(result.isin(*STRIKEOUTS)).alias("strikeouts"),
        F.sum(F.coalesce("rbi", F.lit(0))).alias("rbi"),
    ]


def _average() -> Column:
    return F.try_divide(F.col("hits"), F.col("at_bats")).alias("batting_avg")


def pitcher_matchups(events: DataFrame) -> DataFrame:
    """Results of every batter against every pitcher they met."""
    return (
        events.groupBy("pitcher_id", "batter_id")
        .agg(*_line(), F.max("pitcher_name").alias("pitcher_name"), F.max("batter_name").alias("batter_name"))
        .select("*", _average())
    )


def batting_from_plays(events: DataFrame) -> DataFrame:
    """Season line of every batter, counted from plays."""
    return (
        events.groupBy("batter_id")
        .agg(*_line(), F.max("batter_name").alias("batter_name"))
        .select("*", _average())
    )


def running(
    daily: DataFrame, group: str, day: str, totals: dict[str, str]
) -> DataFrame:
    """Running sums per group over its days: ``totals`` maps new columns to daily ones.

    Input has one row per group and day, so a window is as long as the calendar.
    """
    so_far = (
        Window.partitionBy(group).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    )
    return daily.select(
        "*", *[F.sum(source).over(so_far).alias(new) for new, source in totals.items()]
    )


def performance_over_time(events: DataFrame) -> DataFrame:
    """A batter's line per day with hits and at-bats up to that day."""
    daily = events.groupBy("batter_id", F.to_date("start_time").alias("day")).agg(*_line())
    trend = running(
        daily, "batter_id", "day", {"hits_to_date": "hits", "at_bats_to_date": "at_bats"}
    )
    return trend.withColumn(
        "avg_to_date", F.try_divide(F.col("hits_to_date"), F.col("at_bats_to_date"))
    )


def team_trend(results: DataFrame) -> DataFrame:
    """Wins and losses of each team per day and to date; ties count for neither."""
    day = F.to_date("game_date").alias("day")
    team = F.explode(
        F.array(
            F.struct(F.col("winning_team").alias("team"), F.lit(1).alias("won")),
            F.struct(F.col("losing_team").alias("team"), F.lit(0).alias("won")),
        )
    ).alias("t")
    decided = results.filter(F.col("winning_team") != "Tie").select(day, team)
    daily = decided.groupBy(F.col("t.team").alias("team"), "day").agg(
        F.sum("t.won").alias("wins"), F.sum(1 - F.col("t.won")).alias("losses")
    )
    trend = running(
        daily, "team", "day", {"wins_to_date": "wins", "losses_to_date": "losses"}
    )
    return trend.withColumn(
        "win_pct_to_date",
        F.try_divide(F.col("wins_to_date"), F.col("wins_to_date") + F.col("losses_to_date")),
    )
