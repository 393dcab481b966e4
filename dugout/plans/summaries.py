"""The tables and figures behind the five report pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text
from ..operators.ranking import Board, by, leaders, nulls_last, top_n

# The two leagues by label.
LEAGUE_BOARDS = {"AL Leader": "American League", "NL Leader": "National League"}


def _figure(name: str, headline: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(name).alias("figure"), headline.alias("headline"), detail.alias("detail")
    )


def _figures(row: DataFrame, figures: Sequence[Column]) -> DataFrame:
    return row.select(F.explode(F.array(*figures)).alias("f")).select("f.*")


def league_leaders(
    standings: DataFrame, leagues: Mapping[str, str] = LEAGUE_BOARDS
) -> DataFrame:
    """First-ranked team of each league with record and share of wins.

    Of several first-ranked teams the first in the order of the standings page counts.
    """
    boards = [
        Board(label, "league_rank", desc=False, where=F.col("league_name") == league)
        for label, league in leagues.items()
    ]
    keep = ["team_name", "wins", "losses", "win_pct", "season"]
    tie = [F.col(c) for c in ("division_name", "division_rank", "team_name")]
    best = leaders(standings, boards, keep, tie)
    return best.select(
        F.col("board").alias("figure"),
        F.col("team_name").alias("headline"),
        F.concat(
            text.record(F.col("wins"), F.col("losses")),
            F.lit("  ·  "),
            text.fixed(F.col("win_pct"), 3),
        ).alias("detail"),
    )


def standings_summary(
    standings: DataFrame, leagues: Mapping[str, str] = LEAGUE_BOARDS
) -> DataFrame:
    """League leaders, number of teams and season."""
    totals = standings.agg(F.count("*").alias("teams"), F.max("season").alias("season"))
    more = _figures(
        totals,
        [
            _figure("Total Teams", F.col("teams").cast("string"), F.lit("franchises")),
            _figure("Season", F.col("season").cast("string"), F.lit("current season")),
        ],
    )
    return league_leaders(standings, leagues).unionByName(more)


def _board_text(best: DataFrame, name: str, digits: Mapping[str, int], words: Mapping[str, str]):
    """``prefix value`` or ``value unit`` per board, decimals by board."""
    detail = F.lit(None).cast("string")
    for board, label in words.items():
        places = digits.get(board)
        shown = (
            text.with_unit(F.col("value"), label)
            if places is None
            else F.concat(F.lit(f"{label} "), text.fixed(F.col("value"), places))
        )
        detail = F.when(F.col("board") == board, shown).otherwise(detail)
    return best.select(
        F.col("board").alias("figure"), F.col(name).alias("headline"), detail.alias("detail")
    )


def batting_summary(players: DataFrame) -> DataFrame:
    """Leaders in average, home runs and OPS."""
    boards = [
        Board("AVG Leader", "batting_avg"),
        Board("HR Leader", "home_runs"),
        Board("OPS Leader", "ops"),
    ]
    # Reports list players by OPS, so the better OPS decides between equals.
    tie = [-F.col("ops").cast("double"), F.col("player_id")]
    best = leaders(players, boards, ["player_name"], tie)
    return _board_text(
        best,
        "player_name",
        {"AVG Leader": 3, "OPS Leader": 3},
        {"AVG Leader": "AVG", "HR Leader": "HR", "OPS Leader": "OPS"},
    )


def top_batters(players: DataFrame, n: int = 15) -> DataFrame:
    """Best OPS, in the chart's order (worst of the best first)."""
    best = top_n(players, [nulls_last("ops", desc=True), by("player_id")], n, "ops")
    return best.orderBy(by("ops"), F.col("player_id").desc())


def pitching_summary(pitching: DataFrame) -> DataFrame:
    """Leaders in ERA and wins (starters), strikeouts (all) and saves (relievers)."""
    starter, reliever = F.col("role") == "Starter", F.col("role") == "Reliever"
    boards = [
        Board("ERA Leader", "era", desc=False, where=starter),
        Board("K Leader", "strikeouts"),
        Board("Win Leader", "wins", where=starter),
        Board("Save Leader", "saves", where=reliever),
    ]
    # Reports list pitchers by role name, then ERA.
    tie = [F.col("role"), F.col("era"), F.col("player_id")]
    best = leaders(pitching, boards, ["player_name"], tie)
    return _board_text(
        best,
        "player_name",
        {"ERA Leader": 2},
        {"ERA Leader": "ERA", "K Leader": "K", "Win Leader": "W", "Save Leader": "SV"},
    )


def top_starters(pitching: DataFrame, n: int = 15) -> DataFrame:
    """Lowest ERA among starters, in the chart's order (highest of them first)."""
    starters = pitching.filter(F.col("role") == "Starter")
    best = top_n(starters, [by("era"), by("player_id")], n, "era")
    return best.orderBy(F.col("era").desc(), F.col("player_id").desc())


def wins_by_team(results: DataFrame) -> DataFrame:
    """How often each name won, ``Tie`` included; readers order by ``wins`` for the chart."""
    return (
        results.filter(F.col("winning_team").isNotNull())
        .groupBy(F.col("winning_team").alias("team"))
        .agg(F.count("*").alias("wins"))
    )


def game_log(results: DataFrame) -> DataFrame:
    """Results with day and score as text."""
    return results.select(
        text.day(F.col("game_date")).alias("game_date"),
        "away_team_name",
        "home_team_name",
        text.score(F.col("away_score"), F.col("home_score")).alias("score"),
        "winning_team",
        "run_differential",
        "venue_name",
    )


def game_totals(results: DataFrame) -> DataFrame:
    """One row: games, mean runs, widest and closest margin with their winners.

    Between equal margins the newer game counts, then the lower game id.
    """
    runs = F.coalesce("home_score", F.lit(0)) + F.coalesce("away_score", F.lit(0))
    margin = F.col("run_differential")
    newest = -F.unix_micros(F.col("game_date").cast("timestamp"))

    def place(value: Column) -> Column:
        return F.when(
            margin.isNotNull(), F.struct(value.alias("m"), newest.alias("t"), F.col("game_pk"))
        )

    return results.agg(
        F.count("*").alias("games"),
        F.avg(runs).alias("avg_runs"),
        F.max(margin).alias("biggest"),
        F.min_by("winning_team", place(-margin)).alias("biggest_winner"),
        F.min(margin).alias("closest"),
        F.min_by("winning_team", place(margin)).alias("closest_winner"),
    )


def games_summary(results: DataFrame) -> DataFrame:
    """Game totals as display text."""
    return _figures(
        game_totals(results),
        [
            _figure("Games", F.col("games").cast("string"), F.lit("completed")),
            _figure("Avg Runs", text.fixed(F.col("avg_runs"), 1), F.lit("per game")),
            _figure("Biggest Win", text.with_unit(F.col("biggest"), "runs"), F.col("biggest_winner")),
            _figure("Closest Game", text.with_unit(F.col("closest"), "run"), F.col("closest_winner")),
        ],
    )


def plays_per_game(events: DataFrame, game: str = "game_pk") -> DataFrame:
    """Plays of every game, and their total in the row without a game."""
    return events.rollup(game).agg(F.count("*").alias("plays"))


def leaderboard_totals(board: DataFrame) -> DataFrame:
    """One row: top candidate, matchups, best park, mean probability, rows.

    The board is aggregated by matchup first, where tasks send a line per matchup, and these
    lines once more: that counts the matchups on the way.
    """
    pick = F.struct("batter_name", "hr_prob_pct", "matchup")
    park = F.struct((-F.col("park_factor")).alias("f"), *best_fields())
    lines = board.groupBy("matchup").agg(
        F.min(F.struct(F.struct(*best_fields()).alias("key"), pick.alias("row"))).alias("pick"),
        F.min(F.struct(park.alias("key"), F.struct("venue", "park_factor").alias("row"))).alias("park"),
        F.sum("hr_prob").alias("prob"),
        F.count("hr_prob").alias("probs"),
        F.count("*").alias("n_rows"),
    )
    return lines.agg(
        F.min("pick")["row"].alias("pick"),
        F.min("park")["row"].alias("park"),
        F.try_divide(F.sum("prob"), F.sum("probs")).alias("avg_prob"),
        F.sum("n_rows").alias("n_rows"),
        F.count("matchup").alias("games"),
    )


def best_fields() -> list[Column]:
    """The leaderboard's order as ascending fields, to break ties as its listing does."""
    return [
        (-F.col("hr_prob")).alias("p"), F.col("batter_name"), F.col("game_pk"),
        F.col("pitcher"), F.col("team"),
    ]


def leaderboard_summary(board: DataFrame) -> DataFrame:
    """Leaderboard totals as display text."""
    totals = leaderboard_totals(board).filter("n_rows > 0")
    return _figures(
        totals,
        [
            _figure(
                "Top Candidate",
                F.col("pick.batter_name"),
                F.concat(F.col("pick.hr_prob_pct"), F.lit(" · "), F.col("pick.matchup")),
            ),
            _figure(
                "Games Today",
                F.col("games").cast("string"),
                F.lit("with probable pitchers announced"),
            ),
            _figure(
                "Best Park Today",
                text.last_word(F.col("park.venue")),
                F.concat(F.lit("Park factor "), text.fixed(F.col("park.park_factor"), 2), F.lit("×")),
            ),
            _figure(
                "Avg HR Probability",
                text.percent(F.col("avg_prob")),
                F.concat(
                    F.lit("across "), F.col("n_rows").cast("string"), F.lit(" qualifying matchups")
                ),
            ),
        ],
    )
