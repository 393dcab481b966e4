"""Staging models, marts, predictions, summaries and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.parse import composite_key as joined_key
from ..operators.dedup import columns_as_order, keep_first, keep_unseen
from ..operators.ranking import by
from ..operators.reshape import latest_day_with
from ..plans import history, marts, predictions, staging, summaries
from .registry import case, table
from .roles import (
    LEADERBOARD_SQL, PARKS, PITCHERS_SQL, PLAYERS_SQL, PLAYS_SQL, RESULTS_SQL, STANDINGS_SQL,
    TYPED_PLAYS_SQL, as_raw_plays, games, matchups, pitchers, players, raw_plays, standings,
)

_RATES = ("batting_avg", "obp", "slg", "ops")


def _doubles(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# ---- staging --------------------------------------------------------------------------

_LINE_TIES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus"]
_LINE_TIES_SQL = ", ".join(_LINE_TIES)


@case(f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
            CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 3 END, l_shipdate DESC,
            {_LINE_TIES_SQL}) AS rn FROM lineitem) t WHERE rn = 1""")
def status_priority_dedup(spark, folder):
    """One line per key: best state, then newest, then a total order."""
    flag = F.col("l_returnflag")
    state = F.when(flag == "A", 1).when(flag == "R", 2).otherwise(3)
    order = [state.asc(), F.col("l_shipdate").desc(), *[F.col(c).asc() for c in _LINE_TIES]]
    return keep_first(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], order)


@case(f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT * REPLACE (CASE WHEN l_quantity <> 50 THEN l_quantity END AS l_quantity),
            row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
            CASE WHEN lineitem.l_quantity <> 50 THEN lineitem.l_quantity END DESC NULLS FIRST, l_shipdate DESC,
            l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
        FROM lineitem) t WHERE rn = 1""")
def distinct_on_max(spark, folder):
    """One line per key: greatest quantity, an unknown one first."""
    lines = table(spark, folder, "lineitem").withColumn(
        "l_quantity", F.when(F.col("l_quantity") != 50, F.col("l_quantity"))
    )
    ties = ["l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    order = [by("l_quantity", desc=True), F.col("l_shipdate").desc(), *[F.col(c).asc() for c in ties]]
    return keep_first(lines, ["l_orderkey", "l_linenumber"], order)


@case("""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY l_partkey, l_suppkey, l_quantity,
            l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
        FROM (SELECT l_orderkey || '_' || l_linenumber AS event_id, * EXCLUDE (l_orderkey, l_linenumber)
              FROM lineitem) k) t WHERE rn = 1""")
def distinct_on_key(spark, folder):
    """Any one line per composite key, made definite by ordering all columns."""
    lines = table(spark, folder, "lineitem").select(
        joined_key("l_orderkey", "l_linenumber").alias("event_id"),
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    return keep_first(lines, ["event_id"], columns_as_order(lines, ["event_id"]))


@case(PLAYS_SQL)
def game_events_staging(spark, folder):
    """The play staging model, first run: typed, completed plays only, one per key."""
    return staging.stg_game_events(raw_plays(spark, folder))


@case(f"""
    WITH plays AS ({PLAYS_SQL}),
    known AS (SELECT event_id FROM ({TYPED_PLAYS_SQL}) k WHERE start_time < TIMESTAMP '1998-01-01')
    SELECT * FROM plays WHERE event_id NOT IN (SELECT event_id FROM known)""")
def game_events_increment(spark, folder):
    """The play staging model, later run: only plays whose key is not stored yet."""
    lines = table(spark, folder, "lineitem")
    stored = lines.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    known = staging.typed_events(as_raw_plays(stored))
    return staging.stg_game_events(as_raw_plays(lines), known)


@case("""
    SELECT event_id, ts, event_type, value FROM events
    WHERE event_type <> 'error' AND event_id NOT IN
          (SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_id IS NOT NULL)""")
def incremental_antijoin(spark, folder):
    """Completed rows whose key is not in the target; missing keys in the target do no harm."""
    events = table(spark, folder, "events")
    target = events.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")).withColumn(
        "event_id", F.when(F.col("value") >= 0, F.col("event_id"))
    )
    complete = events.filter(F.col("event_type") != "error")
    return keep_unseen(complete, target, "event_id").select("event_id", "ts", "event_type", "value")


def _stint_sql(columns: str, ties: str) -> str:
    return f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY games DESC, {ties}) AS rn
        FROM ({columns}) s) t WHERE rn = 1"""


# Statistics of a stint: what is added to the number of its rows.
_HITTING = {
    "at_bats": 50, "plate_appearances": 60, "hits": 1, "doubles": 2, "triples": 3, "home_runs": 4, "rbi": 5,
    "walks": 6, "strikeouts": 7, "stolen_bases": 8,
}
_PITCHING = {
    "games_started": 1, "wins": 2, "losses": 3, "saves": 4, "hits_allowed": 5, "earned_runs": 6,
    "walks_allowed": 7, "strikeouts": 8, "home_runs_allowed": 9,
}


def _counts_sql(numbers: dict[str, int]) -> str:
    return ", ".join(f"(count(*) + {n})::INT AS {c}" for c, n in numbers.items())


def _counts(numbers: dict[str, int]):
    return [(F.col("n") + n).cast("double").alias(c) for c, n in numbers.items()]


@case(_stint_sql(f"""
        SELECT o_custkey::INT AS player_id, 'p' || o_custkey AS player_name,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS team_id,
               o_orderstatus AS team_name, count(*)::INT AS games, {_counts_sql(_HITTING)},
               (CASE WHEN count(*) >= 3 THEN (200 + count(*)) / 1000 END)::DECIMAL(5,3) AS batting_avg,
               ((300 + count(*)) / 1000)::DECIMAL(5,3) AS obp, ((400 + count(*)) / 1000)::DECIMAL(5,3) AS slg,
               (CASE WHEN count(*) < 6 THEN (1000 + count(*)) / 1000 END)::DECIMAL(5,3) AS ops, 2026 AS season
        FROM orders GROUP BY o_custkey, o_orderstatus""", "player_name, team_id"))
def hitting_staging(spark, folder):
    """The hitting staging model: several stints per player, the longest one stays."""
    status, n = F.col("o_orderstatus"), F.col("n")
    stints = table(spark, folder, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))

    def rate(thousands: int):
        return F.concat(F.lit("."), (thousands + n).cast("string"))

    raw = stints.select(
        F.col("o_custkey").cast("double").alias("player_id"),
        F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("player_name"),
        F.when(status == "F", 1.0).when(status == "O", 2.0).otherwise(3.0).alias("team_id"),
        status.alias("team_name"),
        n.cast("double").alias("games"),
        *_counts(_HITTING),
        F.when(n < 3, ".---").otherwise(rate(200)).alias("batting_avg"),
        rate(300).alias("obp"), rate(400).alias("slg"),
        F.when(n < 6, F.concat(F.lit("1.00"), n.cast("string"))).otherwise("-").alias("ops"),
        F.lit(2026.0).alias("season"),
    )
    return staging.stg_hitting_stats(raw)


@case(_stint_sql(f"""
        SELECT l_suppkey::INT AS player_id, 'p' || l_suppkey AS player_name, 1 AS team_id, l_returnflag AS team_name,
               count(*)::INT AS games, {_counts_sql(_PITCHING)},
               (count(*) // 3) || '.' || (count(*) % 3) AS innings_pitched,
               (floor(count(*) * 100 / 7) / 100)::DECIMAL(6,2) AS era,
               CASE WHEN count(*) < 100 THEN count(*)::DECIMAL(5,3) END AS whip,
               9.25::DECIMAL(5,2) AS k_per_9, NULL::DECIMAL(5,2) AS bb_per_9, 2026 AS season
        FROM lineitem GROUP BY l_suppkey, l_returnflag""", "player_name, team_id, team_name"))
def pitching_staging(spark, folder):
    """The pitching staging model; a value too wide for its decimal is missing."""
    n = F.col("n")
    stints = table(spark, folder, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"))
    cents = F.floor(n * 100 / 7)
    raw = stints.select(
        F.col("l_suppkey").cast("double").alias("player_id"),
        F.concat(F.lit("p"), F.col("l_suppkey").cast("string")).alias("player_name"),
        F.lit(1.0).alias("team_id"),
        F.col("l_returnflag").alias("team_name"),
        n.cast("double").alias("games"),
        *_counts(_PITCHING),
        F.concat(F.floor(n / 3).cast("string"), F.lit("."), (n % 3).cast("string")).alias("innings_pitched"),
        F.concat(
            F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0")
        ).alias("era"),
        n.cast("string").alias("whip"),
        F.lit("9.25").alias("k_per_9"),
        F.lit("-.--").alias("bb_per_9"),
        F.lit(2026.0).alias("season"),
    )
    return staging.stg_pitching_stats(raw)


@case("""
    SELECT * EXCLUDE (rn, run) FROM (
        SELECT *, row_number() OVER (PARTITION BY game_pk ORDER BY
            CASE game_status WHEN 'Final' THEN 1 WHEN 'In Progress' THEN 2 WHEN 'Warmup' THEN 3 ELSE 4 END,
            run DESC, game_date, game_status, home_team_id, home_team_name, away_team_id, away_team_name,
            home_score, away_score, venue_name) AS rn
        FROM (SELECT l_orderkey AS game_pk, l_shipdate AS game_date,
                     CASE WHEN l_quantity > 45 THEN 'Final' WHEN l_quantity > 30 THEN 'In Progress'
                          WHEN l_quantity > 20 THEN 'Warmup' ELSE 'Manager Challenge' END AS game_status,
                     l_partkey::INT AS home_team_id, 'h' || l_partkey AS home_team_name,
                     l_suppkey::INT AS away_team_id, 'a' || l_suppkey AS away_team_name,
                     l_quantity::INT AS home_score, NULL::INT AS away_score, 'v' || l_linenumber AS venue_name,
                     'r' || (l_linenumber % 3) AS run FROM lineitem) s) t
    WHERE rn = 1""")
def schedule_staging(spark, folder):
    """The schedule staging model on repeated fetches of each game, in several runs."""
    quantity = F.col("l_quantity")
    status = (
        F.when(quantity > 45, "Final").when(quantity > 30, "In Progress")
        .when(quantity > 20, "Warmup").otherwise("Manager Challenge")
    )

    def named(word: str, column: str):
        return F.concat(F.lit(word), F.col(column).cast("string"))

    raw = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("double").alias("game_pk"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("game_date"),
        status.alias("status"),
        F.col("l_partkey").cast("double").alias("home_team_id"), named("h", "l_partkey").alias("home_team"),
        F.col("l_suppkey").cast("double").alias("away_team_id"), named("a", "l_suppkey").alias("away_team"),
        quantity.alias("home_score"), F.lit(float("nan")).alias("away_score"),
        named("v", "l_linenumber").alias("venue"),
        F.concat(F.lit("r"), (F.col("l_linenumber") % 3).cast("string")).alias("run_id"),
    )
    return staging.stg_schedule(raw)


# ---- marts ----------------------------------------------------------------------------


@case(f"""
    SELECT *, 2026 AS season, rank() OVER (PARTITION BY division_name ORDER BY wins DESC, losses) AS division_rank,
           rank() OVER (PARTITION BY league_name ORDER BY wins DESC, losses) AS league_rank
    FROM ({STANDINGS_SQL}) s""")
def mart_standings(spark, folder):
    """Standings with division and league ranks."""
    ranked = marts.mart_standings(standings(spark, folder))
    return _doubles(ranked, "win_pct")


@case(f"""
    WITH r AS ({RESULTS_SQL})
    SELECT 'Games' AS figure, count(*)::VARCHAR AS headline, 'completed' AS detail FROM r
    UNION ALL SELECT 'Avg Runs', printf('%.1f', avg(coalesce(home_score, 0) + coalesce(away_score, 0))), 'per game' FROM r
    UNION ALL (SELECT 'Biggest Win', run_differential || ' runs', winning_team FROM r
               WHERE run_differential IS NOT NULL ORDER BY run_differential DESC, game_date DESC, game_pk LIMIT 1)
    UNION ALL (SELECT 'Closest Game', run_differential || ' run', winning_team FROM r
               WHERE run_differential IS NOT NULL ORDER BY run_differential, game_date DESC, game_pk LIMIT 1)""")
def games_summary(spark, folder):
    """Games, runs, widest and closest margin as display text."""
    return summaries.games_summary(marts.mart_game_results(games(spark, folder)))


@case(RESULTS_SQL)
def game_outcomes(spark, folder):
    """Finished games with winner, loser or tie, and margin."""
    return marts.mart_game_results(games(spark, folder))


@case(f"SELECT *, 2026 AS season FROM ({PLAYERS_SQL}) p WHERE plate_appearances >= 20")
def qualified_leaders(spark, folder):
    """Batters with enough plate appearances."""
    return _doubles(marts.mart_player_stats(players(spark, folder), 20), *_RATES)


def _leaders(spark, folder):
    return marts.mart_pitching_leaders(pitchers(spark, folder))


@case(f"SELECT * EXCLUDE (innings) FROM ({PITCHERS_SQL}) q")
def role_classify(spark, folder):
    """Pitchers with their role."""
    return _doubles(_leaders(spark, folder), "era")


# ---- predictions ----------------------------------------------------------------------


def _board(spark, folder):
    return predictions.hr_leaderboard(
        matchups(spark, folder), players(spark, folder), _leaders(spark, folder), PARKS
    )


@case(LEADERBOARD_SQL)
def hr_leaderboard(spark, folder):
    """Home-run probability of every batter of every matchup."""
    return _doubles(_board(spark, folder), "batting_avg", "ops")


@case(f"""
    SELECT * FROM ({LEADERBOARD_SQL}) b
    ORDER BY hr_prob DESC, batter_name, game_pk, pitcher, team LIMIT 20""")
def top_picks(spark, folder):
    """The twenty most probable home runs."""
    return _doubles(predictions.top_picks(_board(spark, folder)), "batting_avg", "ops")


@case(f"""
    WITH b AS ({LEADERBOARD_SQL}),
    best AS (SELECT * FROM b ORDER BY hr_prob DESC, batter_name, game_pk, pitcher, team LIMIT 1),
    park AS (SELECT * FROM b ORDER BY park_factor DESC, hr_prob DESC, batter_name, game_pk, pitcher, team LIMIT 1)
    SELECT 'Top Candidate' AS figure, batter_name AS headline, hr_prob_pct || ' · ' || matchup AS detail FROM best
    UNION ALL SELECT 'Games Today', count(DISTINCT matchup)::VARCHAR, 'with probable pitchers announced' FROM b
    UNION ALL SELECT 'Best Park Today', regexp_extract(venue, '[^ ]+$'),
                     'Park factor ' || printf('%.2f', park_factor) || '×' FROM park
    UNION ALL SELECT 'Avg HR Probability', printf('%.1f%%', avg(hr_prob) * 100),
                     'across ' || count(*) || ' qualifying matchups' FROM b""")
def leaderboard_summary(spark, folder):
    """Headline figures of the leaderboard."""
    return summaries.leaderboard_summary(_board(spark, folder))


# ---- summaries ------------------------------------------------------------------------


@case(f"""
    SELECT 'AL Leader' AS figure, team_name AS headline,
           wins || '-' || losses || '  ·  ' || printf('%.3f', win_pct) AS detail
    FROM (SELECT * FROM ({STANDINGS_SQL}) s WHERE league_name = 'AMERICA'
          ORDER BY wins DESC, losses, division_name, team_name LIMIT 1) a
    UNION ALL
    SELECT 'NL Leader', team_name, wins || '-' || losses || '  ·  ' || printf('%.3f', win_pct)
    FROM (SELECT * FROM ({STANDINGS_SQL}) s WHERE league_name = 'EUROPE'
          ORDER BY wins DESC, losses, division_name, team_name LIMIT 1) a
    UNION ALL SELECT 'Total Teams', count(*)::VARCHAR, 'franchises' FROM customer
    UNION ALL SELECT 'Season', '2026', 'current season'""")
def standings_summary(spark, folder):
    """League leaders, number of teams, season."""
    ranked = marts.mart_standings(standings(spark, folder))
    return summaries.standings_summary(ranked, {"AL Leader": "AMERICA", "NL Leader": "EUROPE"})


_TOP = "(SELECT * FROM p ORDER BY {metric} DESC, ops DESC, player_id LIMIT 1)"
_PITCH = "(SELECT * FROM q WHERE {where} ORDER BY {metric}, role, era, player_id LIMIT 1)"


@case(f"""
    WITH p AS ({PLAYERS_SQL}), q AS ({PITCHERS_SQL})
    SELECT 'AVG Leader' AS figure, player_name AS headline, 'AVG ' || printf('%.3f', batting_avg) AS detail
    FROM {_TOP.format(metric='batting_avg')} a
    UNION ALL SELECT 'HR Leader', player_name, home_runs || ' HR' FROM {_TOP.format(metric='home_runs')} a
    UNION ALL SELECT 'OPS Leader', player_name, 'OPS ' || printf('%.3f', ops) FROM {_TOP.format(metric='ops')} a
    UNION ALL SELECT 'ERA Leader', player_name, 'ERA ' || printf('%.2f', era)
    FROM {_PITCH.format(metric='era', where="role = 'Starter'")} a
    UNION ALL SELECT 'K Leader', player_name, strikeouts || ' K'
    FROM {_PITCH.format(metric='strikeouts DESC', where='true')} a
    UNION ALL SELECT 'Win Leader', player_name, wins || ' W'
    FROM {_PITCH.format(metric='wins DESC', where="role = 'Starter'")} a
    UNION ALL SELECT 'Save Leader', player_name, saves || ' SV'
    FROM {_PITCH.format(metric='saves DESC', where="role = 'Reliever'")} a""")
def category_leaders(spark, folder):
    """Batting and pitching leaders, each set from one pass."""
    batting = summaries.batting_summary(players(spark, folder))
    return batting.unionByName(summaries.pitching_summary(_leaders(spark, folder)))


@case(f"""
    SELECT 'OPS' AS board, player_id, player_name, ops AS value
    FROM (SELECT * FROM ({PLAYERS_SQL}) p ORDER BY ops DESC, player_id LIMIT 15) a
    UNION ALL
    SELECT 'ERA', player_id, player_name, era
    FROM (SELECT * FROM ({PITCHERS_SQL}) q WHERE role = 'Starter' ORDER BY era, player_id LIMIT 15) b""")
def top_n_by_metric(spark, folder):
    """Fifteen best batters by OPS and starters by ERA."""

    def board(df, name, metric):
        return df.select(
            F.lit(name).alias("board"), "player_id", "player_name",
            F.col(metric).cast("double").alias("value"),
        )

    batters = board(summaries.top_batters(players(spark, folder)), "OPS", "ops")
    return batters.unionByName(board(summaries.top_starters(_leaders(spark, folder)), "ERA", "era"))


@case(f"""
    SELECT winning_team AS team, count(*) AS wins FROM ({RESULTS_SQL}) r GROUP BY winning_team""")
def wins_by_team(spark, folder):
    """How often each name won."""
    return summaries.wins_by_team(marts.mart_game_results(games(spark, folder)))


@case(f"""
    SELECT count(*) AS games, round(avg(home_score + away_score), 6) AS avg_runs,
           max(run_differential) AS biggest,
           (SELECT winning_team FROM ({RESULTS_SQL}) a ORDER BY run_differential DESC, game_date DESC, game_pk LIMIT 1)
               AS biggest_winner,
           min(run_differential) AS closest,
           (SELECT winning_team FROM ({RESULTS_SQL}) a ORDER BY run_differential, game_date DESC, game_pk LIMIT 1)
               AS closest_winner
    FROM ({RESULTS_SQL}) r""")
def game_summary(spark, folder):
    """Games, mean runs, widest and closest margin with their winners."""
    totals = summaries.game_totals(marts.mart_game_results(games(spark, folder)))
    return totals.withColumn("avg_runs", F.round("avg_runs", 6))


@case(f"""
    SELECT strftime(game_date, '%Y-%m-%d') AS game_date, away_team_name, home_team_name,
           away_score || ' – ' || home_score AS score, winning_team, run_differential, venue_name
    FROM ({RESULTS_SQL}) r""")
def game_log(spark, folder):
    """Results with day and score text."""
    return summaries.game_log(marts.mart_game_results(games(spark, folder)))


@case("""
    SELECT l_orderkey AS game_pk, count(*) AS plays FROM lineitem GROUP BY l_orderkey
    UNION ALL SELECT NULL, count(*) FROM lineitem""")
def plays_per_game(spark, folder):
    """Plays of each game and in total."""
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "game_pk")
    return summaries.plays_per_game(lines)


@case("""
    SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND o_orderdate = (
        SELECT max(o_orderdate) FROM orders WHERE o_orderstatus IN ('F', 'O')
          AND o_orderdate BETWEEN TIMESTAMP '1998-08-08' - INTERVAL 7 DAY AND TIMESTAMP '1998-08-08')""")
def lookback_latest_day(spark, folder):
    """Finished or live games of the newest day within a week that has any."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return latest_day_with(
        orders,
        "o_orderdate",
        F.col("o_orderstatus").isin("F", "O"),
        F.lit("1998-08-08").cast("date"),
    ).select(*orders.columns)


# ---- history --------------------------------------------------------------------------

_LINE_SQL = """count(*) AS plate_appearances,
    count(*) FILTER (event_type NOT IN ('Walk')) AS at_bats,
    count(*) FILTER (event_type IN ('Single', 'Double', 'Triple', 'Home Run')) AS hits,
    count(*) FILTER (event_type = 'Home Run') AS home_runs,
    count(*) FILTER (event_type = 'Walk') AS walks,
    count(*) FILTER (event_type = 'Strikeout') AS strikeouts,
    sum(coalesce(rbi, 0))::BIGINT AS rbi"""


@case(f"""
    SELECT pitcher_id, batter_id, {_LINE_SQL}, max(pitcher_name) AS pitcher_name, max(batter_name) AS batter_name,
           round(CASE WHEN at_bats > 0 THEN hits / at_bats END, 6) AS batting_avg
    FROM ({PLAYS_SQL}) e GROUP BY pitcher_id, batter_id""")
def pair_matchup_stats(spark, folder):
    """Every batter against every pitcher they met."""
    pairs = history.pitcher_matchups(staging.stg_game_events(raw_plays(spark, folder)))
    return pairs.withColumn("batting_avg", F.round("batting_avg", 6))


@case(f"""
    SELECT batter_id, {_LINE_SQL}, max(batter_name) AS batter_name,
           round(CASE WHEN at_bats > 0 THEN hits / at_bats END, 6) AS batting_avg
    FROM ({PLAYS_SQL}) e GROUP BY batter_id""")
def event_rollup(spark, folder):
    """Batting lines counted from plays."""
    lines = history.batting_from_plays(staging.stg_game_events(raw_plays(spark, folder)))
    return lines.withColumn("batting_avg", F.round("batting_avg", 6))


@case(f"""
    SELECT batter_id, strftime(day, '%Y-%m-%d') AS day, plate_appearances, at_bats, hits, home_runs, walks,
           strikeouts, rbi, round((sum(hits) OVER w) / nullif(sum(at_bats) OVER w, 0), 6) AS avg_to_date,
           sum(hits) OVER w::BIGINT AS hits_to_date, sum(at_bats) OVER w::BIGINT AS at_bats_to_date
    FROM (SELECT batter_id, date_trunc('day', start_time) AS day, {_LINE_SQL}
          FROM ({PLAYS_SQL}) e GROUP BY batter_id, date_trunc('day', start_time)) d
    WINDOW w AS (PARTITION BY batter_id ORDER BY day)""".replace(
    "sum(hits) OVER w::BIGINT", "(sum(hits) OVER w)::BIGINT"
).replace("sum(at_bats) OVER w::BIGINT", "(sum(at_bats) OVER w)::BIGINT"))
def trend_cumulative(spark, folder):
    """A batter's days with totals to date."""
    trend = history.performance_over_time(staging.stg_game_events(raw_plays(spark, folder)))
    return trend.withColumns(
        {"day": F.date_format("day", "yyyy-MM-dd"), "avg_to_date": F.round("avg_to_date", 6)}
    )


@case(f"""
    SELECT team, strftime(day, '%Y-%m-%d') AS day, wins, losses,
           (sum(wins) OVER w)::BIGINT AS wins_to_date, (sum(losses) OVER w)::BIGINT AS losses_to_date,
           round((sum(wins) OVER w) / (sum(wins + losses) OVER w), 6) AS win_pct_to_date
    FROM (SELECT team, day, sum(won)::BIGINT AS wins, sum(1 - won)::BIGINT AS losses
          FROM (SELECT winning_team AS team, date_trunc('day', game_date) AS day, 1 AS won
                FROM ({RESULTS_SQL}) r WHERE winning_team <> 'Tie'
                UNION ALL SELECT losing_team, date_trunc('day', game_date), 0
                FROM ({RESULTS_SQL}) r WHERE winning_team <> 'Tie') u GROUP BY team, day) d
    WINDOW w AS (PARTITION BY team ORDER BY day)""")
def team_trend(spark, folder):
    """Wins and losses of each team to date."""
    trend = history.team_trend(marts.mart_game_results(games(spark, folder)))
    return trend.withColumns(
        {
            "day": F.date_format("day", "yyyy-MM-dd"),
            "win_pct_to_date": F.round("win_pct_to_date", 6),
        }
    )
