"""Star-schema tables in the roles of the season tables, and the same as SQL.

Each role is a function giving a DataFrame and a SQL text of the same rows, written
independently of each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .registry import table

ROSTER = 15
PARKS = {"AFRICA": 1.35, "ASIA": 0.83, "EUROPE": 1.10}
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def share(part: Column, whole: Column) -> Column:
    """Quotient to three places, NULL for an empty whole."""
    return F.round(F.try_divide(part, whole), 3).cast("decimal(5,3)")


# ---- teams and standings ------------------------------------------------------------


def standings(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as teams: orders with status F won, with status O lost."""
    status = F.col("o_orderstatus")
    record = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count_if(status == "F").alias("w"),
            F.count_if(status == "O").alias("l"),
            F.count("*").alias("g"),
        )
    )
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    teams = (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(record, F.col("c_custkey") == F.col("o_custkey"), "left")
    )
    wins, losses = F.coalesce("w", F.lit(0)), F.coalesce("l", F.lit(0))
    return teams.select(
        F.col("c_custkey").alias("team_id"),
        F.col("c_name").alias("team_name"),
        F.col("n_name").alias("division_name"),
        F.col("r_name").alias("league_name"),
        wins.alias("wins"),
        losses.alias("losses"),
        share(wins, wins + losses).alias("win_pct"),
        F.coalesce("g", F.lit(0)).alias("games_played"),
        F.lit(2026).alias("season"),
    )


STANDINGS_SQL = """
    SELECT c_custkey AS team_id, c_name AS team_name, n_name AS division_name,
           r_name AS league_name, w AS wins, l AS losses,
           CASE WHEN w + l > 0 THEN round(w / (w + l), 3) END AS win_pct, g AS games_played
    FROM (SELECT c_custkey, c_name, c_nationkey,
                 count(o_orderkey) FILTER (o_orderstatus = 'F') AS w,
                 count(o_orderkey) FILTER (o_orderstatus = 'O') AS l,
                 count(o_orderkey) AS g
          FROM customer LEFT JOIN orders ON c_custkey = o_custkey
          GROUP BY ALL) t
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
"""


# ---- batters and pitchers -------------------------------------------------------------


def players(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with orders as batters; teams are rosters of fifteen neighbouring ids."""
    status, level = F.col("o_orderstatus"), F.col("o_orderpriority")
    lines = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count("*").alias("games"),
            F.count_if(status == "F").alias("hits"),
            F.count_if(status == "O").alias("walks"),
            F.count_if(status == "P").alias("strikeouts"),
            F.count_if(level == "1-URGENT").alias("home_runs"),
            F.count_if(level == "2-HIGH").alias("doubles"),
            F.count_if(level == "3-MEDIUM").alias("triples"),
            F.count_if(level == "4-NOT SPECIFIED").alias("rbi"),
            F.count_if(level == "5-LOW").alias("stolen_bases"),
        )
    )
    named = table(spark, folder, "customer").join(lines, F.col("c_custkey") == F.col("o_custkey"))
    at_bats, trips = F.col("games") * 3, F.col("games") * 4
    team = F.floor(F.col("c_custkey") / ROSTER).cast("bigint")
    return named.select(
        F.col("c_custkey").alias("player_id"),
        F.col("c_name").alias("player_name"),
        team.alias("team_id"),
        F.concat(F.lit("TEAM_"), team.cast("string")).alias("team_name"),
        "games",
        at_bats.alias("at_bats"),
        trips.alias("plate_appearances"),
        "hits", "doubles", "triples", "home_runs", "rbi", "walks", "strikeouts", "stolen_bases",
        share(F.col("hits"), at_bats).alias("batting_avg"),
        share(F.col("hits") + F.col("walks"), trips).alias("obp"),
        share(F.col("hits") + 3 * F.col("home_runs"), at_bats).alias("slg"),
        share(2 * F.col("hits") + F.col("walks") + 3 * F.col("home_runs"), trips).alias("ops"),
        F.lit(2026).alias("season"),
    )


PLAYERS_SQL = f"""
    SELECT c_custkey AS player_id, c_name AS player_name, c_custkey // {ROSTER} AS team_id,
           'TEAM_' || (c_custkey // {ROSTER}) AS team_name,
           games, games * 3 AS at_bats, games * 4 AS plate_appearances, hits, doubles, triples,
           home_runs, rbi, walks, strikeouts, stolen_bases,
           round(hits / (games * 3), 3) AS batting_avg,
           round((hits + walks) / (games * 4), 3) AS obp,
           round((hits + 3 * home_runs) / (games * 3), 3) AS slg,
           round((2 * hits + walks + 3 * home_runs) / (games * 4), 3) AS ops
    FROM customer JOIN (
        SELECT o_custkey, count(*) AS games,
               count(*) FILTER (o_orderstatus = 'F') AS hits,
               count(*) FILTER (o_orderstatus = 'O') AS walks,
               count(*) FILTER (o_orderstatus = 'P') AS strikeouts,
               count(*) FILTER (o_orderpriority = '1-URGENT') AS home_runs,
               count(*) FILTER (o_orderpriority = '2-HIGH') AS doubles,
               count(*) FILTER (o_orderpriority = '3-MEDIUM') AS triples,
               count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS rbi,
               count(*) FILTER (o_orderpriority = '5-LOW') AS stolen_bases
        FROM orders GROUP BY o_custkey) s ON c_custkey = o_custkey
"""


def pitchers(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with lines as pitchers; lines of 26 and more pieces are starts."""
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.count("*").alias("games"),
            F.count_if(quantity >= 26).alias("games_started"),
            F.count_if(flag == "A").alias("wins"),
            F.count_if(flag == "N").alias("losses"),
            F.count_if(quantity == 50).alias("saves"),
            F.count_if(F.col("l_linestatus") == "O").alias("strikeouts"),
            F.count_if(F.col("l_linestatus") == "F").alias("walks_allowed"),
            F.count_if((flag == "R") & (quantity >= 45)).alias("home_runs_allowed"),
        )
    )
    named = table(spark, folder, "supplier").join(lines, F.col("s_suppkey") == F.col("l_suppkey"))
    games = F.col("games")
    return named.select(
        F.col("s_suppkey").alias("player_id"),
        F.col("s_name").alias("player_name"),
        "games", "games_started", "wins", "losses", "saves", "strikeouts", "walks_allowed",
        "home_runs_allowed",
        F.concat(
            F.floor(games / 3).cast("string"), F.lit("."), (games % 3).cast("string")
        ).alias("innings_pitched"),
        (F.floor(F.col("home_runs_allowed") * 900 / games) / 100).cast("decimal(6,2)").alias("era"),
    )


PITCHERS_SQL = """
    SELECT s_suppkey AS player_id, s_name AS player_name, games, games_started, wins, losses,
           saves, strikeouts, walks_allowed, home_runs_allowed,
           (games // 3) || '.' || (games % 3) AS innings_pitched,
           games // 3 + (games % 3) / 3 AS innings,
           (home_runs_allowed * 900 // games) / 100 AS era,
           CASE WHEN games_started / games >= 0.5 THEN 'Starter' ELSE 'Reliever' END AS role
    FROM supplier JOIN (
        SELECT l_suppkey, count(*) AS games,
               count(*) FILTER (l_quantity >= 26) AS games_started,
               count(*) FILTER (l_returnflag = 'A') AS wins,
               count(*) FILTER (l_returnflag = 'N') AS losses,
               count(*) FILTER (l_quantity = 50) AS saves,
               count(*) FILTER (l_linestatus = 'O') AS strikeouts,
               count(*) FILTER (l_linestatus = 'F') AS walks_allowed,
               count(*) FILTER (l_returnflag = 'R' AND l_quantity >= 45) AS home_runs_allowed
        FROM lineitem GROUP BY l_suppkey) s ON s_suppkey = l_suppkey
"""


def matchups(spark: SparkSession, folder: str) -> DataFrame:
    """Every pending order as a matchup of the customer's roster against some pitcher."""
    homes = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "n_name", "r_name")
    )
    pending = table(spark, folder, "orders").filter("o_orderstatus = 'P'")
    placed = pending.join(homes, F.col("o_custkey") == F.col("c_custkey"))
    team = F.floor(F.col("o_custkey") / ROSTER).cast("bigint")
    return placed.select(
        F.col("o_orderkey").alias("game_pk"),
        F.col("r_name").alias("venue"),
        F.concat(F.lit("TEAM_"), team.cast("string"), F.lit(" @ "), F.col("n_name")).alias("matchup"),
        team.alias("batting_team_id"),
        ((F.col("o_orderkey") * 7) % (F.col("o_custkey") + 50)).alias("pitcher_id"),
        F.lit("TBD").alias("pitcher_name"),
    )


MATCHUPS_SQL = f"""
    SELECT o_orderkey AS game_pk, r_name AS venue,
           'TEAM_' || (o_custkey // {ROSTER}) || ' @ ' || n_name AS matchup,
           o_custkey // {ROSTER} AS batting_team_id,
           (o_orderkey * 7) % (o_custkey + 50) AS pitcher_id
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE o_orderstatus = 'P'
"""

LEADERBOARD_SQL = f"""
    WITH p AS ({PLAYERS_SQL}), q AS ({PITCHERS_SQL}), m AS ({MATCHUPS_SQL}),
    r AS (SELECT *, home_runs_allowed / (innings * 4.3::DOUBLE) AS rate FROM q WHERE role = 'Starter'),
    s AS (
        SELECT p.player_name AS batter_name, p.team_name AS team,
               coalesce(r.player_name, 'TBD') AS pitcher, matchup, venue,
               CASE venue WHEN 'AFRICA' THEN 1.35::DOUBLE WHEN 'ASIA' THEN 0.83::DOUBLE
                          WHEN 'EUROPE' THEN 1.10::DOUBLE ELSE 1.0::DOUBLE END AS park_factor,
               (home_runs + 0.034::DOUBLE * 200) / (plate_appearances + 200) AS batter_rate,
               coalesce(rate, 0.034::DOUBLE) AS pitcher_rate,
               home_runs AS season_hr, plate_appearances AS season_pa, batting_avg, ops, game_pk
        FROM m JOIN p ON batting_team_id = team_id AND plate_appearances >= 20
        LEFT JOIN r ON pitcher_id = r.player_id),
    t AS (SELECT *, least(batter_rate * pitcher_rate / 0.034::DOUBLE * park_factor, 0.25) AS prob FROM s)
    SELECT batter_name, team, pitcher, matchup, venue, park_factor,
           round(prob, 4) AS hr_prob, printf('%.1f%%', round(prob * 100, 1)) AS hr_prob_pct,
           season_hr, season_pa, batting_avg, ops, game_pk
    FROM t
"""


# ---- games and plays -------------------------------------------------------------------


def games(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as games: pieces of flag A score for the home side, of flag R for the away side."""
    quantity, flag = F.col("l_quantity"), F.col("l_returnflag")
    scores = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(F.when(flag == "A", quantity)).cast("bigint").alias("home_score"),
            F.sum(F.when(flag == "R", quantity)).cast("bigint").alias("away_score"),
        )
    )
    status = F.col("o_orderstatus")
    played = table(spark, folder, "orders").join(
        scores, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    return played.select(
        F.col("o_orderkey").alias("game_pk"),
        F.col("o_orderdate").alias("game_date"),
        F.when(status == "F", "Final").when(status == "O", "In Progress").otherwise("Scheduled").alias("game_status"),
        F.concat(F.lit("home_"), F.col("o_custkey").cast("string")).alias("home_team_name"),
        F.concat(F.lit("away_"), F.col("o_orderkey").cast("string")).alias("away_team_name"),
        "home_score",
        "away_score",
        F.col("o_orderpriority").alias("venue_name"),
    )


RESULTS_SQL = """
    SELECT *, CASE WHEN home_score > away_score THEN home_team_name
                   WHEN away_score > home_score THEN away_team_name ELSE 'Tie' END AS winning_team,
           CASE WHEN home_score > away_score THEN away_team_name
                WHEN away_score > home_score THEN home_team_name ELSE 'Tie' END AS losing_team,
           abs(home_score - away_score) AS run_differential
    FROM (SELECT o_orderkey AS game_pk, o_orderdate AS game_date, 'Final' AS game_status,
                 'home_' || o_custkey AS home_team_name, 'away_' || o_orderkey AS away_team_name,
                 sum(l_quantity) FILTER (l_returnflag = 'A')::BIGINT AS home_score,
                 sum(l_quantity) FILTER (l_returnflag = 'R')::BIGINT AS away_score,
                 o_orderpriority AS venue_name
          FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'
          GROUP BY ALL) g
    WHERE home_score IS NOT NULL AND away_score IS NOT NULL
"""


def play_result() -> Column:
    """A play result by number of pieces."""
    quantity = F.col("l_quantity")
    return (
        F.when(quantity >= 48, "Home Run")
        .when(quantity >= 45, "Triple")
        .when(quantity >= 40, "Double")
        .when(quantity >= 30, "Single")
        .when(quantity >= 25, "Walk")
        .when(quantity >= 15, "Strikeout")
        .otherwise("Groundout")
    )


PLAY_RESULT_SQL = """CASE WHEN l_quantity >= 48 THEN 'Home Run' WHEN l_quantity >= 45 THEN 'Triple'
    WHEN l_quantity >= 40 THEN 'Double' WHEN l_quantity >= 30 THEN 'Single'
    WHEN l_quantity >= 25 THEN 'Walk' WHEN l_quantity >= 15 THEN 'Strikeout' ELSE 'Groundout' END"""


def raw_plays(spark: SparkSession, folder: str) -> DataFrame:
    """The lineitem table as landed plays."""
    return as_raw_plays(table(spark, folder, "lineitem"))


def as_raw_plays(lines: DataFrame) -> DataFrame:
    """Lineitems as landed plays: repeats of a key, text times, some keys missing."""
    quantity = F.col("l_quantity")
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    start = F.col("l_shipdate").cast("timestamp")
    no_key = (F.col("l_returnflag") == "A") & (quantity == 13)
    return lines.select(
        F.col("l_orderkey").cast("double").alias("game_pk"),
        F.when(~no_key, F.col("l_linenumber").cast("double")).alias("at_bat_index"),
        F.ceil(quantity / 6).cast("double").alias("inning"),
        F.when(F.col("l_linestatus") == "F", "top").otherwise("bottom").alias("half_inning"),
        F.date_format(start, iso).alias("start_time"),
        F.date_format(
            F.timestamp_seconds(F.unix_seconds(start) + quantity.cast("bigint") * 60), iso
        ).alias("end_time"),
        (F.col("l_returnflag") != "N").alias("is_complete"),
        (F.col("l_discount") > 0.05).alias("is_scoring"),
        play_result().alias("event_type"),
        F.lit(None).cast("string").alias("description"),
        F.when(F.col("l_tax") > 0.02, F.floor(F.col("l_tax") * 100 + 0.5).cast("double")).alias("rbi"),
        F.lit(float("nan")).alias("home_score"),
        quantity.alias("away_score"),
        F.col("l_partkey").cast("double").alias("batter_id"),
        F.concat(F.lit("batter_"), F.col("l_partkey").cast("string")).alias("batter_name"),
        F.col("l_suppkey").cast("double").alias("pitcher_id"),
        F.concat(F.lit("pitcher_"), F.col("l_suppkey").cast("string")).alias("pitcher_name"),
    )


TYPED_PLAYS_SQL = f"""
    SELECT l_orderkey || '_' || l_linenumber AS event_id, l_orderkey AS game_pk,
           l_linenumber AS at_bat_index, ceil(l_quantity / 6)::INT AS inning,
           CASE l_linestatus WHEN 'F' THEN 'top' ELSE 'bottom' END AS half_inning,
           l_shipdate AS start_time, l_shipdate + to_minutes(l_quantity::BIGINT) AS end_time,
           true AS is_complete, l_discount > 0.05 AS is_scoring_play,
           {PLAY_RESULT_SQL} AS event_type, CAST(NULL AS VARCHAR) AS description,
           CASE WHEN l_tax > 0.02 THEN floor(l_tax * 100 + 0.5)::INT END AS rbi,
           CAST(NULL AS INT) AS home_score, l_quantity::INT AS away_score,
           l_partkey::INT AS batter_id, 'batter_' || l_partkey AS batter_name,
           l_suppkey::INT AS pitcher_id, 'pitcher_' || l_suppkey AS pitcher_name
    FROM lineitem
    WHERE l_returnflag <> 'N' AND NOT (l_returnflag = 'A' AND l_quantity = 13)
"""

PLAYS_SQL = f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY end_time DESC, inning,
            half_inning, start_time, is_scoring_play, event_type, rbi, away_score, batter_id,
            pitcher_id) AS rn
        FROM ({TYPED_PLAYS_SQL}) t) u WHERE rn = 1
"""
