"""Column helpers: parsing, rates, lookups, display text, plain scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parse, rates, text
from ..functions.lookups import label_or_code, park_factor
from ..plans.predictions import pitcher_rates
from ..plans.staging import stg_standings, stg_teams
from ..sources.tables import qualified, run_query
from .registry import case, table
from .roles import PARKS, PITCHERS_SQL, PLAYERS_SQL, pitchers, players, standings


@case("""
    SELECT o_orderkey AS order_id, o_custkey::INT AS customer_id, o_orderdate AS placed_at,
           o_totalprice AS total, 2026 AS season
    FROM orders""")
def typed_projection(spark, folder):
    """Text and float copies of the columns, cast back to their types; season tag."""
    landed = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("double").alias("id"),
        F.col("o_custkey").cast("string").alias("customer"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("placed"),
        F.col("o_totalprice").cast("string").alias("total"),
    )
    return landed.select(
        parse.whole("id", "bigint").alias("order_id"),
        parse.whole("customer").alias("customer_id"),
        parse.wall_time("placed").alias("placed_at"),
        F.col("total").cast("double").alias("total"),
        F.lit(2026).alias("season"),
    )


@case("""
    SELECT s_suppkey::INT AS team_id, s_name AS team_name, s_nationkey::INT AS division_id,
           n_name AS division_name, r_regionkey::INT AS league_id, r_name AS league_name,
           CASE WHEN s_acctbal >= 0 THEN s_suppkey::INT END AS venue_id, 2026 AS season,
           'S' || s_nationkey AS abbreviation, 'c' || s_suppkey AS team_code, 'at ' || s_name AS venue_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""")
def teams_staging(spark, folder):
    """The team staging model on suppliers, with NaN for a missing venue id."""
    named = (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    number = lambda c: F.col(c).cast("double")
    raw = named.select(
        number("s_suppkey").alias("team_id"),
        F.col("s_name").alias("team_name"),
        F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("abbreviation"),
        F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("team_code"),
        number("s_nationkey").alias("division_id"),
        F.col("n_name").alias("division_name"),
        number("r_regionkey").alias("league_id"),
        F.col("r_name").alias("league_name"),
        F.when(F.col("s_acctbal") < 0, F.lit(float("nan"))).otherwise(number("s_suppkey")).alias("venue_id"),
        F.concat(F.lit("at "), F.col("s_name")).alias("venue_name"),
        F.lit(2026.0).alias("season"),
    )
    return stg_teams(raw)


@case("""
    SELECT c_custkey::INT AS team_id, c_name AS team_name, n_name AS division_name,
           r_name AS league_name, count(o_orderkey) FILTER (o_orderstatus = 'F')::INT AS wins,
           count(o_orderkey) FILTER (o_orderstatus = 'O')::INT AS losses,
           round(CASE WHEN wins + losses > 0 THEN wins / (wins + losses) END, 3)::DECIMAL(4,3) AS win_pct,
           count(o_orderkey)::INT AS games_played, (c_custkey % 25)::INT AS division_id,
           (c_custkey % 5)::INT AS league_id, 'b' || (c_custkey % 7) AS games_back, 2026 AS season
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey LEFT JOIN orders ON c_custkey = o_custkey
    GROUP BY c_custkey, c_name, n_name, r_name""")
def standings_staging(spark, folder):
    """The standings staging model on customers."""
    raw = standings(spark, folder).select(
        F.col("team_id").cast("double").alias("team_id"),
        "team_name",
        (F.col("team_id") % 25).cast("double").alias("division_id"),
        F.col("division_name").alias("division"),
        (F.col("team_id") % 5).cast("double").alias("league_id"),
        F.col("league_name").alias("league"),
        F.col("wins").cast("double").alias("wins"),
        F.col("losses").cast("double").alias("losses"),
        F.try_divide(F.col("wins"), F.col("wins") + F.col("losses")).alias("win_pct"),
        F.concat(F.lit("b"), (F.col("team_id") % 7).cast("string")).alias("games_back"),
        F.col("games_played").cast("double").alias("games_played"),
        F.lit(2026.0).alias("season"),
    )
    return stg_standings(raw)


@case("""
    SELECT c_custkey, CASE WHEN w + l = 0 THEN NULL ELSE (w * 1000 // (w + l)) / 1000 END AS from_text,
           CASE WHEN w + l > 0 THEN round(w / (w + l), 3) END AS from_number
    FROM (SELECT c_custkey, count(o_orderkey) FILTER (o_orderstatus = 'F') AS w,
                 count(o_orderkey) FILTER (o_orderstatus = 'O') AS l
          FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey) t""")
def decimal_rate(spark, folder):
    """Share of wins from feed text (``.667``, ``1.000``, ``.---``) and from a number."""
    wins, played = F.col("wins"), F.col("wins") + F.col("losses")
    thousandths = F.floor(F.try_divide(wins * 1000, played))
    shown = (
        F.when(played == 0, ".---")
        .when(thousandths == 1000, "1.000")
        .otherwise(F.concat(F.lit("."), F.lpad(thousandths.cast("string"), 3, "0")))
    )
    return standings(spark, folder).select(
        F.col("team_id").alias("c_custkey"),
        parse.win_share(shown).cast("double").alias("from_text"),
        F.try_divide(wins, played).cast("decimal(4,3)").cast("double").alias("from_number"),
    )


@case("""
    SELECT c_custkey, CASE n_regionkey WHEN 0 THEN 'South' WHEN 2 THEN 'East' WHEN 3 THEN 'North'
                      ELSE n_regionkey::VARCHAR END AS region_label,
           CASE r_name WHEN 'AFRICA' THEN 1.35 WHEN 'ASIA' THEN 0.83 WHEN 'EUROPE' THEN 1.10
                       ELSE 1.0 END::DOUBLE AS factor,
           CASE c_mktsegment WHEN 'BUILDING' THEN 'TBD' ELSE c_mktsegment END AS segment
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""")
def code_lookup_default(spark, folder):
    """Code to label or code text; name to factor or 1.0; missing value to default."""
    named = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return named.select(
        "c_custkey",
        label_or_code(F.col("n_regionkey"), {0: "South", 2: "East", 3: "North"}).alias("region_label"),
        park_factor(F.col("r_name"), PARKS).alias("factor"),
        parse.or_default(segment, "TBD").alias("segment"),
    )


@case("""
    SELECT l_orderkey, l_linenumber, v AS shown,
           CASE WHEN regexp_full_match(v, '[0-9.]+') THEN TRY_CAST(v AS DECIMAL(5,3)) END::DOUBLE AS rate,
           CASE WHEN regexp_full_match(v, '[0-9.]+') THEN TRY_CAST(v AS DECIMAL(6,2)) END::DOUBLE AS era
    FROM (SELECT *, CASE l_linenumber WHEN 1 THEN '-.--' WHEN 2 THEN '.' WHEN 3 THEN '1.2.3'
                    WHEN 4 THEN '100.0' WHEN 5 THEN '-' || l_quantity WHEN 6 THEN l_tax::VARCHAR
                    ELSE l_quantity::VARCHAR END AS v FROM lineitem) t""")
def guarded_numeric_parse(spark, folder):
    """Digits-and-dots text as decimals of two widths, everything else NULL."""
    number = F.col("l_linenumber")
    shown = (
        F.when(number == 1, "-.--").when(number == 2, ".").when(number == 3, "1.2.3")
        .when(number == 4, "100.0")
        .when(number == 5, F.concat(F.lit("-"), F.col("l_quantity").cast("string")))
        .when(number == 6, F.col("l_tax").cast("string"))
        .otherwise(F.col("l_quantity").cast("string"))
    )
    lines = table(spark, folder, "lineitem").withColumn("shown", shown)
    return lines.select(
        "l_orderkey", "l_linenumber", "shown",
        parse.guarded_decimal("shown", 5, 3).cast("double").alias("rate"),
        parse.guarded_decimal("shown", 6, 2).cast("double").alias("era"),
    )


@case("""
    SELECT l_orderkey, l_shipdate,
           CASE WHEN l_returnflag = 'N' AND l_quantity = 13 THEN NULL
                ELSE l_orderkey || '_' || l_linenumber END AS event_id
    FROM lineitem""")
def composite_key(spark, folder):
    """Joined key that is NULL where a part is missing."""
    absent = (F.col("l_returnflag") == "N") & (F.col("l_quantity") == 13)
    number = F.when(~absent, F.col("l_linenumber"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_shipdate", parse.composite_key("l_orderkey", number).alias("event_id")
    )


@case("""
    SELECT l_orderkey, l_linenumber, l_quantity::INT AS pieces,
           round(CASE l_linenumber WHEN 1 THEN l_quantity + 1 / 3 WHEN 2 THEN l_quantity + 2 / 3
                 WHEN 3 THEN l_quantity WHEN 6 THEN l_quantity + 5 / 3 ELSE 0 END, 6) AS innings
    FROM lineitem""")
def innings_parse(spark, folder):
    """Thirds notation, whole numbers and unreadable text."""
    whole = F.col("l_quantity").cast("int").cast("string")
    number = F.col("l_linenumber")
    shown = (
        F.when(number == 1, F.concat(whole, F.lit(".1")))
        .when(number == 2, F.concat(whole, F.lit(".2")))
        .when(number == 3, whole)
        .when(number == 4, F.concat(whole, F.lit(".")))
        .when(number == 5, ".1")
        .when(number == 6, F.concat(whole, F.lit(".5.9")))
        .otherwise("x")
    )
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("pieces"),
        F.round(parse.innings(shown), 6).alias("innings"),
    )


@case(f"""
    SELECT player_id, role, CASE role WHEN 'Starter'
           THEN round(CASE WHEN innings = 0 THEN 0.034 ELSE home_runs_allowed / (innings * 4.3) END, 6) END
           AS hr_rate,
           round(CASE WHEN saves = 0 THEN 0.034 ELSE home_runs_allowed / saves END, 6) AS per_save
    FROM ({PITCHERS_SQL}) q""")
def rate_with_fallback(spark, folder):
    """Home runs per batter faced, and a quotient whose denominator is zero for some."""
    roled = pitchers(spark, folder).withColumn(
        "role", rates.role(F.col("games"), F.col("games_started"))
    )
    starters = pitcher_rates(roled)
    return roled.join(starters, F.col("player_id") == F.col("starter_id"), "left").select(
        "player_id",
        "role",
        F.round("pitcher_rate", 6).alias("hr_rate"),
        F.round(rates.rate_or(F.col("home_runs_allowed"), F.col("saves"), 0.034), 6).alias("per_save"),
    )


@case(f"""
    SELECT player_id, round((home_runs + 0.034 * 200) / (plate_appearances + 200), 6) AS hr_rate
    FROM ({PLAYERS_SQL}) p""")
def shrunk_rate(spark, folder):
    """Home-run rate pulled towards the league's."""
    return players(spark, folder).select(
        "player_id",
        F.round(
            rates.shrunk_rate(
                F.col("home_runs"), F.col("plate_appearances"), rates.LEAGUE_HR_RATE,
                rates.REGRESSION_PLATE_APPEARANCES,
            ),
            6,
        ).alias("hr_rate"),
    )


@case("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
           printf('%.1f%%', 100 * (o_custkey % 997) / 1000.0) AS share,
           printf('%.2f', o_totalprice) AS price,
           CASE o_orderstatus WHEN 'P' THEN 0 ELSE o_custkey END || ' – ' || o_orderkey AS score,
           o_custkey || '-' || o_orderkey AS record,
           o_custkey || ' runs' AS margin,
           split_part(o_orderpriority, '-', 2) || ' @ ' || o_orderstatus || ' [' || o_orderpriority || ']'
               AS matchup,
           CASE WHEN contains(o_orderpriority, ' ') THEN split_part(o_orderpriority, ' ', 2)
                ELSE o_orderpriority END AS last_word
    FROM orders""")
def display_strings(spark, folder):
    """Every display text helper."""
    customer, key = F.col("o_custkey"), F.col("o_orderkey")
    level = F.col("o_orderpriority")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        text.day(F.col("o_orderdate")).alias("day"),
        text.percent((customer % 997) / 1000).alias("share"),
        text.fixed(F.col("o_totalprice"), 2).alias("price"),
        text.score(F.when(F.col("o_orderstatus") != "P", customer), key).alias("score"),
        text.record(customer, key).alias("record"),
        text.with_unit(customer, "runs").alias("margin"),
        text.matchup(F.split_part(level, F.lit("-"), F.lit(2)), F.col("o_orderstatus"), level).alias("matchup"),
        text.last_word(level).alias("last_word"),
    )


@case("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice >= 250000""")
def param_scan(spark, folder):
    """Projection and threshold, both pushed into the scan."""
    return qualified(
        table(spark, folder, "orders"), "o_totalprice", 250000.0,
        ["o_orderkey", "o_custkey", "o_totalprice"],
    )


@case("""
    SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS top FROM orders
    WHERE o_totalprice >= 250000 GROUP BY o_orderstatus""")
def param_sql(spark, folder):
    """Ad-hoc SQL with a named parameter."""
    table(spark, folder, "orders").createOrReplaceTempView("standin_orders")
    return run_query(
        spark,
        """SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS top FROM standin_orders
           WHERE o_totalprice >= :floor GROUP BY o_orderstatus""",
        floor=250000.0,
    )


@case("""
    SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-25' AND TIMESTAMP '1998-09-30'
      AND o_orderstatus IN ('F', 'O')""")
def date_range_scan(spark, folder):
    """Day range and status set, pushed into the scan."""
    day = F.col("o_orderdate")
    first, last = (F.lit(d).cast("timestamp_ntz") for d in ("1996-03-25", "1998-09-30"))
    return (
        table(spark, folder, "orders")
        .filter(day.between(first, last) & F.col("o_orderstatus").isin("F", "O"))
        .select("o_orderkey", "o_orderdate", "o_orderstatus")
    )
