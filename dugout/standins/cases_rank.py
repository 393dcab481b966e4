"""Orders, positions, ranks, filter texts and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.filters import column_filters
from ..operators.ranking import by, nulls_last, rank_within, seek_page, table_page, top_n, with_position
from ..plans import marts
from ..sources import tables
from .registry import case, table
from .roles import (
    PITCHERS_SQL, PLAYERS_SQL, RESULTS_SQL, STANDINGS_SQL, games, pitchers, players, standings,
)


@case("""
    SELECT c_custkey, metric, row_number() OVER (ORDER BY metric DESC NULLS LAST, c_custkey) AS position
    FROM (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS metric FROM customer) t""")
def ordered_read_nulls_last(spark, folder):
    """Reading order with missing values at the end, shown as a position."""
    metric = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    rows = table(spark, folder, "customer").select("c_custkey", metric.alias("metric"))
    return with_position(rows, [nulls_last("metric", desc=True), F.col("c_custkey").asc()])


@case(f"""
    SELECT player_id, role, era, row_number() OVER (ORDER BY CASE role WHEN 'Starter' THEN 1 ELSE 2 END,
           era, player_id) AS position
    FROM ({PITCHERS_SQL}) q""")
def role_order(spark, folder):
    """Starters first, then by ERA, shown as a position."""
    staff = marts.mart_pitching_leaders(pitchers(spark, folder)).select(
        "player_id", "role", F.col("era").cast("double").alias("era")
    )
    first = F.when(F.col("role") == "Starter", 1).otherwise(2)
    return with_position(staff, [first.asc(), nulls_last("era"), F.col("player_id").asc()])


@case("""
    SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS position
    FROM orders""")
def newest_first(spark, folder):
    """Newest games first, shown as a position."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return with_position(rows, [by("o_orderdate", desc=True), F.col("o_orderkey").asc()])


@case(f"""
    SELECT player_id, player_name, ops FROM ({PLAYERS_SQL}) p
    WHERE home_runs >= 1 AND contains(team_name, 'TEAM_')
    ORDER BY ops DESC, player_id LIMIT 20 OFFSET 40""")
def table_page_near(spark, folder):
    """Third page of a filtered, sorted table."""
    rows = players(spark, folder).select(
        "player_id", "player_name", "team_name", "home_runs", F.col("ops").cast("double").alias("ops")
    )
    page = table_page(
        rows, [nulls_last("ops", desc=True), F.col("player_id").asc()], 2, 20,
        [F.col("home_runs") >= 1, F.col("team_name").contains("TEAM_")],
    )
    return page.select("player_id", "player_name", "ops")


@case("""
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 30 OFFSET 3000""")
def table_page_far(spark, folder):
    """A page far down a large table, cut out by position."""
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = table(spark, folder, "lineitem").select(*order)
    page = table_page(rows, [F.col(c).asc() for c in order], 100, 30)
    return page.select("l_orderkey", "l_linenumber", "l_extendedprice")


_LINE = "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"


@case(f"""
    SELECT l_extendedprice, {", ".join(_LINE)} FROM lineitem
    ORDER BY l_extendedprice DESC NULLS LAST, {", ".join(_LINE)} LIMIT 30 OFFSET 36000""")
def table_page_sought(spark, folder):
    """A page far down a large table, sought by counts of a column's ranges."""
    rows = table(spark, folder, "lineitem").select("l_extendedprice", *_LINE)
    return seek_page(rows, [("l_extendedprice", True)], 1200, 30)


@case(f"""
    SELECT metric, l_shipdate, {", ".join(_LINE)}
    FROM (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS metric FROM lineitem) t
    ORDER BY metric NULLS LAST, l_shipdate DESC NULLS LAST, {", ".join(_LINE)} LIMIT 50 OFFSET 45000""")
def table_page_among_ties(spark, folder):
    """A page among rows that share a missing first value and many days."""
    metric = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    rows = table(spark, folder, "lineitem").select(metric.alias("metric"), "l_shipdate", *_LINE)
    return seek_page(rows, [("metric", False), ("l_shipdate", True)], 900, 50)


@case("""
    SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
    WHERE o_totalprice > 150000.5 AND contains(lower(o_orderpriority), 'urgent') AND o_orderstatus <> 'P'
      AND o_custkey <= 1200 AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def table_filter_text(spark, folder):
    """The filter row of a table: one text per column, of every kind."""
    rows = table(spark, folder, "orders")
    texts = {
        "o_totalprice": "> 150000.5", "o_orderpriority": "icontains urgent", "o_orderstatus": "!= P",
        "o_custkey": "lt 1200.5", "o_orderdate": "1997", "o_orderkey": " ",
    }
    for condition in column_filters(rows, texts):
        rows = rows.filter(condition)
    return rows.select("o_orderkey", "o_orderpriority", "o_totalprice")


@case("""
    SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem
    WHERE l_quantity >= 3 AND contains(l_returnflag, 'N') AND l_shipdate >= TIMESTAMP '1996-06-01'
    ORDER BY l_shipdate, l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 25 OFFSET 500""")
def table_filtered_page(spark, folder):
    """A page of a table that is filtered by texts and sorted by two columns."""
    rows = table(spark, folder, "lineitem")
    where = column_filters(rows, {"l_quantity": "ge 3", "l_returnflag": "N", "l_shipdate": ">= 1996-06-01"})
    order = [("l_shipdate", False), ("l_extendedprice", True), *((c, False) for c in _LINE)]
    page = seek_page(rows, order, 20, 25, where)
    return page.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")


@case("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_extendedprice, l_discount,
           rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_discount) AS flag_rank,
           rank() OVER (PARTITION BY l_linestatus ORDER BY l_extendedprice DESC, l_discount) AS status_rank
    FROM lineitem""")
def rank_of_prices(spark, folder):
    """Ranks over a column with nearly as many values as rows, in partitions with a third of them."""
    rows = table(spark, folder, "lineitem").select(*_LINE, "l_returnflag", "l_linestatus", "l_extendedprice", "l_discount")
    ranks = {"flag_rank": ["l_returnflag"], "status_rank": ["l_linestatus"]}
    return rank_within(rows, ranks, [("l_extendedprice", True), ("l_discount", False)])


@case(f"""
    SELECT team_id, row_number() OVER (ORDER BY league_name, division_name, division_rank, team_id) AS position
    FROM (SELECT *, rank() OVER (PARTITION BY division_name ORDER BY wins DESC, losses) AS division_rank
          FROM ({STANDINGS_SQL}) s) r""")
def standings_reading_order(spark, folder):
    """The order of the standings reader, shown as a position."""
    mart = marts.mart_standings(standings(spark, folder)).select("team_id", "league_name", "division_name", "division_rank")
    return with_position(mart, [*tables.standings_order(), F.col("team_id").asc()]).select("team_id", "position")


@case(f"""
    SELECT player_id, row_number() OVER (ORDER BY ops DESC NULLS LAST, player_id) AS position FROM ({PLAYERS_SQL}) p""")
def player_reading_order(spark, folder):
    """The order of the batting reader, shown as a position."""
    mart = players(spark, folder).select("player_id", "ops")
    return with_position(mart, [*tables.player_stats_order(), F.col("player_id").asc()]).select("player_id", "position")


@case(f"""
    SELECT player_id, row_number() OVER (ORDER BY role, era, player_id) AS position FROM ({PITCHERS_SQL}) q""")
def pitcher_reading_order(spark, folder):
    """The order of the pitching reader, shown as a position."""
    mart = marts.mart_pitching_leaders(pitchers(spark, folder)).select("player_id", "role", "era")
    return with_position(mart, [*tables.pitching_leaders_order(), F.col("player_id").asc()]).select("player_id", "position")


@case(f"""
    SELECT game_pk, row_number() OVER (ORDER BY game_date DESC NULLS FIRST, game_pk) AS position FROM ({RESULTS_SQL}) r""")
def result_reading_order(spark, folder):
    """The order of the results reader, shown as a position."""
    mart = marts.mart_game_results(games(spark, folder)).select("game_pk", "game_date")
    return with_position(mart, [*tables.game_results_order(), F.col("game_pk").asc()]).select("game_pk", "position")


@case(f"""
    WITH top AS (SELECT player_id, player_name, home_runs FROM ({PLAYERS_SQL}) p
                 ORDER BY home_runs DESC, ops DESC, player_id LIMIT 15)
    SELECT player_id, row_number() OVER (ORDER BY home_runs, player_id) AS position FROM top""")
def chart_order(spark, folder):
    """The fifteen best, listed from the last to the first as a chart draws them."""
    order = [nulls_last("home_runs", desc=True), nulls_last("ops", desc=True), F.col("player_id").asc()]
    best = top_n(players(spark, folder), order, 15).select("player_id", "home_runs")
    return with_position(best, [F.col("home_runs").asc(), F.col("player_id").asc()]).select("player_id", "position")
