"""Data checks and pipeline series."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import monitor, quality
from ..operators.dedup import latest_run_per
from .registry import case, table

_TABLES = ["region", "nation", "customer", "supplier", "orders", "lineitem"]


def _with_gaps(spark, folder):
    """Orders with some missing values."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("game_pk"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("home_team_id"),
        F.when(F.col("o_totalprice") >= 10000, F.col("o_totalprice")).alias("score"),
        F.col("o_orderdate").alias("game_date"),
    )


_GAPS_SQL = """(SELECT o_orderkey AS game_pk, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS home_team_id,
    CASE WHEN o_totalprice >= 10000 THEN o_totalprice END AS score, o_orderdate AS game_date FROM orders) g"""


@case(f"""
    SELECT 'home_team_id' AS "column", count(*) AS n_rows, count(*) - count(home_team_id) AS n_nulls,
           round((count(*) - count(home_team_id)) * 100.0 / count(*), 6) AS null_pct FROM {_GAPS_SQL}
    UNION ALL
    SELECT 'score', count(*), count(*) - count(score), round((count(*) - count(score)) * 100.0 / count(*), 6)
    FROM {_GAPS_SQL}""")
def null_rate_profile(spark, folder):
    """Columns with missing values and their share."""
    rates = quality.null_rates(
        _with_gaps(spark, folder), ["game_pk", "home_team_id", "score", "game_date"]
    )
    return rates.withColumn("null_pct", F.round("null_pct", 6))


@case(f"""
    SELECT 'orders' AS table_name, 'not_null' AS check_name, c AS column_name, n AS failures,
           CASE n WHEN 0 THEN 'pass' ELSE 'fail' END AS status
    FROM (SELECT 'game_pk' AS c, count(*) - count(game_pk) AS n FROM {_GAPS_SQL}
          UNION ALL SELECT 'home_team_id', count(*) - count(home_team_id) FROM {_GAPS_SQL}
          UNION ALL SELECT 'score', count(*) - count(score) FROM {_GAPS_SQL}) t
    UNION ALL
    SELECT 'lineitem', 'not_null', 'l_orderkey', count(*) - count(l_orderkey),
           CASE WHEN count(*) = count(l_orderkey) THEN 'pass' ELSE 'fail' END FROM lineitem""")
def dq_not_null(spark, folder):
    """Not-null rules over two tables."""
    return quality.contracts(
        {"orders": _with_gaps(spark, folder), "lineitem": table(spark, folder, "lineitem")},
        {
            "orders": {"not_null": ["game_pk", "home_team_id", "score"]},
            "lineitem": {"not_null": ["l_orderkey"]},
        },
    )


@case("""
    SELECT t AS table_name, 'unique' AS check_name, c AS column_name, n AS failures,
           CASE n WHEN 0 THEN 'pass' ELSE 'fail' END AS status
    FROM (SELECT 'orders' AS t, 'o_orderkey' AS c, count(*) AS n
          FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) a
          UNION ALL SELECT 'orders', 'o_custkey', count(*)
          FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1) a
          UNION ALL SELECT 'lineitem', 'event_id', count(*)
          FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1) a) u""")
def dq_unique(spark, folder):
    """Uniqueness rules over two tables."""
    lines = table(spark, folder, "lineitem").select(
        F.concat(
            F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string")
        ).alias("event_id")
    )
    return quality.contracts(
        {"orders": table(spark, folder, "orders"), "lineitem": lines},
        {"orders": {"unique": ["o_orderkey", "o_custkey"]}, "lineitem": {"unique": ["event_id"]}},
    )


@case("""
    SELECT l_orderkey || '_' || l_linenumber AS event_id, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def repeated_event_keys(spark, folder):
    """Keys that occur more than once."""
    lines = table(spark, folder, "lineitem").select(
        F.concat(
            F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string")
        ).alias("event_id")
    )
    return quality.repeated_keys(lines, "event_id")


_MOMENTS = ["2024-01-31 12:00:00", "2024-02-01 12:00:00", "2024-02-03 12:00:00"]


@case("""
    SELECT a AS as_of, newest, round(CASE WHEN newest IS NULL THEN NULL ELSE
               trunc(epoch(a::TIMESTAMP - newest)) / 3600 END, 6) AS age_hours,
           CASE WHEN newest IS NULL OR a::TIMESTAMP - newest > INTERVAL 48 HOUR THEN 'error'
                WHEN a::TIMESTAMP - newest > INTERVAL 24 HOUR THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT max(ts) AS newest FROM events) e,
         (VALUES ('2024-01-31 12:00:00'), ('2024-02-01 12:00:00'), ('2024-02-03 12:00:00')) v(a)
    UNION ALL SELECT 'empty', NULL, NULL, 'error'""")
def dq_freshness(spark, folder):
    """Age of the newest message at three moments, and of an empty table."""
    events = table(spark, folder, "events").select("ts")

    def check(df, label, moment):
        report = quality.freshness(df, "ts", datetime.fromisoformat(moment))
        return report.select(F.lit(label).alias("as_of"), "newest", F.round("age_hours", 6).alias("age_hours"), "status")

    reports = [check(events, m, m) for m in _MOMENTS]
    reports.append(check(events.filter(F.col("ts").isNull()), "empty", _MOMENTS[0]))
    return reduce(DataFrame.unionByName, reports)


_FLOORS = {"region": 5, "nation": 26, "customer": 25, "orders": 50, "lineitem": 50}


@case("""
    SELECT *, CASE WHEN n_rows >= min_rows THEN 'ok' ELSE 'FAIL' END AS status
    FROM (SELECT 'region' AS table_name, count(*) AS n_rows, 5::BIGINT AS min_rows FROM region
          UNION ALL SELECT 'nation', count(*), 26 FROM nation
          UNION ALL SELECT 'customer', count(*), 25 FROM customer
          UNION ALL SELECT 'orders', count(*), 50 FROM orders
          UNION ALL SELECT 'lineitem', count(*), 50 FROM lineitem) t""")
def dq_volume(spark, folder):
    """Row counts against floors, one of them missed."""
    return quality.volume({n: table(spark, folder, n) for n in _FLOORS}, _FLOORS)


@case(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in _TABLES))
def table_row_counts(spark, folder):
    """Rows of each table."""
    return quality.row_counts({n: table(spark, folder, n) for n in _TABLES})


@case("""
    SELECT event_type AS topic, count(*) AS n_messages FROM events GROUP BY event_type
    UNION ALL SELECT 'topics', count(DISTINCT event_type) FROM events""")
def topic_counts(spark, folder):
    """Messages per topic, and the number of topics."""
    events = table(spark, folder, "events").withColumnRenamed("event_type", "topic")
    total = monitor.topic_total(events).select(
        F.lit("topics").alias("topic"), F.col("n_topics").alias("n_messages")
    )
    return monitor.topic_counts(events).unionByName(total)


@case("""
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS n,
           round(count(*) / 300, 6) AS per_second
    FROM events GROUP BY 1, 2""")
def rate_tumbling_5m(spark, folder):
    """Messages per second in five-minute windows."""
    rates = monitor.message_rate(table(spark, folder, "events"), "ts", "event_type")
    return rates.withColumn("per_second", F.round("per_second", 6))


@case("""
    SELECT time_bucket(INTERVAL 1 MINUTE, ts) - to_minutes(k) AS window_start, event_type, count(*) AS n,
           round(count(*) / 300, 6) AS per_second
    FROM events, range(5) r(k) GROUP BY 1, 2""")
def rate_sliding_5m(spark, folder):
    """Messages per second in five-minute windows that start every minute."""
    rates = monitor.message_rate(
        table(spark, folder, "events"), "ts", "event_type", slide=60
    )
    return rates.withColumn("per_second", F.round("per_second", 6))


@case("""
    SELECT event_type, count(*) AS backlog FROM events WHERE ts >= TIMESTAMP '2024-01-20'
    GROUP BY event_type""")
def backlog_by_topic(spark, folder):
    """Landed messages not processed yet."""
    events = table(spark, folder, "events")
    done = events.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return monitor.backlog(events, done, "event_id", "event_type")


_OFFSETS_SQL = """(SELECT event_type AS topic, user_id % 4 AS partition, event_id AS "offset", value, event_id % 3 AS g
    FROM events) m"""


def _group_lag(spark, folder):
    """Three groups, of which each has done low values of its own share of the messages."""
    messages = table(spark, folder, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).alias("partition"),
        F.col("event_id").alias("offset"), "value", (F.col("event_id") % 3).alias("group"),
    )
    return monitor.lag_by_partition(messages, messages.filter(F.col("value") < 5))


_LAG_SQL = f"""
    WITH ends AS (SELECT topic, partition, max("offset") AS e, min("offset") AS b FROM {_OFFSETS_SQL} GROUP BY ALL),
    done AS (SELECT g, topic, partition, max("offset") AS d FROM {_OFFSETS_SQL} WHERE value < 5 GROUP BY ALL),
    lag AS (SELECT t.g AS "group", ends.topic, ends.partition, e - coalesce(d, b - 1) AS behind
            FROM (SELECT DISTINCT g, topic FROM done) t JOIN ends ON t.topic = ends.topic
            LEFT JOIN done ON done.g = t.g AND done.topic = ends.topic AND done.partition = ends.partition)"""


@case(f"{_LAG_SQL} SELECT * FROM lag")
def backlog_by_partition(spark, folder):
    """Messages behind by consumer group, topic and partition."""
    return _group_lag(spark, folder)


@case(f'{_LAG_SQL} SELECT "group", topic, sum(behind)::BIGINT AS behind FROM lag GROUP BY ALL')
def backlog_by_group(spark, folder):
    """Messages behind by consumer group and topic."""
    return monitor.lag_by_group_topic(_group_lag(spark, folder))


@case(f'{_LAG_SQL} SELECT "group", sum(behind)::BIGINT AS behind FROM lag GROUP BY ALL')
def backlog_group_total(spark, folder):
    """Messages behind by consumer group, over all its topics."""
    return monitor.lag_by_group(_group_lag(spark, folder))


@case(f'{_LAG_SQL} SELECT "group", topic, sum(behind)::BIGINT AS behind FROM lag GROUP BY ALL')
def backlog_by_group_topic(spark, folder):
    """Messages behind by consumer group and topic."""
    return monitor.lag_by_group_topic(_group_lag(spark, folder))


@case("""
    SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS run_id FROM events e
    WHERE strftime(ts, '%Y-%m-%d') = (SELECT max(strftime(ts, '%Y-%m-%d')) FROM events m
                                      WHERE m.event_type = e.event_type)""")
def snapshot_latest_run(spark, folder):
    """Rows of the latest run of each topic; a run is a day."""
    runs = table(spark, folder, "events").select(
        "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("run_id")
    )
    return latest_run_per(runs, "event_type").select("event_id", "event_type", "run_id")


@case("""
    SELECT event_type, strftime(day, '%Y-%m-%d') AS day, n, round(mean_n, 6) AS mean_n,
           round(std_n, 6) AS std_n, abs(n - mean_n) > 2 * std_n AS is_anomaly
    FROM (SELECT event_type, day, n, CASE WHEN count(*) OVER w = 7 THEN avg(n) OVER w END AS mean_n,
                 CASE WHEN count(*) OVER w = 7 THEN stddev_samp(n) OVER w END AS std_n
          FROM (SELECT event_type, date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1, 2) d
          WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) t""")
def volume_anomaly(spark, folder):
    """Daily volume against the seven days before."""
    report = quality.volume_anomalies(
        table(spark, folder, "events"), "event_type", F.date_format("ts", "yyyy-MM-dd")
    )
    return report.withColumns({"mean_n": F.round("mean_n", 6), "std_n": F.round("std_n", 6)})


@case("""
    SELECT 'orders' AS input_name, count(*) AS n_rows,
           (SELECT count(*)::INTEGER FROM (DESCRIBE SELECT * FROM """ + _GAPS_SQL + """)) AS n_columns,
           round(avg((game_pk IS NULL)::INT) * 100, 6) AS game_pk_pct,
           round(avg((home_team_id IS NULL)::INT) * 100, 6) AS home_team_id_pct,
           CASE WHEN count(*) = 0 THEN 'empty' WHEN count(game_pk) + count(home_team_id) < 2 * count(*) THEN 'nulls'
                ELSE 'ok' END AS status FROM """ + _GAPS_SQL)
def input_report(spark, folder):
    """Rows, columns and missing values of an input."""
    required = ["game_pk", "home_team_id"]
    report = quality.input_report(_with_gaps(spark, folder), "orders", required)
    shares = [F.round(F.coalesce(F.col("null_pct")[c], F.lit(0.0)), 6).alias(f"{c}_pct") for c in required]
    return report.select("input_name", "n_rows", "n_columns", *shares, "status")
