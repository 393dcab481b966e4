"""Feed flatteners and envelopes: table rows folded into documents, one document per row,
written as JSON text, parsed with the feed's schema and flattened."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.parse import wall_time, whole
from ..operators.dedup import keep_first
from ..operators.reshape import union_feeds
from ..session import scratch_path
from ..sources import feeds, schemas
from ..sources.envelopes import Feed, bad_rows, decode, good_rows, to_messages
from .registry import case, table


def _documents(rows: DataFrame, **fields: Column) -> DataFrame:
    return rows.select(F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("text"))


def _ref(key: Column, name: Column) -> Column:
    return F.struct(key.cast("bigint").alias("id"), name.alias("name"))


def _person(key: Column, name: Column) -> Column:
    return F.struct(key.cast("bigint").alias("id"), name.alias("fullName"))


@case("""
    SELECT s_suppkey AS team_id, s_name AS team_name, 'S' || s_nationkey AS abbreviation, 'c' || s_suppkey AS team_code,
           CASE WHEN s_acctbal >= 0 THEN s_nationkey::BIGINT END AS division_id,
           CASE WHEN s_acctbal >= 0 THEN 'N' || s_nationkey END AS division_name,
           s_suppkey % 2 AS league_id, 'L' || (s_suppkey % 2) AS league_name,
           s_suppkey + 500 AS venue_id, 'at ' || s_name AS venue_name, 2026 AS season
    FROM supplier
    UNION ALL
    SELECT -1 - s_suppkey, 'farm of ' || s_name, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 2026 FROM supplier""")
def flatten_teams(spark, folder):
    """Two teams per document, the second without any of the optional objects."""
    rows = table(spark, folder, "supplier")
    key, name, nation = F.col("s_suppkey"), F.col("s_name"), F.col("s_nationkey")
    division = F.when(
        F.col("s_acctbal") >= 0, _ref(nation, F.concat(F.lit("N"), nation.cast("string")))
    )
    text, ref = F.lit(None).cast("string"), F.lit(None).cast("struct<id: bigint, name: string>")
    team = F.struct(
        key.alias("id"), name.alias("name"),
        F.concat(F.lit("S"), nation.cast("string")).alias("abbreviation"),
        F.concat(F.lit("c"), key.cast("string")).alias("teamCode"),
        division.alias("division"),
        _ref(key % 2, F.concat(F.lit("L"), (key % 2).cast("string"))).alias("league"),
        _ref(key + 500, F.concat(F.lit("at "), name)).alias("venue"),
    )
    farm = F.struct(
        (-1 - key).alias("id"), F.concat(F.lit("farm of "), name).alias("name"),
        text.alias("abbreviation"), text.alias("teamCode"),
        ref.alias("division"), ref.alias("league"), ref.alias("venue"),
    )
    documents = _documents(rows, teams=F.array(team, farm))
    return feeds.teams(feeds.parse_documents(documents, "text", schemas.TEAMS_DOC), 2026)


@case("""
    SELECT c_custkey AS team_id, c_name AS team_name, (200 + c_nationkey % 8)::BIGINT AS division_id,
           CASE c_nationkey % 8 WHEN 0 THEN 'AL West' WHEN 1 THEN 'AL East' WHEN 2 THEN 'AL Central'
                WHEN 3 THEN 'NL West' WHEN 4 THEN 'NL East' WHEN 5 THEN 'NL Central'
                ELSE (200 + c_nationkey % 8)::VARCHAR END AS division,
           (103 + c_nationkey % 3)::BIGINT AS league_id,
           CASE c_nationkey % 3 WHEN 0 THEN 'American League' WHEN 1 THEN 'National League'
                ELSE '105' END AS league,
           c_nationkey::BIGINT AS wins, c_nationkey::BIGINT + 1 AS losses, 0.5::DOUBLE AS win_pct,
           '1.5' AS games_back, c_nationkey::BIGINT * 2 + 1 AS games_played, 2026 AS season
    FROM customer
    UNION ALL
    SELECT -1 - c_custkey, c_mktsegment, 200 + c_nationkey % 8,
           CASE c_nationkey % 8 WHEN 0 THEN 'AL West' WHEN 1 THEN 'AL East' WHEN 2 THEN 'AL Central'
                WHEN 3 THEN 'NL West' WHEN 4 THEN 'NL East' WHEN 5 THEN 'NL Central'
                ELSE (200 + c_nationkey % 8)::VARCHAR END,
           103 + c_nationkey % 3,
           CASE c_nationkey % 3 WHEN 0 THEN 'American League' WHEN 1 THEN 'National League'
                ELSE '105' END,
           0, 0, 0, '-', 0, 2026
    FROM customer""")
def flatten_standings(spark, folder):
    """Two levels; division and league by code or code text; defaults for a bare record."""
    rows = table(spark, folder, "customer")
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("bigint")
    full = F.struct(
        _ref(key, F.col("c_name")).alias("team"),
        F.struct(
            nation.alias("wins"), (nation + 1).alias("losses"), F.lit(".500").alias("pct")
        ).alias("leagueRecord"),
        F.lit("1.5").alias("gamesBack"),
        (nation * 2 + 1).alias("gamesPlayed"),
    )
    bare = F.struct(
        _ref(-1 - key, F.col("c_mktsegment")).alias("team"),
        F.lit(None).cast("struct<wins: bigint, losses: bigint, pct: string>").alias("leagueRecord"),
        F.lit(None).cast("string").alias("gamesBack"),
        F.lit(None).cast("bigint").alias("gamesPlayed"),
    )
    record = F.struct(
        F.struct((200 + nation % 8).alias("id")).alias("division"),
        F.struct((103 + nation % 3).alias("id")).alias("league"),
        F.array(full, bare).alias("teamRecords"),
    )
    empty = F.struct(
        F.struct(F.lit(0).cast("bigint").alias("id")).alias("division"),
        F.struct(F.lit(0).cast("bigint").alias("id")).alias("league"),
        F.slice(F.array(full, bare), 1, 0).alias("teamRecords"),
    )
    documents = _documents(rows, records=F.array(empty, record))
    flat = feeds.standings(feeds.parse_documents(documents, "text", schemas.STANDINGS_DOC), 2026)
    return flat.withColumn("win_pct", F.col("win_pct").cast("double"))


def _schedule_documents(spark, folder) -> DataFrame:
    texts = _schedule_texts(table(spark, folder, "orders"))
    return feeds.parse_documents(texts, "text", schemas.SCHEDULE_DOC)


def _schedule_texts(rows: DataFrame, *carry: Column) -> DataFrame:
    """An order as a day with two games behind an empty day; no score while it is pending, and
    then no probable pitcher on the home side either."""
    key, customer, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    visitor = key % 97
    name = lambda word, c: F.concat(F.lit(word), c.cast("string"))
    home = F.struct(
        _ref(customer, name("club_", customer)).alias("team"),
        F.when(status != "P", customer % 10).alias("score"),
        F.when(status != "P", _person(customer % 50, name("arm_", customer % 50))).alias("probablePitcher"),
    )
    away = F.struct(
        _ref(visitor, name("guest_", visitor)).alias("team"),
        F.when(status != "P", visitor % 7).alias("score"),
        _person(visitor, name("arm_", visitor)).alias("probablePitcher"),
    )
    game = F.struct(
        key.alias("gamePk"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("gameDate"),
        F.when(F.col("o_orderpriority") == "5-LOW", "S").otherwise("R").alias("gameType"),
        F.struct(
            F.when(status == "F", "Final").when(status == "O", "In Progress").otherwise("Scheduled").alias("detailedState")
        ).alias("status"),
        F.when(
            F.col("o_orderpriority") != "2-HIGH", F.struct(F.col("o_orderpriority").alias("name"))
        ).alias("venue"),
        F.struct(home.alias("home"), away.alias("away")).alias("teams"),
    )
    games = F.array(game, game.withField("gamePk", -1 - key))
    played = F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")
    off, day = F.struct(played, F.slice(games, 1, 0).alias("games")), F.struct(played, games.alias("games"))
    return rows.select(F.to_json(F.struct(F.array(off, day).alias("dates"))).alias("text"), *carry)


# Every order with the key of its own game and that of the day's second one.
_TWO_GAMES = "(SELECT *, o_orderkey AS pk FROM orders UNION ALL SELECT *, -1 - o_orderkey FROM orders) orders"
_GAME_COLUMNS = """
    SELECT pk AS game_pk, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS game_date,
           CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'In Progress' ELSE 'Scheduled' END AS status,
           o_custkey AS home_team_id, 'club_' || o_custkey AS home_team,
           o_orderkey % 97 AS away_team_id, 'guest_' || (o_orderkey % 97) AS away_team,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 10 END AS home_score,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 97 % 7 END AS away_score,
           CASE WHEN o_orderpriority <> '2-HIGH' THEN o_orderpriority END AS venue"""
_GAME_SQL = f"{_GAME_COLUMNS} FROM {_TWO_GAMES}"


@case(f"""{_GAME_COLUMNS}, strftime(o_orderdate, '%Y-%m-%d') AS game_day,
           CASE o_orderpriority WHEN '5-LOW' THEN 'S' ELSE 'R' END AS game_type,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 50 END AS home_pitcher_id,
           CASE WHEN o_orderstatus <> 'P' THEN 'arm_' || (o_custkey % 50) END AS home_pitcher_name,
           o_orderkey % 97 AS away_pitcher_id, 'arm_' || (o_orderkey % 97) AS away_pitcher_name
    FROM {_TWO_GAMES}""")
def flatten_schedule(spark, folder):
    """Days and games to rows, of all days and types."""
    flat = feeds.games(_schedule_documents(spark, folder))
    pitchers = [
        F.col(f"{side}_pitcher.{field}").alias(f"{side}_pitcher_{name}")
        for side in ("home", "away") for field, name in (("id", "id"), ("fullName", "name"))
    ]
    return flat.select("*", *pitchers).drop("home_pitcher", "away_pitcher").withColumn(
        "game_day", F.date_format("game_day", "yyyy-MM-dd")
    )


@case(_GAME_SQL + """
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-25' AND TIMESTAMP '1998-09-30'
      AND o_orderpriority <> '5-LOW'""")
def season_schedule(spark, folder):
    """Regular-season games between two days."""
    return feeds.season_schedule(
        _schedule_documents(spark, folder),
        F.lit("1998-09-30").cast("date"),
        F.lit("1996-03-25").cast("date"),
    )


@case(_GAME_SQL + " WHERE o_orderdate = TIMESTAMP '1997-05-28'")
def day_schedule(spark, folder):
    """All games of one day."""
    return feeds.schedule(_schedule_documents(spark, folder), F.lit("1997-05-28").cast("date"))


@case(f"{_GAME_SQL} WHERE o_orderdate >= TIMESTAMP '1997-05-01' AND o_orderdate < TIMESTAMP '1997-08-01'")
def schedule_day_folders(spark, folder):
    """Documents in folders by the first day of their month, of which three are opened."""
    path = scratch_path(spark, "documents")
    day = F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd").alias("day")
    texts = _schedule_texts(table(spark, folder, "orders"), day)
    texts.repartition("day").write.partitionBy("day").text(path)
    days = (date(1997, 5, 1), date(1997, 7, 31))
    documents = feeds.read_documents(spark, path, schemas.SCHEDULE_DOC, days=days)
    return feeds.games(documents).select(*feeds.SCHEDULE_COLUMNS)


@case("""
    WITH g AS (SELECT pk AS k, o_custkey AS c, o_orderkey % 97 AS v, o_orderstatus AS s,
                      CASE o_orderpriority WHEN '2-HIGH' THEN '' ELSE o_orderpriority END AS venue,
                      'guest_' || (o_orderkey % 97) || ' @ club_' || o_custkey AS matchup,
                      CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'In Progress' ELSE 'Scheduled' END AS state
               FROM """ + _TWO_GAMES + """)
    SELECT k AS game_pk, venue, matchup, 'guest_' || v AS batting_team, v AS batting_team_id,
           CASE WHEN s <> 'P' THEN c % 50 END AS pitcher_id,
           CASE WHEN s <> 'P' THEN 'arm_' || (c % 50) ELSE 'TBD' END AS pitcher_name, state AS game_status FROM g
    UNION ALL
    SELECT k, venue, matchup, 'club_' || c, c, v, 'arm_' || v, state FROM g""")
def two_sided_unpivot(spark, folder):
    """Each game as two batting sides against the other side's probable pitcher."""
    return feeds.batting_sides(feeds.games(_schedule_documents(spark, folder)))


@case("""
    WITH g AS (SELECT pk AS k, o_custkey AS c, o_orderkey % 97 AS v, o_orderstatus AS s, * FROM """ + _TWO_GAMES + """
               WHERE o_orderdate = TIMESTAMP '1997-05-28' AND o_orderpriority <> '5-LOW')
    SELECT k AS game_pk, 'guest_' || v AS batting_team, CASE WHEN s <> 'P' THEN c % 50 END AS pitcher_id FROM g
    UNION ALL SELECT k, 'club_' || c, v FROM g""")
def probable_pitchers(spark, folder):
    """Batting sides of the regular-season games of one day."""
    sides = feeds.probable_pitchers(_schedule_documents(spark, folder), F.lit("1997-05-28").cast("date"))
    return sides.select("game_pk", "batting_team", "pitcher_id")


_HITTING = {
    "games": "gamesPlayed", "at_bats": "atBats", "plate_appearances": "plateAppearances", "hits": "hits",
    "doubles": "doubles", "triples": "triples", "home_runs": "homeRuns", "rbi": "rbi", "walks": "baseOnBalls",
    "strikeouts": "strikeOuts", "stolen_bases": "stolenBases",
}
_HITTING_RATES = {"batting_avg": "avg", "obp": "obp", "slg": "slg", "ops": "ops"}
_PITCHING = {
    "games": "gamesPlayed", "games_started": "gamesStarted", "wins": "wins", "losses": "losses", "saves": "saves",
    "hits_allowed": "hits", "earned_runs": "earnedRuns", "walks_allowed": "baseOnBalls", "strikeouts": "strikeOuts",
    "home_runs_allowed": "homeRuns",
}
_PITCHING_RATES = {
    "innings_pitched": "inningsPitched", "era": "era", "whip": "whip", "k_per_9": "strikeoutsPer9Inn",
    "bb_per_9": "walksPer9Inn",
}


def _stats_sql(key: str, name: str, nation: str, known: str, numbers, rates, of: str) -> str:
    """Two splits per document: the row's, and one with a negative key and everything else alike."""
    counts = ", ".join(f"{nation}::BIGINT + {i} AS {c}" for i, c in enumerate(numbers))
    texts = ", ".join(f"CASE WHEN {known} THEN '.{i}' || {nation} END AS {c}" for i, c in enumerate(rates))
    rest = f"{name} AS player_name, {nation}::BIGINT AS team_id, 'club' AS team_name, {counts}, {texts}, 2026 AS season"
    return f"SELECT {key} AS player_id, {rest} FROM {of} UNION ALL SELECT -1 - {key}, {rest} FROM {of}"


def _stats_documents(rows, key: Column, name: Column, nation: Column, known: Column, numbers, rates) -> DataFrame:
    """Only the first stats block counts; the second one repeats it and is ignored."""
    counts = [(nation + i).alias(field) for i, field in enumerate(numbers.values())]
    texts = [
        F.when(known, F.concat(F.lit(f".{i}"), nation.cast("string"))).alias(field)
        for i, field in enumerate(rates.values())
    ]
    def split(player):
        return F.struct(
            _person(player, name).alias("player"), _ref(nation, F.lit("club")).alias("team"),
            F.struct(*counts, *texts).alias("stat"),
        )

    block = F.struct(F.array(split(key), split(-1 - key)).alias("splits"))
    return _documents(rows, stats=F.array(block, block))


@case(_stats_sql("c_custkey", "c_name", "c_nationkey", "c_acctbal >= 0", _HITTING, _HITTING_RATES, "customer"))
def flatten_hitting(spark, folder):
    """Batting splits with all their columns; rates stay text, and some are missing."""
    rows, nation = table(spark, folder, "customer"), F.col("c_nationkey").cast("bigint")
    documents = _stats_documents(
        rows, F.col("c_custkey"), F.col("c_name"), nation, F.col("c_acctbal") >= 0, _HITTING, _HITTING_RATES
    )
    return feeds.hitting_stats(feeds.parse_documents(documents, "text", schemas.HITTING_DOC), 2026)


@case(_stats_sql("s_suppkey", "s_name", "s_nationkey", "s_acctbal >= 0", _PITCHING, _PITCHING_RATES, "supplier"))
def flatten_pitching(spark, folder):
    """Pitching splits with all their columns; rates and innings stay text."""
    rows, nation = table(spark, folder, "supplier"), F.col("s_nationkey").cast("bigint")
    documents = _stats_documents(
        rows, F.col("s_suppkey"), F.col("s_name"), nation, F.col("s_acctbal") >= 0, _PITCHING, _PITCHING_RATES
    )
    return feeds.pitching_stats(feeds.parse_documents(documents, "text", schemas.PITCHING_DOC), 2026)


_PLAY_SQL = """
    SELECT l_orderkey AS game_pk, l_linenumber::BIGINT + {later} AS at_bat_index, l_quantity::BIGINT AS inning,
           CASE l_linestatus WHEN 'F' THEN 'top' ELSE 'bottom' END AS half_inning,
           strftime(l_shipdate, '%Y-%m-%d') AS start_time, strftime(l_shipdate, '%d.%m.%Y') AS end_time,
           coalesce(CASE WHEN l_returnflag <> 'N' THEN true END, false) AS is_complete,
           coalesce(CASE WHEN l_returnflag = 'A' THEN true END, false) AS is_scoring,
           'Event ' || l_returnflag AS event_type, 'line ' || l_linenumber AS description,
           l_partkey % 5 AS rbi, l_partkey % 11 AS home_score, l_suppkey % 13 AS away_score,
           l_partkey AS batter_id, 'b' || l_partkey AS batter_name, l_suppkey AS pitcher_id,
           'p' || l_suppkey AS pitcher_name
    FROM lineitem"""


@case(f"{_PLAY_SQL.format(later=0)} UNION ALL {_PLAY_SQL.format(later=100)}")
def flatten_plays(spark, folder):
    """Play-by-play documents of two plays each; missing flags count as false."""
    rows = table(spark, folder, "lineitem")
    supplier, part, flag = F.col("l_suppkey"), F.col("l_partkey"), F.col("l_returnflag")
    # What both plays have in common is made once per row, in front of the JSON writer.
    rows = rows.select(
        "l_orderkey", "l_linenumber",
        F.struct(
            F.concat(F.lit("Event "), flag).alias("event"),
            F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("description"),
            (part % 5).alias("rbi"), (part % 11).alias("homeScore"), (supplier % 13).alias("awayScore"),
        ).alias("result"),
        F.struct(
            F.col("l_quantity").cast("bigint").alias("inning"),
            F.when(F.col("l_linestatus") == "F", "top").otherwise("bottom").alias("halfInning"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("startTime"),
            F.date_format("l_shipdate", "dd.MM.yyyy").alias("endTime"),
            F.when(flag != "N", True).alias("isComplete"),
            F.when(flag == "A", True).alias("isScoringPlay"),
        ).alias("about"),
        F.struct(
            _person(part, F.concat(F.lit("b"), part.cast("string"))).alias("batter"),
            _person(supplier, F.concat(F.lit("p"), supplier.cast("string"))).alias("pitcher"),
        ).alias("matchup"),
    )

    def play(later):
        index = (F.col("l_linenumber") + later).alias("atBatIndex")
        return F.struct("result", F.struct(index, "about.*").alias("about"), "matchup")

    live = F.struct(F.struct(F.array(play(0), play(100)).alias("allPlays")).alias("plays"))
    documents = _documents(rows, gamePk=F.col("l_orderkey"), liveData=live)
    return feeds.game_events(feeds.parse_documents(documents, "text", schemas.PLAYS_DOC))


EVENT_FEED = Feed(
    "events",
    lambda: F.col("event_id").cast("string"),
    False,
    schemas.flat("event_id ts:s user_id event_type:s value props:s"),
)


@case("""
    SELECT event_id::VARCHAR AS key, event_id, ts, user_id, event_type,
           CASE WHEN event_type <> 'error' THEN value END AS value, props, 'r1' AS run_id
    FROM events""")
def json_envelope_roundtrip(spark, folder):
    """Rows to keyed JSON messages and back, with missing values."""
    rows = table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("string").alias("ts"), "user_id", "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"), "props",
    )
    messages = to_messages(rows, EVENT_FEED, "r1", F.lit("2024-02-01").cast("timestamp"))
    decoded = decode(messages, EVENT_FEED.schema).filter(~F.col("is_bad"))
    return decoded.select(
        "key",
        whole("row.event_id", "bigint").alias("event_id"),
        wall_time("row.ts").alias("ts"),
        whole("row.user_id", "bigint").alias("user_id"),
        "row.event_type", "row.value", "row.props", "run_id",
    )


@case("""
    SELECT event_type AS topic, count(*) FILTER (NOT bad) AS good, count(*) FILTER (bad) AS broken,
           sum(CASE WHEN NOT bad THEN regexp_extract(props, '[0-9]+')::BIGINT END)::BIGINT AS total
    FROM (SELECT *, CASE WHEN event_type IN ('signup', 'click') THEN value >= 50 ELSE value < 5 END AS bad
          FROM events) t
    GROUP BY event_type""")
def bad_message_quarantine(spark, folder):
    """Truncated, missing, empty, blank and doubled messages, and such with text behind them,
    are set aside; the others stay."""
    events = table(spark, folder, "events")
    kind, value = F.col("event_type"), F.col("value")
    sent = (
        F.when(kind.isin("signup", "click") & (value >= 50), F.substring("props", 1, 5))
        .when(~kind.isin("signup", "click") & (value < 0.5), F.lit("not json"))
        .when(~kind.isin("signup", "click") & (value < 1), F.lit(None))
        .when(~kind.isin("signup", "click") & (value < 2), F.lit(""))
        .when(~kind.isin("signup", "click") & (value < 3), F.lit("  "))
        .when(~kind.isin("signup", "click") & (value < 4), F.concat("props", "props"))
        .when(~kind.isin("signup", "click") & (value < 5), F.concat("props", F.lit(" x")))
        .otherwise(F.col("props"))
    )
    messages = events.select(
        kind.alias("topic"), F.col("event_id").cast("string").alias("key"), sent.alias("value"),
        F.col("ts").cast("timestamp").alias("ts"), F.lit("r1").alias("run_id"),
    )
    schema = schemas.flat("k")
    decoded = decode(messages, schema)
    kept = decoded.filter(~F.col("is_bad")).select("topic", F.col("row.k").alias("k"), F.lit(0).alias("bad"))
    aside = bad_rows(decoded).select("topic", F.lit(None).cast("double").alias("k"), F.lit(1).alias("bad"))
    assert good_rows(decoded, schema).columns == ["k", "run_id"]
    return (
        kept.unionByName(aside)
        .groupBy("topic")
        .agg(
            F.count_if(F.col("bad") == 0).alias("good"),
            F.count_if(F.col("bad") == 1).alias("broken"),
            F.sum("k").cast("bigint").alias("total"),
        )
    )


@case("""
    SELECT o_orderkey, status, o_totalprice, source FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY
            CASE status WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, source DESC) AS rn
        FROM (SELECT o_orderkey, o_orderstatus AS status, o_totalprice, 'season' AS source FROM orders
              UNION ALL
              SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'O' ELSE 'F' END, o_totalprice, 'today'
              FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01') u) t
    WHERE rn = 1""")
def union_feeds_dedup(spark, folder):
    """A season feed and a later refetch of recent days in one table, one row per order."""
    orders = table(spark, folder, "orders")
    status = F.col("o_orderstatus")
    season = orders.select("o_orderkey", status.alias("status"), "o_totalprice", F.lit("season").alias("source"))
    recent = orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", F.when(status == "P", "O").otherwise("F").alias("status"), "o_totalprice",
        F.lit("today").alias("source"),
    )
    state = F.when(F.col("status") == "F", 1).when(F.col("status") == "O", 2).otherwise(3)
    return keep_first(
        union_feeds([season, recent]), ["o_orderkey"], [state.asc(), F.col("source").desc()]
    )
