"""Explicit schemas: feed documents, raw tables, message envelopes. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DoubleType, LongType, StringType, StructField, StructType,
    TimestampType,
)

INT, TEXT, FLAG, NUMBER = LongType(), StringType(), BooleanType(), DoubleType()


def record(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def many(**fields: DataType) -> ArrayType:
    return ArrayType(record(**fields))


_REF = record(id=INT, name=TEXT)
_PERSON = record(id=INT, fullName=TEXT)
_SIDE = record(team=_REF, score=INT, probablePitcher=_PERSON)

TEAMS_DOC = record(
    teams=many(
        id=INT, name=TEXT, abbreviation=TEXT, teamCode=TEXT,
        division=_REF, league=_REF, venue=_REF,
    )
)

STANDINGS_DOC = record(
    records=many(
        division=_REF,
        league=_REF,
        teamRecords=many(
            team=_REF,
            leagueRecord=record(wins=INT, losses=INT, pct=TEXT),
            gamesBack=TEXT,
            gamesPlayed=INT,
        ),
    )
)

SCHEDULE_DOC = record(
    dates=many(
        date=TEXT,
        games=many(
            gamePk=INT, gameDate=TEXT, gameType=TEXT, status=record(detailedState=TEXT),
            venue=_REF, teams=record(home=_SIDE, away=_SIDE),
        ),
    )
)


def _stats_doc(numbers: str, texts: str) -> StructType:
    stat = record(**{n: INT for n in numbers.split()}, **{t: TEXT for t in texts.split()})
    return record(stats=many(splits=many(player=_PERSON, team=_REF, stat=stat)))


HITTING_DOC = _stats_doc(
    """gamesPlayed atBats plateAppearances hits doubles triples homeRuns rbi baseOnBalls
    strikeOuts stolenBases""",
    "avg obp slg ops",
)

PITCHING_DOC = _stats_doc(
    """gamesPlayed gamesStarted wins losses saves hits earnedRuns baseOnBalls strikeOuts
    homeRuns""",
    "inningsPitched era whip strikeoutsPer9Inn walksPer9Inn",
)

PLAYS_DOC = record(
    gamePk=INT,
    liveData=record(
        plays=record(
            allPlays=many(
                result=record(event=TEXT, description=TEXT, rbi=INT, homeScore=INT, awayScore=INT),
                about=record(
                    atBatIndex=INT, inning=INT, halfInning=TEXT, startTime=TEXT, endTime=TEXT,
                    isComplete=FLAG, isScoringPlay=FLAG,
                ),
                matchup=record(batter=_PERSON, pitcher=_PERSON),
            )
        )
    ),
)

ENVELOPE = record(topic=TEXT, key=TEXT, value=TEXT, ts=TimestampType(), run_id=TEXT)


def flat(columns: str) -> StructType:
    """Table schema: ``name`` is a number, ``name:s`` text, ``name:b`` a flag."""
    kinds = {"": NUMBER, "s": TEXT, "b": FLAG}
    entries = [entry.partition(":") for entry in columns.split()]
    return record(**{name: kinds[kind] for name, _, kind in entries})


# Numbers land as double: nullable integers arrive as 5.0 or NaN.
RAW = {
    "teams": flat(
        """team_id team_name:s abbreviation:s team_code:s division_id division_name:s
        league_id league_name:s venue_id venue_name:s season"""
    ),
    "standings": flat(
        """team_id team_name:s division_id division:s league_id league:s wins losses win_pct
        games_back:s games_played season"""
    ),
    "schedule": flat(
        """game_pk game_date:s status:s home_team_id home_team:s away_team_id away_team:s
        home_score away_score venue:s"""
    ),
    "game_events": flat(
        """game_pk at_bat_index inning half_inning:s start_time:s end_time:s is_complete:b
        is_scoring:b event_type:s description:s rbi home_score away_score batter_id
        batter_name:s pitcher_id pitcher_name:s"""
    ),
    "hitting_stats": flat(
        """player_id player_name:s team_id team_name:s games at_bats plate_appearances hits
        doubles triples home_runs rbi walks strikeouts stolen_bases batting_avg:s obp:s slg:s
        ops:s season"""
    ),
    "pitching_stats": flat(
        """player_id player_name:s team_id team_name:s games games_started wins losses saves
        innings_pitched:s hits_allowed earned_runs walks_allowed strikeouts home_runs_allowed
        era:s whip:s k_per_9:s bb_per_9:s season"""
    ),
}
