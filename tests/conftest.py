import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from dugout.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__sql__maxMetadataStringLength="10000",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """``values("a int, b string", (1, "x"), ...)`` as a DataFrame."""

    def make(schema, *rows):
        return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)

    return make


def listed(df, *columns):
    """Rows as sorted tuples, missing values first."""
    data = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(data, key=lambda row: tuple((v is not None, str(v)) for v in row))


def plan(df):
    """Physical plan text."""
    return df._jdf.queryExecution().executedPlan().toString()


def write_documents(folder: Path, name: str, documents: list) -> None:
    target = folder / name
    target.mkdir(parents=True, exist_ok=True)
    (target / "part.json").write_text("\n".join(json.dumps(d) for d in documents))


def season_documents(folder: Path) -> None:
    """Thirty teams in six divisions, a season schedule, batters, pitchers and plays."""
    divisions, leagues = list(range(200, 206)), {200: 103, 201: 103, 202: 103}
    teams, records = [], {}
    for i in range(30):
        division = divisions[i % 6]
        league = leagues.get(division, 104)
        teams.append(
            {
                "id": 100 + i, "name": f"Team {i}", "abbreviation": f"T{i}",
                "division": {"id": division, "name": f"Division {division}"},
                "league": {"id": league, "name": f"League {league}"},
                "venue": {"id": 500 + i, "name": "Coors Field" if i == 0 else f"Park {i}"},
            }
        )
        records.setdefault(division, {"division": {"id": division}, "league": {"id": league}, "teamRecords": []})
        records[division]["teamRecords"].append(
            {
                "team": {"id": 100 + i, "name": f"Team {i}"},
                "leagueRecord": {"wins": 10 - i % 4, "losses": 5 + i % 4, "pct": f".{600 + i}"},
                "gamesBack": "-", "gamesPlayed": 15,
            }
        )
    write_documents(folder, "teams", [{"teams": teams}])
    write_documents(folder, "standings", [{"records": list(records.values())}])

    def game(pk, day, status, home, away, scores, kind="R"):
        def side(t, score, pitcher):
            result = {"team": {"id": 100 + t, "name": f"Team {t}"}}
            if score is not None:
                result["score"] = score
            if pitcher is not None:
                result["probablePitcher"] = {"id": pitcher, "fullName": f"Feed pitcher {pitcher}"}
            return result

        return {
            "gamePk": pk, "gameDate": f"{day}T23:05:00Z", "gameType": kind,
            "status": {"detailedState": status}, "venue": {"name": teams[home]["venue"]["name"]},
            "teams": {
                "home": side(home, scores and scores[0], 2000 + home),
                "away": side(away, scores and scores[1], None if away == 3 else 2000 + away),
            },
        }

    schedule = {
        "2026-03-20": [game(1, "2026-03-20", "Final", 0, 1, (1, 0), "S")],
        "2026-04-08": [
            game(10, "2026-04-08", "Final", 0, 1, (4, 2)),
            game(11, "2026-04-08", "Game Over", 2, 3, (2, 4)),
            game(12, "2026-04-08", "Final", 4, 5, (3, 3)),
        ],
        "2026-04-09": [game(13, "2026-04-09", "Postponed", 6, 7, None)],
        "2026-04-10": [
            game(20, "2026-04-10", "Scheduled", 0, 1, None),
            game(21, "2026-04-10", "Pre-Game", 2, 3, None),
        ],
    }
    write_documents(
        folder, "schedule",
        [{"dates": [{"date": day, "games": games}]} for day, games in schedule.items()],
    )

    hitters = [
        {
            "player": {"id": 1000 + i, "fullName": f"Batter {i:03d}"},
            "team": {"id": 100 + i % 30, "name": f"Team {i % 30}"},
            "stat": {
                "gamesPlayed": 15, "atBats": 50, "plateAppearances": 5 + i, "hits": i % 20,
                "homeRuns": i % 9, "avg": f".{200 + i}", "obp": ".300", "slg": ".400",
                "ops": "-.--" if i == 0 else f".{500 + i}",
            },
        }
        for i in range(90)
    ]
    traded = dict(hitters[50], team={"id": 129, "name": "Team 29"}, stat={"gamesPlayed": 40, "plateAppearances": 99, "homeRuns": 1, "ops": ".999"})
    write_documents(folder, "hitting", [{"stats": [{"splits": hitters + [traded]}]}])
    staff = [
        {
            "player": {"id": 2000 + i, "fullName": f"Pitcher {i:02d}"},
            "team": {"id": 100 + i, "name": f"Team {i}"},
            "stat": {
                "gamesPlayed": 10, "gamesStarted": 10 if i % 2 == 0 else 0, "wins": i % 7,
                "losses": 2, "saves": i % 5, "inningsPitched": f"{20 + i}.{i % 3}",
                "homeRuns": i % 6, "strikeOuts": 30 + i, "era": f"{2 + i / 10:.2f}", "whip": "1.10",
            },
        }
        for i in range(30)
    ]
    write_documents(folder, "pitching", [{"stats": [{"splits": staff}]}])

    def play(index, complete=True):
        return {
            "result": {"event": "Home Run" if index % 10 == 0 else "Strikeout", "rbi": index % 3, "homeScore": 0, "awayScore": 0},
            "about": {
                "atBatIndex": index, "inning": 1 + index // 8, "halfInning": "top",
                "startTime": f"2026-04-08T20:{index:02d}:00.000Z", "endTime": f"2026-04-08T20:{index:02d}:30.000Z",
                "isComplete": complete, "isScoringPlay": index % 3 == 0,
            },
            "matchup": {
                "batter": {"id": 1000 + index, "fullName": f"Batter {index:03d}"},
                "pitcher": {"id": 2000, "fullName": "Pitcher 00"},
            },
        }

    plays = [
        {"gamePk": pk, "liveData": {"plays": {"allPlays": [play(i) for i in range(24)] + [play(24, False)]}}}
        for pk in (1, 10, 11, 12)
    ]
    write_documents(folder, "plays", plays)
