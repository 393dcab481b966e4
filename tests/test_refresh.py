"""Marts that are rewritten where their staging tables have changed."""

import os

from conftest import listed, plan
from pyspark.sql import functions as F

from dugout.operators.bitmaps import keep_unmarked, merge_bitmaps, seen_bitmaps
from dugout.plans import marts
from dugout.session import settle
from dugout.sources import refresh
from dugout.sources.refresh import read_mart, refresh_mart
from dugout.standins import cases_tables
from dugout.standins.roles import games, standings
from dugout.streaming import live

SF = "/root/testdata/sf0.001"


def files(root):
    """Data files by partition, with the moment they were written."""
    return {e.name: sorted((f.name, f.stat().st_mtime_ns) for f in os.scandir(e) if f.name.endswith(".parquet")) for e in os.scandir(root) if e.is_dir()}


def test_one_changed_game_rewrites_one_partition(spark, tmp_path):
    root, staged = str(tmp_path), games(spark, SF)
    block = F.floor(F.col("game_pk") / 100)
    schema = marts.mart_game_results(staged).schema

    def refreshed(rows):
        n = refresh_mart(rows, root, "results", ["game_pk"], block, marts.mart_game_results)
        want = marts.mart_game_results(rows)
        assert listed(read_mart(spark, root, "results", schema)) == listed(want)
        return n

    assert refreshed(staged) > 3
    before = files(tmp_path / "results")
    assert refreshed(staged) == 0 and files(tmp_path / "results") == before
    one = marts.mart_game_results(staged).agg(F.min("game_pk")).first()[0]
    changed = staged.withColumn("home_score", F.when(F.col("game_pk") == one, F.col("away_score") + 7).otherwise(F.col("home_score")))
    assert refreshed(changed) == 1
    after = files(tmp_path / "results")
    assert [p for p in after if after[p] != before.get(p)] == [f"part={one // 100}"]
    # A game that is gone, one that moves to another block, and a block without games.
    assert refreshed(changed.filter(F.col("game_pk") != one)) == 1
    assert refreshed(changed.filter(block != one // 100)) == 1
    assert not (tmp_path / f"results/part={one // 100}").exists()


def test_ranks_are_built_again_by_league(spark, tmp_path):
    root, staged = str(tmp_path), standings(spark, SF)
    league = F.col("league_name")
    schema = marts.mart_standings(staged).schema
    first = refresh_mart(staged, root, "standings", ["team_id"], league, marts.mart_standings)
    name = staged.agg(F.min("league_name")).first()[0]
    changed = staged.withColumn("wins", F.when(league == name, F.col("wins") + F.col("team_id") % 3).otherwise(F.col("wins")))
    assert 0 < refresh_mart(changed, root, "standings", ["team_id"], league, marts.mart_standings) < max(2, first)
    assert listed(read_mart(spark, root, "standings", schema)) == listed(marts.mart_standings(changed))


def test_repeated_and_missing_keys(spark, values, tmp_path):
    keep = lambda df: df
    schema = "id int, a string"
    rows = [(1, "x"), (1, "x"), (None, "y"), (2, None)]

    def stored(*rows):
        staged = values(schema, *rows)
        n = refresh_mart(staged, str(tmp_path), "m", ["id"], F.col("a"), keep)
        assert listed(read_mart(spark, str(tmp_path), "m", staged.schema)) == listed(staged)
        return n

    assert stored(*rows) == 3
    assert stored(*rows[1:]) == 1  # one copy less
    assert stored(*rows[1:], (2, "a/b=c")) == 1
    assert stored(*rows[1:]) == 1 and stored() == 3


def test_bitmaps_are_exact(spark, values):
    known = [(1, 0), (1, 7), (1, 8), (1, 32767), (1, 32768), (1, 70000), (2, 5), (2, 5), (None, 1), (3, None)]
    more = [(1, 9), (2, 100), (4, 3)]
    bits = merge_bitmaps(
        seen_bitmaps(values("g long, n int", *known), "g", "n").unionByName(seen_bitmaps(values("g long, n int", *more), "g", "n")), "g"
    )
    sizes = {(r.g, r.bucket): len(r.bits) for r in seen_bitmaps(values("g long, n int", *known), "g", "n").collect()}
    assert sizes.pop((2, 1)) == 1 and sorted(sizes.values())[-1] <= 4096
    asked = [(g, n) for g in (1, 2, 4, 5) for n in (0, 1, 3, 5, 6, 7, 8, 9, 15, 100, 32766, 32767, 32768, 32769, 70000, 70001)]
    new = values("g long, n int", *asked, (None, 1), (1, None), (5, 0))
    held = {*known, *more}
    assert listed(keep_unmarked(new, bits, "g", "n")) == sorted([(*x,) for x in [*asked, (5, 0)] if x not in held], key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_bitmaps_take_eight_bytes_and_are_not_broadcast(spark, values):
    numbers = [0, 5, 63, 64, 127, 32767, 2**53 + 1, -1]
    bits = merge_bitmaps(seen_bitmaps(values("g long, n long", *[(1, n) for n in numbers]), "g", "n"), "g")
    assert max(len(r.bits) for r in bits.collect()) <= 8
    asked = {*numbers, *(n + 1 for n in numbers)}
    unmarked = keep_unmarked(values("g long, n long", *[(1, n) for n in sorted(asked)]), bits, "g", "n")
    assert listed(unmarked, "n") == sorted([(n,) for n in asked - set(numbers)], key=str)
    assert "Broadcast" not in plan(unmarked)


def test_plays_of_many_blocks_lie_in_few_files(spark, tmp_path):
    flags = [F.lit(True).alias("is_complete"), F.lit(False).alias("is_scoring")]
    texts = [F.lit(None).cast("string").alias(c) for c in ("half_inning", "start_time", "end_time", "event_type", "description", "batter_name", "pitcher_name")]
    empty = [F.lit(None).cast("double").alias(c) for c in ("inning", "rbi", "home_score", "away_score", "batter_id", "pitcher_id")]
    raw = spark.range(0, 200, 1, 4).select((F.col("id") * 1000).alias("game_pk"), F.lit(3).alias("at_bat_index"), *flags, *texts, *empty)
    root = str(tmp_path)
    for batch, rows in (("1", raw.filter("game_pk < 150000")), ("2", raw), ("2", raw)):
        live.add_plays(rows, root, batch)
    counts = spark.read.parquet(f"{root}/stg_game_events").groupBy("batch").count()
    assert listed(counts.select(F.col("batch").cast("string"), "count")) == [("1", 150), ("2", 50)]
    for table in ("stg_game_events", live.seen_table("stg_game_events")):
        assert len(list((tmp_path / table).rglob("*.parquet"))) < 50


def test_refreshed_mart_is_listed_by_few_tasks(spark, tmp_path, monkeypatch):
    root, staged = str(tmp_path), games(spark, SF)
    refresh_mart(staged, root, "results", ["game_pk"], F.floor(F.col("game_pk") / 100), marts.mart_game_results)
    seen, real, before = [], refresh.open_table, spark.conf.get(refresh._LISTING)
    monkeypatch.setattr(refresh, "open_table", lambda *args: seen.append(spark.conf.get(refresh._LISTING)) or real(*args))
    assert listed(read_mart(spark, root, "results", marts.mart_game_results(staged).schema)) == listed(marts.mart_game_results(staged))
    assert [int(n) <= 4 * spark.sparkContext.defaultParallelism for n in seen] == [True]
    assert spark.conf.get(refresh._LISTING) == before


def test_games_are_built_once_for_both_refreshes(spark, monkeypatch):
    built = []
    monkeypatch.setattr(cases_tables, "settle", lambda df, label: built.append(label) or settle(df, label))
    assert "Join" not in plan(cases_tables.mart_refresh(spark, SF)) and built == ["staged"]
