import random

import pytest
from conftest import listed, plan
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from dugout.operators import monitor, quality
from dugout.operators.dedup import columns_as_order, keep_first, keep_unseen, latest_run, latest_run_per
from dugout.operators import ranking
from dugout.operators.filters import column_filter, column_filters
from dugout.operators.ranking import Board, by, leaders, nulls_last, rank_within, seek_page, table_page, top_n, with_position
from dugout.operators.reshape import latest_day_with


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    once = keep_first(df, ["k"], [F.col("id").desc()])
    assert listed(once) == [(0, 99), (1, 97), (2, 98)]
    text = plan(once)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_keep_first_is_idempotent_with_a_hot_key(spark):
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    hot = spark.range(3000).select(key.alias("k"), (F.col("id") * 37 % 1009).alias("v"))
    once = keep_first(hot, ["k"], columns_as_order(hot))
    assert once.count() == 2001
    assert listed(keep_first(once, ["k"], columns_as_order(once))) == listed(once)
    assert once.filter("k = -1").first()["v"] == 0


def test_traded_player_with_unknown_games_first(values):
    df = values("player int, games int", (1, 40), (1, 62), (1, None), (2, 40), (2, 62))
    assert listed(keep_first(df, ["player"], [by("games", desc=True)])) == [(1, None), (2, 62)]


def test_keep_unseen_ignores_null_keys_on_both_sides(values):
    new = values("k string, v int", ("a", 1), ("b", 2), (None, 3))
    known = values("k string", "a", None)
    assert listed(keep_unseen(new, known, "k")) == [("b", 2)]


def test_keep_unseen_pruning_changes_nothing(values, spark, tmp_path):
    new = values("k string, p int", ("1_a", 1), ("2_a", 2), ("2_b", 2), ("x", None), ("y", None), ("5_a", 5))
    values("k string, p int", ("2_a", 2), ("3_a", 3), ("9_a", 9), ("x", None)).write.partitionBy("p").parquet(str(tmp_path / "known"))
    known = spark.read.schema("k string, p int").parquet(str(tmp_path / "known"))
    unseen = keep_unseen(new, known, "k", "p")
    assert listed(unseen) == [("1_a", 1), ("2_b", 2), ("5_a", 5), ("y", None)]
    assert "dynamicpruning" in plan(unseen)
    assert listed(keep_unseen(new.limit(0), known, "k", "p")) == []


def test_latest_run(values):
    df = values("t string, run_id string", ("a", "r1"), ("a", "r2"), ("b", "r1"))
    assert listed(latest_run(df), "t", "run_id") == [("a", "r2")]
    assert listed(latest_run_per(df, "t"), "t", "run_id") == [("a", "r2"), ("b", "r1")]


def test_rank_ties(values):
    df = values("t string, d string, w int, l int", ("a", "x", 10, 5), ("b", "x", 10, 5), ("c", "x", 9, 6))
    ranked = rank_within(df, {"r": ["d"]}, [("w", True), ("l", False)])
    assert listed(ranked, "t", "r") == [("a", 1), ("b", 1), ("c", 3)]


def test_rank_equals_window_with_nulls_and_hot_values(spark):
    rng = random.Random(5)
    pick = lambda *options: rng.choice(options)
    rows = [(i, pick("x", "y", None), pick("p", "q"), pick(1, 1, 1, 2, 3, None), pick(0, 4, None)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, d string, g string, w int, l int")
    ranked = rank_within(df, {"dr": ["d"], "gr": ["g"]}, [("w", True), ("l", False)])
    window = lambda c: Window.partitionBy(c).orderBy(by("w", desc=True), by("l"))
    expected = df.select("id", F.rank().over(window("d")).cast("bigint"), F.rank().over(window("g")).cast("bigint"))
    assert listed(ranked, "id", "dr", "gr") == listed(expected)
    assert ranked.filter("dr = 1").select("d").distinct().count() == 3


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=25))
def test_rank_property(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, d string, w int, l int")
    ranked = rank_within(df, {"r": ["d"]}, [("w", True), ("l", False)])
    expected = [
        (i, 1 + sum(d2 == d and (w2 > w or (w2 == w and l2 < l)) for d2, w2, l2 in rows))
        for i, (d, w, l) in enumerate(rows)
    ]
    assert listed(ranked, "id", "r") == sorted(expected, key=lambda r: str(r[0]))


def test_with_position_numbers_all_rows(spark):
    df = spark.range(0, 5000, 1, 16).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("v"))
    numbered = with_position(df, [F.col("v").desc_nulls_last(), F.col("id").asc()])
    expected = sorted(((i, i % 7 if i % 3 else None) for i in range(5000)), key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    got = sorted(((r["position"], r["id"], r["v"]) for r in numbered.collect()))
    assert got == [(n + 1, *row) for n, row in enumerate(expected)]


def test_table_page(spark):
    df = spark.range(100)
    page = table_page(df, [F.col("id").desc()], 2, 15, [F.col("id") % 2 == 0])
    assert sorted((r["id"] for r in page.collect()), reverse=True) == list(range(38, 8, -2))


def test_pages_of_a_partial_order_share_and_lose_nothing(spark):
    df = spark.range(0, 60, 1, 7).withColumn("v", F.col("id") % 3)
    pages = [r["id"] for n in range(5) for r in table_page(df, [F.col("v").desc()], n, 13).collect()]
    assert sorted(pages) == list(range(60))


@pytest.mark.parametrize("desc", [False, True])
def test_sought_pages_are_slices_of_the_sorted_table(spark, monkeypatch, desc):
    monkeypatch.setattr(ranking, "_NEAR", 5)
    monkeypatch.setattr(ranking, "_CUTS", 4)
    a = F.when(F.col("id") % 3 > 0, F.col("id") % 4)
    b = F.when(F.col("id") % 5 > 0, F.concat(F.lit("é'"), (F.col("id") % 7).cast("string")))
    df = spark.range(0, 600, 1, 5).select(a.alias("a"), b.alias("b"), (F.col("id") / 300).cast("int").alias("c"))
    every = [tuple(r) for r in df.orderBy(nulls_last("a", desc), nulls_last("b"), "c").collect()]
    for page in (0, 3, 17, 29, 38, 39, 46):
        got = [tuple(r) for r in seek_page(df, [("a", desc)], page, 13).collect()]
        assert sorted(got, key=every.index) == every[page * 13 : page * 13 + 13]


@pytest.mark.parametrize("kind", ["double", "decimal(9,3)", "date", "timestamp", "timestamp_ntz", "boolean", "string"])
def test_sought_pages_of_every_type(spark, monkeypatch, kind):
    monkeypatch.setattr(ranking, "_NEAR", 3)
    value = {
        "double": F.col("id") / 7, "decimal(9,3)": F.col("id") / 7, "boolean": F.col("id") % 2 == 0, "string": F.sha1(F.col("id").cast("string")),
    }.get(kind, F.timestamp_micros(F.col("id") * 40_000_000_001))
    df = spark.range(90).select(value.cast(kind).alias("v"), "id").unionByName(spark.sql(f"SELECT CAST(NULL AS {kind}) v, 100L id"))
    if kind == "double":
        df = df.unionByName(spark.sql("SELECT double('NaN') v, 101L id UNION ALL SELECT double('-Infinity'), 102L"))
    every = [r["id"] for r in df.orderBy(nulls_last("v", True), "id").collect()]
    for page in (0, 5, 9, 50):
        assert [r["id"] for r in seek_page(df, [("v", True)], page, 10).collect()] == every[page * 10 : page * 10 + 10]


def test_pages_of_an_empty_table(spark):
    assert seek_page(spark.range(0), [("id", False)], 4000, 10).collect() == []


def test_a_sought_page_neither_sorts_nor_writes_the_table(spark, tmp_path):
    spark.range(0, 40_000, 1, 4).select((F.col("id") * 7919 % 40_009).alias("v"), "id").write.parquet(str(tmp_path / "t"))
    page = seek_page(spark.read.parquet(str(tmp_path / "t")), [("v", False)], 3000, 10)
    text = plan(page)
    assert "TakeOrderedAndProject" in text and "Exchange" not in text and "Scan ExistingRDD" not in text
    assert "GreaterThanOrEqual(v," in text or "GreaterThan(v," in text


def test_ranks_of_many_values_lie_in_many_tasks(spark, monkeypatch):
    found = []
    real = ranking.settle
    monkeypatch.setattr(ranking, "settle", lambda df, label: found.append((label, real(df, label))) or found[-1][1])
    df = spark.range(0, 1_000_000, 1, 8).select("id", F.when(F.col("id") % 20 > 0, "big").otherwise(F.col("id").cast("string")).alias("p"), (F.col("id") * 7919 % 1_000_003).alias("v"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        ranked = rank_within(df, {"r": ["p"]}, [("v", True)])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    ranges = dict(found)["ranges"]
    sizes = [r["count"] for r in ranges.filter("p = 'big'").groupBy("__range").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 400_000
    expected = df.withColumn("r", F.rank().over(Window.partitionBy("p").orderBy(by("v", desc=True))).cast("bigint"))
    difference = ranked.join(expected, ["id", "p", "v", "r"], "anti").count()
    assert difference == 0 and ranked.count() == 1_000_000


@pytest.mark.parametrize(
    "column, text, expected",
    [
        ("n", "> 2.5", [3, 4]), ("n", "<2.5", [1, 2]), ("n", "= 2.5", []), ("n", "ne 2.5", [1, 2, 3, 4, None]), ("n", "2", [2]),
        ("n", "!= 2", [1, 3, 4, None]), ("n", "< 1e30", [1, 2, 3, 4]), ("n", "> 1e30", []), ("n", ">= -1e30", [1, 2, 3, 4]), ("n", "<= -1e30", []),
        ("n", "contains 3", [3]), ("d", ">= 1.005", [2, 3, 4]), ("d", "= 1.01", [2]), ("d", "< 99999999", [1, 2, 3, 4]), ("x", "> 1.5", [3, 4]),
        ("s", "lph", [1]), ("s", "contains a", [1, 2, 3]), ("s", "icontains A", [1, 2, 3, 4]), ("s", "= beta", [2]), ("s", "i= BETA", [2]),
        ("s", 's= "BETA"', []), ("s", "equal", []), ("s", "> alpha", [2, 3]), ("s", "= ", []),
        ("t", "2024-02", [2, 3]), ("t", "datestartswith 2024", [1, 2, 3]), ("t", "> 2024-02-29 10:00", [3, 4]), ("t", "datestartswith 2024-02-29 10", [2]),
        ("y", "= 2024-02-29", [2, 3]), ("y", "< 2024-02-29 05:00", [1, 2, 3]), ("y", "2024-01", [1]), ("b", "true", [1, 3]), ("b", "!= true", [2, 4, None]),
        ("t", "9999", []),
    ],
)
def test_filter_texts(values, column, text, expected):
    moments = ["2024-01-31 23:59:59", "2024-02-29 10:00:00", "2024-02-29 11:30:00", "2025-01-01 00:00:00", None]
    raw = [(1, 1.0, "alpha"), (2, 1.01, "beta"), (3, 2.0, "gamma"), (4, 3.5, "A"), (None, None, None)]
    df = values("n bigint, x double, s string, t string", *[(n, x, s, t) for (n, x, s), t in zip(raw, moments)])
    df = df.select("n", "x", "s", F.col("x").cast("decimal(6,2)").alias("d"), F.col("t").cast("timestamp_ntz").alias("t"),
                   F.col("t").cast("timestamp").cast("date").alias("y"), (F.col("n") % 2 == 1).alias("b"))
    got = [r["n"] for r in df.filter(column_filter(df, column, text)).collect()]
    assert sorted(got, key=lambda v: (v is None, v)) == expected


@pytest.mark.parametrize("column, text", [("n", "> abc"), ("n", "= NaN"), ("n", "datestartswith 2"), ("t", "> soon"), ("t", "2024-13"), ("b", "> true")])
def test_filter_texts_that_do_not_fit(spark, column, text):
    df = spark.sql("SELECT 1L n, TIMESTAMP '2024-01-01' t, true b")
    with pytest.raises(ValueError):
        column_filter(df, column, text)


def test_blank_filters_and_the_scan(spark, tmp_path):
    spark.range(10).select(F.col("id").cast("int").alias("a.b"), "id").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert column_filters(df, {"a.b": None, "id": "  "}) == []
    for condition in column_filters(df, {"a.b": "> 3.5", "id": "<= 8"}):
        df = df.filter(condition)
    assert "GreaterThan(`a.b`,3)" in plan(df) and "LessThanOrEqual(id,8)" in plan(df) and df.count() == 5


def test_leaders(values):
    df = values(
        "n string, role string, era double, k int",
        ("a", "S", None, 9), ("b", "S", 2.5, 3), ("c", "S", 2.5, 9), ("d", "R", 1.0, 1),
    )
    boards = [
        Board("era", "era", desc=False, where=F.col("role") == "S"), Board("k", "k"),
        Board("none", "k", where=F.col("role") == "Z"),
    ]
    assert listed(leaders(df, boards, ["n"], [F.col("n")])) == [("era", "b", 2.5), ("k", "a", 9.0)]


def test_top_n_drops_missing(values):
    df = values("id int, v double", (1, None), (2, 3.0), (3, 1.0))
    assert [r["id"] for r in top_n(df, [F.col("v").asc()], 5, "v").collect()] == [3, 2]


def test_lookback(values):
    import datetime

    day = lambda d: datetime.date(2026, 4, d)
    df = values(
        "g int, day date, s string",
        (1, day(10), "Scheduled"), (2, day(8), "Final"), (3, day(8), "Final"), (4, day(5), "Final"), (5, day(2), "Final"),
    )
    anchor = lambda d: F.lit(f"2026-04-{d:02d}").cast("date")
    done = F.col("s") == "Final"
    assert listed(latest_day_with(df, "day", done, anchor(10)), "g") == [(2,), (3,)]
    assert listed(latest_day_with(df, "day", done, anchor(16)), "g") == []


def test_message_rate_and_backlog(spark, values):
    df = values("ts string, topic string, id int", ("2026-04-01 00:00:10", "a", 1), ("2026-04-01 00:04:59", "a", 2), ("2026-04-01 00:05:00", "a", 3))
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    tumbling = monitor.message_rate(df)
    assert listed(tumbling, F.date_format("window_start", "HH:mm"), "n") == [("00:00", 2), ("00:05", 1)]
    assert monitor.message_rate(df, slide=60).agg(F.sum("n")).first()[0] == 15
    assert listed(monitor.backlog(df, df.filter("id = 1"), "id", "topic")) == [("a", 2)]


def test_stream_lag():
    progress = {"sources": [{"endOffset": {"t": {"0": 5}}, "latestOffset": '{"t": {"0": 9, "1": 2}}'}, {"endOffset": 3}]}
    assert monitor.stream_lag(progress) == [("t", 0, 4), ("t", 1, 2)]


def test_freshness(values):
    import datetime

    df = values("t string", "2026-04-08T20:00:00Z")
    now = datetime.datetime(2026, 4, 8, 20)
    status = lambda hours, d=df: quality.freshness(d, "t", now + datetime.timedelta(hours=hours)).first()["status"]
    assert [status(h) for h in (23, 25, 49)] == ["pass", "warn", "error"]
    assert status(1, df.limit(0)) == "error"


def test_volume(spark):
    tables = {"teams": spark.range(24), "events": spark.range(50)}
    report = quality.volume(tables, {"teams": 25, "events": 50})
    assert listed(report, "table_name", "status") == [("events", "ok"), ("teams", "FAIL")]
    with pytest.raises(quality.CheckFailed, match="teams"):
        quality.require(report, F.col("status") == "FAIL", F.col("table_name"), "Volume checks failed:")


def test_input_report(values):
    df = values("a int, b int", (1, None), (2, 5))
    line = quality.input_report(df, "x", ["a", "b"]).first()
    assert (line["n_rows"], line["n_columns"], line["status"], line["null_pct"]) == (2, 2, "nulls", {"b": 50.0})
    assert quality.input_report(df.limit(0), "x", ["a"]).first()["status"] == "empty"
    with pytest.raises(quality.CheckFailed, match="missing expected columns"):
        quality.input_report(df, "x", ["c"])


def test_schema_changes(values):
    old, new = values("a int, b string", (1, "x")).schema, values("a bigint, c int", (1, 2)).schema
    assert quality.schema_changes(old, new) == [("a", "retyped", "int -> bigint"), ("b", "removed", "string"), ("c", "added", "int")]


def test_scratch_is_cleared(spark):
    from pathlib import Path

    from dugout.session import clear_scratch, scratch_home, settle

    kept = settle(spark.range(3))
    assert kept.count() == 3
    home = Path(scratch_home(spark))
    other = home.parent / "dugout-other"
    other.mkdir()
    clear_scratch(spark)
    assert not home.exists() and other.exists()
    assert settle(spark.range(2)).count() == 2


def test_rank_counts_along_sorted_ranges(spark, monkeypatch):
    found = []
    real = ranking.settle
    monkeypatch.setattr(ranking, "settle", lambda df, label: found.append((label, plan(df), real(df, label))) or found[-1][2])
    # Partitions that are missing, not a number, shared by many rows or by one, over several Arrow batches.
    part = F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 7 == 0, float("nan")).when(F.col("id") % 3 == 0, 1.5).otherwise((F.col("id") % 9000).cast("double"))
    df = spark.range(0, 60_000, 1, 8).select("id", part.alias("p"), (F.col("id") * 7919 % 60_013).alias("v"))
    ranked = rank_within(df, {"r": ["p"], "all": []}, [("v", True)])
    expected = df.select("id", F.rank().over(Window.partitionBy("p").orderBy(by("v", desc=True))).cast("bigint").alias("r"))
    expected = expected.join(df.select("id", F.rank().over(Window.orderBy(by("v", desc=True))).cast("bigint").alias("all")), "id")
    assert ranked.count() == 60_000
    assert ranked.select("id", "r", "all").exceptAll(expected.select("id", "r", "all")).count() == 0
    settled = {label: text for label, text, _ in found}
    assert "rangepartitioning" in settled["ranges"] and "MapInArrow" in settled["ranges"]
