from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dugout.functions import parse, rates, text
from dugout.functions.lookups import DIVISIONS, label_or_code, park_factor


def apply(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_whole_reads_floats_and_nan(values):
    df = values("v double", 5.0, float("nan"), None)
    assert apply(df, parse.whole("v")) == [5, None, None]


def test_whole_rejects_text(values):
    with pytest.raises(PySparkException):
        values("v string", "abc").select(parse.whole("v")).collect()


def test_guarded_decimal(values):
    df = values("v string", ".310", "1.2345", "-.--", ".", "1.2.3", "100.0", "-1", "1.2\n", "", None)
    expected = [Decimal("0.310"), Decimal("1.235")] + [None] * 8
    assert apply(df, parse.guarded_decimal("v", 5, 3)) == expected


def test_win_share(values):
    df = values("v string", "1.000", ".000", ".667", ".---", None)
    expected = [Decimal("1.000"), Decimal("0.000"), Decimal("0.667"), None, None]
    assert apply(df, parse.win_share("v")) == expected


def test_innings(values):
    df = values("v string", "62.1", "62.2", "62", "", None, "62.", ".1", "x", "62.5", " 7 ", "5.1.9", "3.x")
    got = [round(v, 3) for v in apply(df, parse.innings("v"))]
    assert got == [62.333, 62.667, 62.0, 0, 0, 0, 0, 0, 63.667, 7.0, 5.333, 0]


def test_composite_key_is_null_with_a_missing_part(values):
    df = values("a bigint, b int", (7, 1), (7, None))
    assert apply(df, parse.composite_key("a", "b")) == ["7_1", None]


def test_wall_time_drops_the_offset(values):
    got = apply(values("v string", "2026-04-08T20:01:30.500Z"), parse.wall_time("v").cast("string"))
    assert got == ["2026-04-08 20:01:30.5"]


def test_rate_or(values):
    df = values("h int, b double", (10, 430.0), (3, 0.0), (None, 5.0))
    got = apply(df, rates.rate_or(F.col("h"), F.col("b"), 0.034))
    assert got == [10 / 430.0, 0.034, 0.034]


def test_shrunk_rate(values):
    got = apply(values("h int, n int", (2, 22)), rates.shrunk_rate(F.col("h"), F.col("n"), 0.034, 200))
    assert got[0] == pytest.approx(8.8 / 222)


def test_cap_keeps_null_and_nan(values):
    got = apply(values("p double", 0.3, 0.1, None, float("nan")), rates.capped(F.col("p"), 0.25))
    assert got[:3] == [0.25, 0.1, None] and got[3] != got[3]


def test_role(values):
    df = values("g int, s int", (10, 5), (10, 4), (0, 0))
    assert apply(df, rates.role(F.col("g"), F.col("s"))) == ["Starter", "Reliever", "Reliever"]


def test_text(values):
    df = values("a int, h int, p double, v string", (2, None, 0.22545, "Coors  Field "))
    assert apply(df, text.score(F.col("a"), F.col("h"))) == ["2 – 0"]
    assert apply(df, text.percent(F.col("p"))) == ["22.5%"]
    assert apply(df, text.percent(F.lit(None).cast("double"))) == [None]
    assert apply(df, text.last_word(F.col("v"))) == ["Field"]
    assert apply(df, text.with_unit(F.col("a"), "runs")) == ["2 runs"]
    assert apply(df, text.matchup(F.lit("A"), F.lit("B"), F.lit("Final"))) == ["A @ B [Final]"]


def test_lookups(values):
    df = values("id bigint, venue string", (203, "Coors Field"), (999, "Nowhere"), (None, None))
    assert apply(df, label_or_code(F.col("id"), DIVISIONS)) == ["NL West", "999", None]
    assert apply(df, park_factor(F.col("venue"))) == [1.35, 1.0, 1.0]
