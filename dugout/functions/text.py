"""Display text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fixed(value: Column, digits: int) -> Column:
    """Number with a fixed count of decimals; NULL stays NULL."""
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f", value.cast("double")))


def percent(value: Column, digits: int = 1) -> Column:
    """Share as percent text, ``0.1234`` as ``12.3%``."""
    return F.concat(fixed(value * 100, digits), F.lit("%"))


def with_unit(value: Column, unit: str) -> Column:
    """Whole number followed by a unit, ``7 runs``."""
    return F.concat(value.cast("bigint").cast("string"), F.lit(f" {unit}"))


def record(wins: Column, losses: Column) -> Column:
    """``W-L`` text."""
    return F.concat(wins.cast("string"), F.lit("-"), losses.cast("string"))


def day(value: Column) -> Column:
    """``yyyy-MM-dd`` text."""
    return F.date_format(value, "yyyy-MM-dd")


def score(away: Column, home: Column) -> Column:
    """``away – home`` text, a missing score counts as 0."""
    return F.concat(
        F.coalesce(away.cast("bigint"), F.lit(0)).cast("string"),
        F.lit(" – "),
        F.coalesce(home.cast("bigint"), F.lit(0)).cast("string"),
    )


def matchup(away: Column, home: Column, status: Column | None = None) -> Column:
    """``away @ home``, with ``[status]`` behind it if one is given."""
    pair = F.concat(away, F.lit(" @ "), home)
    return pair if status is None else F.concat(pair, F.lit(" ["), status, F.lit("]"))


def last_word(value: Column) -> Column:
    """The last blank-separated word."""
    return F.regexp_extract(value, r"(\S+)\s*\z", 1)
