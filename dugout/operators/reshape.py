"""Rows to more rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def sides(df: DataFrame, *variants: Mapping[str, Column]) -> DataFrame:
    """One output row per input row and variant; all variants name the same columns."""
    structs = [F.struct(*[c.alias(n) for n, c in variant.items()]) for variant in variants]
    return df.select(F.explode(F.array(*structs)).alias("side")).select("side.*")


def union_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    """Several feeds of one table under each other, matched by column name."""
    first, *rest = feeds
    for feed in rest:
        first = first.unionByName(feed)
    return first


def latest_day_with(
    df: DataFrame, day: str, qualifies: Column, anchor: Column, back: int = 7
) -> DataFrame:
    """Qualifying rows of the newest day in ``[anchor - back, anchor]`` that has any.

    The range filter reaches the scan; the newest day is a single row and is broadcast.
    """
    nearby = df.filter(
        (F.col(day) >= F.date_sub(anchor, back)) & (F.col(day) <= anchor) & qualifies
    )
    newest = nearby.agg(F.max(day).alias(day))
    return nearby.join(F.broadcast(newest), day, "left_semi")
