"""Fixed code tables and lookups into them.

The tables are constants of the code, so a lookup is a literal map inside the row's
projection: no join, no shuffle, nothing that grows with the data.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, functions as F

# Division and league ids of the feeds.
DIVISIONS = {
    200: "AL West", 201: "AL East", 202: "AL Central",
    203: "NL West", 204: "NL East", 205: "NL Central",
}
LEAGUES = {103: "American League", 104: "National League"}

# Home-run factor by ballpark, 1.0 is the league average.
PARK_FACTORS = {
    "Coors Field": 1.35,
    "Great American Ball Park": 1.22,
    "Guaranteed Rate Field": 1.18,
    "Citizens Bank Park": 1.14,
    "Fenway Park": 1.10,
    "Yankee Stadium": 1.08,
    "Globe Life Field": 1.06,
    "Truist Park": 1.04,
    "Chase Field": 1.02,
    "Wrigley Field": 1.00,
    "American Family Field": 1.00,
    "Progressive Field": 0.99,
    "Minute Maid Park": 0.99,
    "Angel Stadium": 0.98,
    "Target Field": 0.97,
    "Comerica Park": 0.97,
    "Camden Yards": 0.96,
    "Kauffman Stadium": 0.94,
    "Busch Stadium": 0.92,
    "loanDepot park": 0.90,
    "PNC Park": 0.89,
    "Nationals Park": 0.89,
    "T-Mobile Park": 0.88,
    "Oracle Park": 0.86,
    "Petco Park": 0.83,
}

# Game states of the schedule feed.
FINISHED = ("Final", "Game Over")
LIVE = ("In Progress", "Manager Challenge")
STATUS_PRIORITY = {"Final": 1, "Game Over": 1, "In Progress": 2, "Pre-Game": 3, "Warmup": 3}
OTHER_STATUS_PRIORITY = 4


def lookup(code: Column, table: Mapping) -> Column:
    """The entry for ``code``, NULL if there is none."""
    entries = F.create_map(*[F.lit(item) for item in chain.from_iterable(table.items())])
    return F.try_element_at(entries, code)


def label_or_code(code: Column, table: Mapping) -> Column:
    """The label, or the code as text where no label is known."""
    return F.coalesce(lookup(code, table), code.cast("string"))


def park_factor(venue: Column, table: Mapping[str, float] = PARK_FACTORS) -> Column:
    """Home-run factor of a ballpark; 1.0 where none is known."""
    return F.coalesce(lookup(venue, table), F.lit(1.0))


def priority(value: Column, table: Mapping[str, int], other: int) -> Column:
    """Sort value of a state: ``table[value]``, ``other`` for the rest and for NULL."""
    return F.coalesce(lookup(value, table), F.lit(other))
