"""Proof queries: the same helpers on a star schema, next to equivalent SQL.

Customers stand in for teams and batters, suppliers for pitchers, orders for games,
lineitems for plays, events for messages.
"""

from . import (  # noqa: F401
    cases_checks, cases_columns, cases_feeds, cases_models, cases_rank, cases_series, cases_streams, cases_tables,
)
from .registry import CASES

__all__ = ["CASES"]
