"""Rates, shares and probabilities."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the home-run model.
LEAGUE_HR_RATE = 0.034
BATTERS_PER_INNING = 4.3
MIN_PLATE_APPEARANCES = 20
MAX_HR_PROBABILITY = 0.25
REGRESSION_PLATE_APPEARANCES = 200


def rate_or(numerator: Column, denominator: Column, fallback: float) -> Column:
    """The quotient, or ``fallback`` where it has no value (NULL part or zero denominator)."""
    return F.coalesce(F.try_divide(numerator, F.nullif(denominator, F.lit(0))), F.lit(fallback))


def shrunk_rate(hits: Column, trials: Column, mean: float, weight: float) -> Column:
    """Rate pulled towards ``mean`` as if ``weight`` extra trials had run at that rate."""
    return (hits + F.lit(float(mean) * weight)) / (trials + F.lit(weight))


def capped(value: Column, cap: float) -> Column:
    """At most ``cap``; NULL and NaN stay what they are."""
    return F.when((value > F.lit(cap)) & ~F.isnan(value), F.lit(cap)).otherwise(value)


def role(games: Column, starts: Column, share: float = 0.5) -> Column:
    """``Starter`` from the given share of games started on, else ``Reliever``."""
    return F.when((games > 0) & (F.try_divide(starts, games) >= share), "Starter").otherwise(
        "Reliever"
    )
