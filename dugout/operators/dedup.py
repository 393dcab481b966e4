"""One row per key, and keys not seen before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import settle

_PICK = "__pick"


def columns_as_order(df: DataFrame, skip: Sequence[str] = ()) -> list[Column]:
    """All columns in schema order, to make a sort total up to identical rows."""
    return [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in skip]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    The ``row_number = 1`` filter lets Spark put a group limit in front of the shuffle:
    each map task sends at most one row per key, so a key that holds most of the table
    costs no more than any other.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_PICK, F.row_number().over(window)).filter(F.col(_PICK) == 1).drop(_PICK)


def keep_unseen(
    new: DataFrame, known: DataFrame, key: str, prune_by: str | None = None
) -> DataFrame:
    """Rows of ``new`` whose non-NULL key does not occur in ``known``.

    NULL keys are dropped on both sides: a NULL in ``known`` excludes nothing, and a row
    without a key cannot be recognised later.

    ``prune_by`` names a column that depends on the key and partitions ``known``. The new
    rows are then written first, and only the partitions that they touch are read: those
    outside their range never, those within it by Spark's dynamic partition pruning. Stored
    rows without a ``prune_by`` value are always compared.
    """
    keyed = new.filter(F.col(key).isNotNull())
    seen = known.filter(F.col(key).isNotNull())
    if prune_by:
        keyed = settle(keyed, "keyed")
        least, most = keyed.agg(F.min(prune_by), F.max(prune_by)).first()  # one row
        near = F.col(prune_by).between(F.lit(least), F.lit(most))
        touched = keyed.filter(near).select(prune_by).distinct()
        inside = seen.filter(near).join(touched, prune_by, "left_semi")
        seen = inside.select(key).unionByName(seen.filter(F.col(prune_by).isNull()).select(key))
    # Distinct before the shuffle: many stored copies of one key travel as one.
    return keyed.join(seen.select(key).distinct(), key, "left_anti")


def latest_run(df: DataFrame, run: str = "run_id") -> DataFrame:
    """The rows of the greatest run id: the snapshot a replace would have left.

    The greatest id is one row, so it is broadcast and prunes a table partitioned by it.
    """
    newest = df.agg(F.max(run).alias(run)).filter(F.col(run).isNotNull())
    return df.join(F.broadcast(newest), run, "left_semi")


def latest_run_per(df: DataFrame, group: str, run: str = "run_id") -> DataFrame:
    """As ``latest_run`` within each group (topic) that occurs; rows without a group go."""
    newest = df.groupBy(group).agg(F.max(run).alias(run))
    return df.join(newest, [group, run], "left_semi")
