"""Exact membership of numbered keys from short bitmaps per group.

A key is a group (a game) and a whole number in it (a play). The numbers that are known of a
group lie in bitmaps of 64 numbers, eight bytes at most and only as long as the greatest number
asks for, so an increment reads a few bytes for a group where it would read all its rows. They
are whole numbers while they are aggregated, so a group never takes more memory than that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BUCKET, BITS = "bucket", "bits"
_AT = "__at"


def _place(number: Column) -> tuple[Column, Column]:
    """Bucket of a number, 1 being that of 0, and its bit there."""
    return F.shiftright(number, 6) + 1, number.bitwiseAND(F.lit(63)).cast("int")


def _packed(bits: Column) -> Column:
    """The bytes of a bitmap, the highest first, without empty ones before them."""
    return F.unhex(F.hex(bits))


def seen_bitmaps(rows: DataFrame, group: str, number: str, keep: Sequence[str] = ()) -> DataFrame:
    """``group``, ``bucket`` and ``bits`` of the numbers that occur; rows without either go.

    ``keep`` are columns that depend on the group. Tasks send one bitmap per bucket, so
    repeated keys and groups with many rows cost nothing more.
    """
    bucket, at = _place(F.col(number).cast("long"))
    placed = rows.filter(F.col(group).isNotNull() & F.col(number).isNotNull())
    placed = placed.select(group, *keep, bucket.alias(BUCKET), at.alias(_AT))
    mark = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(_AT))
    made = placed.groupBy(group, *keep, BUCKET).agg(F.bit_or(mark).alias(BITS))
    return made.withColumn(BITS, _packed(F.col(BITS)))


def merge_bitmaps(bitmaps: DataFrame, group: str, keep: Sequence[str] = ()) -> DataFrame:
    """One bitmap per group and bucket from those of many batches."""
    whole = F.conv(F.hex(BITS), 16, -10).cast("long")  # the highest bit is the sign
    made = bitmaps.groupBy(group, *keep, BUCKET).agg(F.bit_or(whole).alias(BITS))
    return made.withColumn(BITS, _packed(F.col(BITS)))


def keep_unmarked(new: DataFrame, bitmaps: DataFrame, group: str, number: str) -> DataFrame:
    """Rows of ``new`` whose group and number no bitmap has; rows without either go.

    ``bitmaps`` has one row per group and bucket, so the join keeps the number of rows, and
    a group with many new rows is split by the adaptive skew join. They grow with what is
    stored and are small in files only, so they are never broadcast.
    """
    bucket, at = _place(F.col(number).cast("long"))
    fine = new.filter(F.col(group).isNotNull() & F.col(number).isNotNull())
    placed = fine.withColumns({BUCKET: bucket, _AT: at})
    met = placed.join(bitmaps.select(group, BUCKET, BITS).hint("merge"), [group, BUCKET], "left")
    held = F.coalesce(F.conv(F.hex(BITS), 16, -10).cast("long"), F.lit(0))
    bit = F.call_function("shiftright", held, F.col(_AT)).bitwiseAND(F.lit(1))
    return met.filter(bit == 0).select(*new.columns)
