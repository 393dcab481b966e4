"""Typed parsing of feed values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# A failed try_cast costs an exception per value, so text is matched before it is cast.
_DECIMAL = r"^([0-9]+\.?[0-9]*|\.[0-9]+)\z"
_INTEGER = r"^\s*[+-]?[0-9]+\s*\z"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def whole(value: Column | str, kind: str = "int") -> Column:
    """A landed number as ``int`` or ``bigint``; NaN counts as missing, bad text is an error.

    Feeds carry nullable integers as ``5.0`` or ``NaN``, so they land as double.
    """
    number = _col(value).cast("double")
    return F.rint(F.nanvl(number, F.lit(None).cast("double"))).cast(kind)


def wall_time(value: Column | str) -> Column:
    """Timestamp without zone; a trailing offset in the text is dropped."""
    return _col(value).cast("timestamp_ntz")


def guarded_decimal(value: Column | str, precision: int, scale: int) -> Column:
    """Digits-and-dots text as decimal; anything else, or an overflow, is NULL."""
    text = _col(value).cast("string")
    return F.when(text.rlike(_DECIMAL), text.try_cast(f"decimal({precision},{scale})"))


def win_share(value: Column | str) -> Column:
    """``".667"`` or ``"1.000"`` as decimal(4,3); unreadable text is NULL."""
    return guarded_decimal(F.trim(_col(value).cast("string")), 4, 3)


def composite_key(*parts: Column | str, sep: str = "_") -> Column:
    """Parts joined by ``sep``; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(sep))
        pieces.append(_col(part).cast("string"))
    return F.concat(*pieces)


def innings(value: Column | str) -> Column:
    """Innings text in thirds notation as a number: ``62.1`` is 62 1/3, ``62.2`` is 62 2/3.

    Missing or unreadable text counts as 0. Parts beyond the second are ignored.
    """
    shown = _col(value).cast("string")

    def number(part: Column) -> Column:
        return F.when(part.rlike(_INTEGER), part.try_cast("int"))

    full = number(F.substring_index(shown, ".", 1))
    outs = number(F.substring_index(F.substring_index(shown, ".", 2), ".", -1))
    thirds = F.when(F.contains(shown, F.lit(".")), outs / F.lit(3)).otherwise(F.lit(0.0))
    return F.coalesce(full + thirds, F.lit(0.0))


def or_default(value: Column | str, default) -> Column:
    """The value, or ``default`` where it is missing."""
    return F.coalesce(_col(value), F.lit(default))
