"""Filter texts of table columns (``> 10``, ``contains x``, ``= y``) as conditions.

A text is an operator and a value, or a value alone. A value alone means ``=`` for numbers and
booleans, ``contains`` for text and ``datestartswith`` for dates. Values may be quoted. ``i``
before an operator compares texts without regard to case (``icontains``, ``i=``), ``s`` with it,
which is the default.

The value is turned into the column's own type while the condition is built, so that the column
is never cast and the condition reaches the file reader.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import datetime, timedelta
from decimal import ROUND_FLOOR, Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType, DataType, DateType, DecimalType, FractionalType, IntegralType, NumericType, StringType,
    TimestampNTZType, TimestampType,
)

# Operators by their spellings.
_SPELLINGS = {
    "=": "=", "eq": "=", "!=": "!=", "ne": "!=", "<": "<", "lt": "<", "<=": "<=", "le": "<=",
    ">": ">", "gt": ">", ">=": ">=", "ge": ">=", "contains": "contains", "datestartswith": "datestartswith",
}
_SIGN = re.compile(r"([si]?)(<=|>=|!=|=|<|>)\s*(.*)\Z", re.S)
_WORD = re.compile(r"([si]?)(eq|ne|le|lt|ge|gt|contains|datestartswith)(?:\s+(.*))?\Z", re.S)
_DAY = re.compile(r"(\d{4})(?:-(\d\d)(?:-(\d\d)(?:[ T](\d\d)(?::(\d\d)(?::(\d\d)(?:\.(\d{1,6}))?)?)?)?)?)?\Z")
_DATES = (DateType, TimestampType, TimestampNTZType)
_INTEGER_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def _unquoted(value: str) -> str:
    quoted = len(value) > 1 and value[0] == value[-1] and value[0] in "\"'`"
    return value[1:-1] if quoted else value


def _parts(text: str, kind: DataType) -> tuple[str, str, bool]:
    """Operator, value, and whether case is left out."""
    found = _SIGN.match(text) or _WORD.match(text)
    if found:
        case, sign, value = found.groups()
        return _SPELLINGS[sign], _unquoted((value or "").strip()), case == "i"
    if isinstance(kind, _DATES):
        return "datestartswith", _unquoted(text), False
    return "=" if isinstance(kind, (NumericType, BooleanType)) else "contains", _unquoted(text), False


def _compared(column: Column, sign: str, value: Column) -> Column:
    match sign:
        case "=":
            return column == value
        case "!=":  # a missing cell isn't the value
            return column.isNull() | (column != value)
        case "<":
            return column < value
        case "<=":
            return column <= value
        case ">":
            return column > value
        case _:
            return column >= value


def _none(column: Column) -> Column:
    """A condition that no row meets."""
    return column.isNull() & column.isNotNull()


def _number(column: Column, kind: DataType, sign: str, value: str) -> Column:
    try:
        number = Decimal(value)
        if not number.is_finite():
            raise InvalidOperation
    except InvalidOperation:
        raise ValueError(f"{value!r} is not a number") from None
    if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType):
        return _compared(column, sign, F.lit(float(number)).cast(kind))
    # Exact types: a value between two steps of the column moves down to the lower one.
    if isinstance(kind, IntegralType):
        step, largest = Decimal(1), Decimal(2 ** (_INTEGER_BITS[kind.simpleString()] - 1) - 1)
        smallest = -largest - 1
    else:
        step = Decimal(1).scaleb(-kind.scale)
        largest = Decimal(10**kind.precision - 1).scaleb(-kind.scale)
        smallest = -largest
    above, below = number > largest, number < smallest
    exact = False
    if not above and not below:
        low = Decimal(int((number / step).to_integral_value(ROUND_FLOOR))) * step
        exact = low == number
    if exact:
        return _compared(column, sign, F.lit(low).cast(kind))
    if sign in ("=", "!="):
        return _none(column) if sign == "=" else F.lit(True)
    if above or below:
        return column.isNotNull() if above == (sign in ("<", "<=")) else _none(column)
    return _compared(column, "<=" if sign in ("<", "<=") else ">", F.lit(low).cast(kind))


def _period(value: str) -> tuple[datetime, datetime | None]:
    """First moment of a year, month, day, hour, minute or second, and the first one behind it."""
    found = _DAY.match(value)
    if not found:
        raise ValueError(f"{value!r} is not a date")
    year, month, day, hour, minute, second, part = found.groups()
    start = datetime(
        int(year), int(month or 1), int(day or 1), int(hour or 0), int(minute or 0), int(second or 0),
        int((part or "").ljust(6, "0")),
    )
    try:
        if month is None:
            return start, start.replace(year=start.year + 1)
        if day is None:
            return start, (start + timedelta(days=31)).replace(day=1)
        steps = [("microseconds", part), ("seconds", second), ("minutes", minute), ("hours", hour), ("days", day)]
        unit = next(name for name, given in steps if given is not None)
        size = 10 ** (6 - len(part)) if unit == "microseconds" else 1
        return start, start + timedelta(**{unit: size})
    except (ValueError, OverflowError):  # behind the last year
        return start, None


def _date(column: Column, kind: DataType, sign: str, value: str) -> Column:
    def moment(at: datetime) -> Column:
        return F.lit(at.isoformat(" ")).cast(kind)

    start, end = _period(value)
    if sign == "datestartswith":
        if isinstance(kind, DateType) and (start.hour or start.minute or start.second or start.microsecond):
            return _none(column)
        if isinstance(kind, DateType) and end is not None and end - start < timedelta(days=1):
            end = start + timedelta(days=1)
        return column >= moment(start) if end is None else (column >= moment(start)) & (column < moment(end))
    if isinstance(kind, DateType) and start != datetime(start.year, start.month, start.day):
        if sign in ("=", "!="):
            return _none(column) if sign == "=" else F.lit(True)
        sign = "<=" if sign in ("<", "<=") else ">"
    return _compared(column, sign, moment(start))


def _text(column: Column, sign: str, value: str, any_case: bool) -> Column:
    shown, wanted = (F.lower(column), F.lower(F.lit(value))) if any_case else (column, F.lit(value))
    if sign == "contains":
        return F.contains(shown, wanted)
    if sign == "datestartswith":
        return F.startswith(shown, wanted)
    return _compared(shown, sign, wanted)


def column_filter(df: DataFrame, name: str, text: str | None) -> Column | None:
    """The condition that a filter text puts on a column; ``None`` for a blank text.

    Missing cells meet no condition but ``!=``. A value that the column's type can't be
    compared with is an error.
    """
    text = (text or "").strip()
    if not text:
        return None
    column, kind = F.col(f"`{name.replace('`', '``')}`"), df.schema[name].dataType
    sign, value, any_case = _parts(text, kind)
    if sign == "contains" and not isinstance(kind, StringType):
        return _text(column.cast("string"), sign, value, any_case)
    if isinstance(kind, StringType):
        return _text(column, sign, value, any_case)
    if isinstance(kind, NumericType) and sign != "datestartswith":
        return _number(column, kind, sign, value)
    if isinstance(kind, _DATES):
        return _date(column, kind, sign, value)
    if isinstance(kind, BooleanType) and sign in ("=", "!=") and value.lower() in ("true", "false"):
        return _compared(column, sign, F.lit(value.lower() == "true"))
    raise ValueError(f"{text!r} does not fit column {name!r} of type {kind.simpleString()}")


def column_filters(df: DataFrame, texts: Mapping[str, str | None]) -> list[Column]:
    """The conditions of a table's filter row, by column; blank texts filter nothing."""
    found = [column_filter(df, name, text) for name, text in texts.items()]
    return [condition for condition in found if condition is not None]
