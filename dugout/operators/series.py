"""Time series by key: the row before, the latest row of another series, rates of counters.

A window over a whole series would sort it in one task. Series are cut into chunks of time
instead: a chunk is one group, and what it has to know of the past is the last row of the chunks
before it, which is worked out on one line per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Seconds of a chunk.
CHUNK = 3600
_CHUNK, _HELD, _CARRY, _SIDE, _ROW, _LAST = "__chunk", "__held", "__carry", "__side", "__row", "__last"


def micros(time: str | Column) -> Column:
    """Microseconds since 1970."""
    return F.unix_micros((F.col(time) if isinstance(time, str) else time).cast("timestamp"))


def _chunk(time: str, seconds: int) -> Column:
    return F.floor(micros(time) / F.lit(seconds * 1_000_000)).alias(_CHUNK)


def _carried(rows: DataFrame, by: Sequence[str], last: Column) -> DataFrame:
    """For every chunk the last known value of the chunks before it."""
    chunks = rows.groupBy(*by, _CHUNK).agg(last.alias(_LAST))
    past = Window.partitionBy(*by).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return chunks.select(*by, _CHUNK, F.last(_LAST, ignorenulls=True).over(past).alias(_CARRY))


def _with_carry(rows: DataFrame, carried: DataFrame, by: Sequence[str]) -> DataFrame:
    same = [*by, _CHUNK]
    named = carried.select(_CARRY, *[F.col(c).alias(f"__of_{c}") for c in same])
    condition = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in same])
    return rows.join(named, condition, "left").select(*rows.columns, _CARRY)


def asof(
    left: DataFrame, right: DataFrame, by: Sequence[str], time: str, values: Sequence[str], chunk: int = CHUNK
) -> DataFrame:
    """Rows of ``left`` with the ``values`` of the newest row of ``right`` with the same ``by``
    at or before their time; NULL where there is none.

    Of right rows with the same time the one with the greatest values counts. Rows of
    ``right`` without a time are never found, rows of ``left`` without one find nothing.
    """
    single = right.filter(F.col(time).isNotNull()).groupBy(*by, time).agg(F.max(F.struct(*values)).alias(_HELD))
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias(_ROW)
    asked = left.select(*by, time, F.lit(1).alias(_SIDE), row)
    both = asked.unionByName(single.withColumn(_SIDE, F.lit(0)), allowMissingColumns=True)
    both = both.withColumn(_CHUNK, _chunk(time, chunk))
    known = F.when(F.col(_SIDE) == 0, F.col(time))
    joined = _with_carry(both, _carried(both, by, F.max_by(_HELD, known)), by)
    until = Window.partitionBy(*by, _CHUNK).orderBy(time, _SIDE).rowsBetween(Window.unboundedPreceding, 0)
    found = F.coalesce(F.last(_HELD, ignorenulls=True).over(until), F.col(_CARRY))
    held = F.when(F.col(time).isNotNull(), found).alias(_HELD)
    rows = joined.select(_SIDE, _ROW, held).filter(F.col(_SIDE) == 1)
    return rows.select(f"{_ROW}.*", *[F.col(f"{_HELD}.{v}").alias(v) for v in values])


def counter_increases(
    samples: DataFrame, by: Sequence[str], time: str = "ts", value: str = "total", chunk: int = CHUNK
) -> DataFrame:
    """``by``, ``since``, ``time`` and ``increase`` between neighbouring samples of each counter.

    A counter that is below the sample before has started anew, so its whole value is the
    increase. Of samples with the same time the greatest counts; samples without a time or a
    value are left out. The first sample of a counter increases nothing.
    """
    fine = samples.filter(F.col(time).isNotNull() & F.col(value).isNotNull())
    single = fine.groupBy(*by, time).agg(F.max(value).alias(value)).withColumn(_CHUNK, _chunk(time, chunk))
    single = single.withColumn(_HELD, F.struct(time, value))
    joined = _with_carry(single, _carried(single, by, F.max_by(_HELD, time)), by)
    before = F.coalesce(F.lag(_HELD).over(Window.partitionBy(*by, _CHUNK).orderBy(time)), F.col(_CARRY))
    rows = joined.withColumn(_HELD, before).filter(F.col(_HELD).isNotNull())
    last = F.col(f"{_HELD}.{value}")
    grown = F.when(F.col(value) >= last, F.col(value) - last).otherwise(F.col(value))
    return rows.select(*by, F.col(f"{_HELD}.{time}").alias("since"), time, grown.alias("increase"))


def window_rates(increases: DataFrame, by: Sequence[str], time: str = "ts", width: int = 300) -> DataFrame:
    """``window_start``, ``by`` and ``per_second`` of windows of ``width`` seconds.

    An increase is spread evenly over the time between its two samples, so windows between
    them, and at whose edges no sample lies, get their share.
    """
    size = width * 1_000_000
    spread = increases.select(*by, "increase", micros("since").alias("a"), micros(time).alias("b"))
    first, last = F.floor(F.col("a") / size), F.floor((F.col("b") - 1) / size)
    parts = spread.withColumn("w", F.explode(F.sequence(first, last)))
    inside = F.least("b", (F.col("w") + 1) * size) - F.greatest("a", F.col("w") * size)
    amount = F.col("increase") * (inside.cast("double") / (F.col("b") - F.col("a")))
    rates = parts.groupBy("w", *by).agg((F.sum(amount) / width).alias("per_second"))
    return rates.select(F.timestamp_micros(F.col("w") * size).alias("window_start"), *by, "per_second")
