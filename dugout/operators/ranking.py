"""Ranks, positions, top-n, leaders and pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import scratch_root, settle
from .dedup import columns_as_order

_N, _AHEAD, _RANGE, _SET = "__n", "__ahead", "__range", "__set"
# Cuts tried per look at a column, and rows before a page that may be sorted with it.
_CUTS, _NEAR = 63, 10_000


def by(name: str, desc: bool = False) -> Column:
    """Sort key where NULL counts as the largest value: first if descending, last if not."""
    column = F.col(name)
    return column.desc_nulls_first() if desc else column.asc_nulls_last()


def nulls_last(name: str, desc: bool = False) -> Column:
    """Sort key with missing values at the end in both directions."""
    column = F.col(name)
    return column.desc_nulls_last() if desc else column.asc_nulls_last()


def _join_same(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on equal keys where NULL equals NULL; key columns come from the left."""
    renamed = right.select(
        *[F.col(k).alias(f"__right_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    )
    return left.join(renamed, same, how).drop(*[f"__right_{k}" for k in keys])


def _count_ahead(part: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over the sorted rows of one task: the sum of counts before each row, of its partition."""

    def coded(batch: pa.RecordBatch) -> np.ndarray:
        # A number per row, the same for the same values; missing and not-a-number are values.
        codes = np.zeros(batch.num_rows, dtype=np.int64)
        for name in part:
            own = pc.dictionary_encode(batch.column(name), null_encoding="encode").indices.to_numpy()
            _, codes = np.unique(codes * (int(own.max()) + 1) + own, return_inverse=True)
        return codes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = coded(batch)
            counts = batch.column(_N).to_numpy()
            grouped = np.argsort(codes, kind="stable")
            firsts = np.flatnonzero(np.r_[True, np.diff(codes[grouped]) > 0])
            sizes = np.diff(np.r_[firsts, len(grouped)])
            before = np.cumsum(counts[grouped]) - counts[grouped]
            ends = np.r_[before[firsts[1:]], before[-1] + counts[grouped[-1]]]
            heads = batch.take(pa.array(grouped[firsts]))
            # Values as they are printed: those that are not a number are the same, too.
            keys = list(zip(*[[repr(v) for v in heads.column(name).to_pylist()] for name in part]))
            held = np.array([totals.get(key, 0) for key in keys], dtype=np.int64)
            totals.update(zip(keys, (held + ends - before[firsts]).tolist()))
            ahead = np.empty(len(grouped), dtype=np.int64)
            ahead[grouped] = before + np.repeat(held - before[firsts], sizes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ahead)], [*batch.schema.names, _AHEAD])

    return run


def _ahead(tally: DataFrame, part: Sequence[str], order: Sequence[tuple[str, bool]]) -> DataFrame:
    """Per row of a tally, how many rows of its partition sort before it.

    The tally is dealt by ranges of partition and order, so that a partition with many values
    lies in many tasks. A task sorts its range by order alone, which has more values than the
    partitions that meet there, and adds the counts of each partition up; what lies in earlier
    ranges comes from one total per partition and range.
    """
    sorting = [by(name, desc) for name, desc in order]
    ranged = tally.repartitionByRange(*[by(c) for c in part], *sorting).sortWithinPartitions(*sorting)
    ranged = ranged.withColumn(_RANGE, F.spark_partition_id())
    counted = StructType([*ranged.schema.fields, StructField(_AHEAD, LongType())])
    ranged = settle(ranged.mapInArrow(_count_ahead(part), counted), "ranges")
    # A border between ranges divides one partition at most, so there are fewer than two of
    # these rows per range, whatever the table's size.
    earlier = Window.partitionBy(*part).orderBy(_RANGE)
    totals = ranged.groupBy(*part, _RANGE).agg(F.sum(_N).alias("__total"))
    starts = totals.select(
        *part, _RANGE, F.sum("__total").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("__start")
    ).filter(F.col("__start").isNotNull())
    joined = _join_same(ranged, F.broadcast(starts), [*part, _RANGE], "left")
    ahead = F.col(_AHEAD) + F.coalesce(F.col("__start"), F.lit(0))
    return joined.withColumn(_AHEAD, ahead).drop("__start", _RANGE)


def rank_within(
    df: DataFrame,
    ranks: Mapping[str, Sequence[str]],
    order: Sequence[tuple[str, bool]],
) -> DataFrame:
    """Add ``rank()`` columns: ``ranks`` maps a new column to its partition columns.

    ``order`` lists ``(column, descending)``, NULL being the largest value. Equal rows
    share a rank and leave a gap behind them.

    A plain window would sort a whole partition (a league) in one task. Here the rows are
    counted per distinct (partition, order) value, for all ranks in one aggregation; ranks are
    worked out on the counts, by ranges of values, and the rows look their rank up. So a value
    that many rows share is one row of the count, and a partition with many values is many
    tasks. The counts and the ranks are written, not the rows: these are read once for the
    counts and once for the look-up, and must be the same both times.
    """
    names = [name for name, _ in order]
    sets = list(dict.fromkeys(tuple(dict.fromkeys(columns)) for columns in ranks.values()))
    keys = list(dict.fromkeys([*(column for part in sets for column in part), *names]))
    tally = df.groupingSets([[F.col(c) for c in dict.fromkeys([*part, *names])] for part in sets], *keys).agg(
        F.count("*").alias(_N), F.grouping_id().cast("bigint").alias(_SET)
    )
    spread = list(dict.fromkeys([_SET, *(column for part in sets for column in part)]))
    table = settle(_ahead(tally, spread, order).drop(_N), "ranks")
    for new, part in ranks.items():
        own = list(dict.fromkeys([*names, *part]))  # the join sorts by the column with most values first
        # grouping_id() has a bit, the first key's being the highest, per key that is left out.
        number = sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in own)
        places = table.filter(F.col(_SET) == number)
        df = _join_same(df, places.select(*own, (F.col(_AHEAD) + 1).cast("bigint").alias(new)), own, "left")
    return df


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Number the rows 1, 2, 3, ... in a total ``order``, without a single-task window.

    The rows are range-sorted and checkpointed, so partition and offset of a row are
    settled; the only thing gathered is one row count per partition.
    """
    scratch = scratch_root(df.sparkSession)
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(scratch)
    tagged = (
        df.orderBy(*order)
        .checkpoint()
        .withColumn("__id", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftrightunsigned("__id", 33))
    )
    sizes = tagged.groupBy("__part").agg(F.count("*").alias(_N))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum(_N).over(earlier), F.lit(0)).alias(_AHEAD))
    row = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        tagged.join(F.broadcast(starts), "__part")
        .withColumn(name, (F.col(_AHEAD) + row + 1).cast("bigint"))
        .select(*df.columns, name)
    )


def top_n(
    df: DataFrame, order: Sequence[Column], n: int, present: str | None = None
) -> DataFrame:
    """The first ``n`` rows in ``order``; rows without a ``present`` value do not take part."""
    rows = df if present is None else df.filter(F.col(present).isNotNull())
    return rows.orderBy(*order).limit(n)


@dataclass(frozen=True)
class Board:
    """One leader board: best ``metric`` among the rows where ``where`` holds."""

    name: str
    metric: str
    desc: bool = True
    where: Column | None = None


def leaders(
    df: DataFrame, boards: Sequence[Board], keep: Sequence[str], tie: Sequence[Column]
) -> DataFrame:
    """The best row of every board, one output row each, from a single pass.

    ``keep`` columns are carried along, ``value`` is the metric as double. Metrics are
    numeric; ``tie`` columns (ascending) decide between equals. A board without any
    value gives no row.
    """
    winners = []
    for board in boards:
        metric = F.col(board.metric).cast("double")
        # Booleans sort false first, so a missing tie value comes last.
        ties = [part for c in tie for part in (c.isNull(), c)]
        place = F.struct(-metric if board.desc else metric, *ties)
        eligible = metric.isNotNull()
        if board.where is not None:
            eligible = eligible & board.where
        row = F.struct(F.lit(board.name).alias("board"), *keep, metric.alias("value"))
        winners.append(F.min_by(row, F.when(eligible, place)).alias(f"b{len(winners)}"))
    best = df.agg(*winners)
    return (
        best.select(F.explode(F.array(*best.columns)).alias("w"))
        .filter(F.col("w").isNotNull())
        .select("w.*")
    )


def _cuts(rows: DataFrame, name: str) -> list[Column]:
    """Some different values of a column, as literals of its type; none if all are missing."""
    kind = rows.schema[name].dataType
    some = rows.select(F.col(name).alias("v")).filter("v IS NOT NULL").orderBy(F.rand(17)).limit(_CUTS)
    texts = some.select(F.col("v").cast("string")).distinct().collect()  # 63 values at most
    return [F.lit(text).cast(kind) for text, in texts]


def seek_page(
    df: DataFrame, order: Sequence[tuple[str, bool]], page: int, size: int, where: Sequence[Column] = ()
) -> DataFrame:
    """Page ``page`` (from 0) of the rows that satisfy ``where``, in ``order``.

    ``order`` lists ``(column, descending)``, missing values come last in both directions; the
    remaining columns are appended ascending, so that pages neither share nor lose rows. Columns
    are numbers, text, dates, timestamps or booleans.

    The place where the page begins is sought, nothing is numbered, sorted or written as a whole:
    a scan counts the rows before each of 63 values taken from the column; the next one does the
    same between the two values around the page, or on the next column if the page begins among
    the rows of one value. As soon as less than 10,000 rows lie between a known place and the
    page, a top-k of that many rows from there gives it. Each scan reads the order columns only,
    and its range reaches the file reader. The table must be the same in all scans.
    """
    rows = reduce(lambda acc, condition: acc.filter(condition), where, df)
    named = {name for name, _ in order}
    total = [*order, *((c, False) for c in df.columns if c not in named)]
    sorting = [nulls_last(name, desc) for name, desc in total]
    skip = page * size  # rows of the part sought in that come before the page
    same = F.lit(True)  # columns whose value is found
    start = F.lit(True)  # rows from the known place on
    for name, desc in total:
        column = F.col(name)
        low = high = None  # the page begins behind `low` and before `high`
        while skip >= _NEAR:
            part = rows.filter(same & column.isNotNull())
            for bound in (low, high):
                part = part if bound is None else part.filter(bound)
            cuts = _cuts(part, name)
            ahead = [column > v if desc else column < v for v in cuts]
            upto = [column >= v if desc else column <= v for v in cuts]
            counts = part.agg(F.count("*"), *[F.count_if(c) for c in (*ahead, *upto)]).first()
            places = sorted(zip(counts[1 : len(cuts) + 1], counts[len(cuts) + 1 :], range(len(cuts))))
            rest = [i for before, _, i in places if before > skip]
            done = [(before, through, i) for before, through, i in places if before <= skip]
            if skip >= counts[0] and low is None and high is None:  # among the missing values
                skip -= counts[0]
                start, same = start & (~same | column.isNull()), same & column.isNull()
                break
            if done and skip < done[-1][1]:  # among the rows of one value
                before, _, i = done[-1]
                skip -= before
                start = start & (~same | column.isNull() | ~ahead[i])
                same = same & column.eqNullSafe(cuts[i])
                break
            if done:  # behind a value
                _, through, i = done[-1]
                skip -= through
                low = ~upto[i]
                start = start & (~same | column.isNull() | low)
            if rest:
                high = ahead[rest[0]]
        if skip < _NEAR:
            return rows.filter(start).orderBy(*sorting).offset(skip).limit(size)
    # More than 10,000 rows before the page are equal to its first one, which any of them can be.
    equal = rows.filter(same)
    left = max(0, equal.count() - skip)
    behind = rows.filter(start & ~same).orderBy(*sorting).limit(max(0, size - left))
    return equal.limit(min(left, size)).unionByName(behind)


def table_page(
    df: DataFrame, order: Sequence[Column], page: int, size: int, where: Sequence[Column] = ()
) -> DataFrame:
    """Page ``page`` (from 0) of the rows that satisfy ``where``, in ``order``.

    The remaining columns are appended to the order, so that pages neither share nor lose
    rows. A top-k would hold everything before the page in every task; the rows are numbered
    in parallel instead and the page is cut out by number, however deep it lies.
    """
    rows = reduce(lambda acc, condition: acc.filter(condition), where, df)
    start = page * size
    total = [*order, *columns_as_order(df)]
    numbered = with_position(rows, total, "__position")
    return numbered.filter(F.col("__position").between(start + 1, start + size)).drop("__position")
