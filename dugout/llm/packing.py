"""Packing documents into windows of tokens by minimum bin slack.

A document's ids are cut into whole windows and a rest. The pieces of a group are packed by
subset sums: a bitset tells which totals the remaining lengths can reach, the total that
wastes least is traced back to counts per length, and that choice is repeated as long as
the counts last. Groups are dealt by hash, so every group is a fair sample of all lengths.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from itertools import pairwise

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import encoding
from .common import settle

#: Pieces that are packed together; the memory of a packing task follows from it.
GROUP_PIECES = 2048
#: Bytes of texts that are encoded together.
GROUP_BYTES = 1 << 20


def _padding(total: int, window: int) -> int:
    """Padding of a sequence of ``total`` tokens: none at a power of two."""
    return 0 if total & (total - 1) == 0 else window - total


def fullest(counts: dict[int, int], window: int) -> dict[int, int]:
    """How many of each length to put in one window: the longest one, and what wastes least with it.

    Bit ``t`` of ``reach`` says that some of the lengths seen so far add up to ``t``. A length
    that occurs ``n`` times takes part in portions of 1, 2, 4, ... pieces, so that any count up
    to ``n`` is possible. It stops at the first way to fill the window.
    """
    first = max(counts)
    room = window - first
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == first), room // length)
        portion = 1
        while left > 0 and not reach >> room & 1:
            take = min(portion, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left -= take
            portion *= 2
        if reach >> room & 1:
            break
    totals = [t for t in range(room + 1) if reach >> t & 1] if not reach >> room & 1 else [room]
    best = min(totals, key=lambda t: (_padding(first + t, window), -t))
    chosen = {first: 1}
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            chosen[length] = chosen.get(length, 0) + take
            best -= length * take
    return chosen


def windows(counts: dict[int, int], window: int) -> Iterator[tuple[dict[int, int], int]]:
    """All windows for lengths that occur ``counts`` times: a content, and how many such windows."""
    left = {length: n for length, n in counts.items() if n > 0}
    while left:
        content = fullest(left, window)
        times = min(left[length] // n for length, n in content.items())
        for length, n in content.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
        yield content, times


def cut(ids: bytes, window: int) -> list[tuple[int, int, int]]:
    """Start, length and checksum of the pieces of a document's ids (four bytes each).

    Whole windows come first. The rest is cut once, at a multiple of a quarter of the window:
    then every piece finds company, even where many documents have the same length.
    """
    total, view = len(ids) // 4, memoryview(ids)
    whole, quarter = total - total % window, max(1, window // 4)
    stops = [*range(window, whole + 1, window), total - total % quarter, total]
    found, start = [], 0
    for stop in stops:
        if stop > start:
            found.append((start, stop - start, zlib.crc32(view[4 * start : 4 * stop])))
            start = stop
    return found


def _little(ids: list[int]) -> bytes:
    packed = array("I", ids)
    return packed.tobytes()


def document_ids(texts: list[str | None] | pa.Array, path: str) -> list[bytes]:
    """The ids of whole texts, as little-endian unsigned 32-bit numbers.

    The texts are worked on together; a long one is best alone, and is cut into segments.
    """
    coder = encoding.encoder(path, "ids", _little, encoding.WordEncoder)
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    if len(texts) == 1 and texts[0].is_valid and len(text := texts[0].as_py()) > encoding.SEGMENT_CHARS:
        parts = (pa.array([part], pa.string()) for part in encoding.segments(text))
        return [b"".join(coder.ids(part)[0].tobytes() for part in parts)]
    ids, ends = coder.ids(texts)
    whole = ids.tobytes()
    return [whole[4 * i : 4 * k] for i, k in pairwise(ends.tolist())]


def pieces(docs: DataFrame, path: str, window: int, end: int, key: str, text: str) -> DataFrame:
    """One row per piece of a document; nothing is shuffled."""
    names = ["key", "start", "length", "ids_crc32", "doc_tokens"]

    closing = _little([end])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            every = (ids for some in encoding.slices(batch.column(1), GROUP_BYTES) for ids in document_ids(some, path))
            for i, ids in enumerate(every):
                ids += closing
                rows += [(i, *piece, len(ids) // 4) for piece in cut(ids, window)]
            columns = list(zip(*rows)) if rows else [()] * 5
            owner = batch.column(0).take(pa.array(columns[0], pa.int64()))
            rest = [pa.array(c, pa.int64()) for c in columns[1:]]
            yield pa.RecordBatch.from_arrays([owner, *rest], names)

    schema = StructType(
        [StructField("key", docs.schema[key].dataType)] + [StructField(n, LongType()) for n in names[1:]]
    )
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(encoded, schema)


def pack(
    docs: DataFrame,
    path: str,
    window: int = 2048,
    end: int = 1,
    key: str = "doc_id",
    text: str = "text",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Pack every id of every document into sequences of at most ``window`` ids.

    Returns one row per piece: ``key``, ``start`` (ids of its document before it), ``length``,
    ``ids_crc32``, ``doc_tokens`` (with the end id), ``sequence_id`` and ``offset`` in the
    sequence. Texts are encoded once; only lengths and checksums are stored and shuffled.
    The pieces of a document are dealt to groups one by one, so neither a very long document
    nor a key that repeats often makes a large group.

    A NULL or empty text has only the end id. Repeated rows and rows without a key are packed
    like others. An empty table gives an empty result. Other columns are not read.
    """
    found = settle(pieces(docs, path, window, end, key, text), "pieces")
    groups = max(1, -(-found.count() // group_pieces))
    dealt = found.withColumn("group", F.pmod(F.xxhash64("key", "start", "ids_crc32", F.rand(7)), F.lit(groups)))

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "key", "start", "ids_crc32"], ignore_index=True)
        by_length = {int(n): list(rows) for n, rows in frame.groupby("length").indices.items()}
        sequence, offset = [0] * len(frame), [0] * len(frame)
        number = 0
        for content, times in windows({n: len(rows) for n, rows in by_length.items()}, window):
            for _ in range(times):
                at = 0
                for length, n in content.items():
                    for _ in range(n):
                        row = by_length[length].pop()
                        sequence[row], offset[row] = number, at
                        at += length
                number += 1
        frame["sequence_id"] = pd.Series(sequence, dtype="int64") + frame["group"] * (1 << 32)
        frame["offset"] = pd.Series(offset, dtype="int64")
        return frame.drop(columns="group")

    schema = StructType(
        list(found.schema.fields) + [StructField("sequence_id", LongType()), StructField("offset", LongType())]
    )
    return dealt.groupBy("group").applyInPandas(packed, schema).withColumnRenamed("key", key)
