"""Near-duplicates by SimHash, found through an inverted index on byte positions.

Two 64-bit fingerprints that differ in at most ``k`` bits differ in at most ``k`` of their
eight bytes, so they share at least ``8 - k`` positional bytes. A list per single byte would
hold one in 256 of all fingerprints, and tallies over such lists grow with the square of the
table. The index therefore has a list for every combination of ``8 - k`` positions and their
bytes: fingerprints that meet in a list have just the tally that is guaranteed, and no pair
below it is ever formed. Members of a list agree in all but ``k`` bytes, so for ``k = 2`` a
list holds 65,536 different fingerprints at most, whatever the size of the table. Copies of
a fingerprint are one member.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.dedup import columns_as_order, keep_first
from .common import settle
from .components import components

SEED = 42
#: Words of a text that are hashed at once.
BLOCK_WORDS = 1 << 16


def fingerprint(text: str, words: int = 3) -> int:
    """SimHash of a whole text as a signed 64-bit number, 0 without words.

    A-Z are lower-cased; words lie between ASCII white space; a bit is set if it is set in
    over half of the shingles' XXH64.
    """
    from xxhash import xxh64_intdigest

    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    tokens = tokens if len(tokens) >= words else [b" ".join(tokens)]
    size = min(words, len(tokens))
    n, ones = len(tokens) - size + 1, np.zeros(64, np.int64)
    for at in range(0, n, BLOCK_WORDS):
        part = tokens[at : min(at + BLOCK_WORDS, n) + size - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(size))))
        hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, key: str, text: str, words: int, hash_: Column | None = None
) -> DataFrame:
    """``key``, ``fp`` and ``hash_`` of every row; a NULL text has the fingerprint of an empty one."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py() or "", words) for t in batch.column(1)]
            columns = [batch.column(0), pa.array(fps, pa.int64()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "fp", "hash"])

    schema = StructType(
        [StructField("key", docs.schema[key].dataType), StructField("fp", LongType()), StructField("hash", LongType())]
    )
    hash_ = F.lit(None).cast("long") if hash_ is None else hash_
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), hash_.alias("hash"))
    return rows.mapInArrow(hashed, schema)


def _masks(max_bits: int) -> list[int]:
    """For each choice of ``8 - max_bits`` byte positions, the bits of these bytes (signed)."""
    chosen = combinations(range(8), 8 - max_bits)
    masks = (reduce(lambda m, p: m | 0xFF << 8 * p, positions, 0) for positions in chosen)
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _close(max_bits: int) -> Column:
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits


def stars(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect the members of one list as their close pairs do.

    Each round takes the not yet reached members within ``max_bits`` of the last reached
    ones, so a member is compared until it is reached and no pairs are kept.
    """
    links, left = [], members
    while len(left) > 1:
        root, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for f in front:
                rest = np.flatnonzero(~near)
                near[rest] = np.bitwise_count((left[rest] ^ f).view(np.uint64)) <= max_bits
            front, left = left[near], left[~near]
            links += [(int(f), int(root)) for f in front]
    return links


def _links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links between different fingerprints, enough to connect all that are within ``max_bits``."""
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(max_bits)])
    entries = fps.select("fp", F.posexplode(masks).alias("place", "mask")).select(
        "fp", "place", F.col("fp").bitwiseAND(F.col("mask")).alias("bytes")
    )
    lists = settle(
        entries.groupBy("place", "bytes")
        .agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .filter("n > 1"),
        "lists",
    )
    pairs = lists.filter("n = 2").filter(_close(max_bits)).select("a", "b").distinct()
    crowded = settle(lists.filter("n > 2").select("place", "bytes"), "crowded")
    shared = entries.join(crowded, ["place", "bytes"])

    def connected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Lists follow each other in sorted order; the last one of a batch may go on in the next."""
        held = None
        for batch in batches:
            frame = batch if held is None else pd.concat([held, batch], ignore_index=True)
            keys = frame[["place", "bytes"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
            fps = frame["fp"].to_numpy()
            found = [x for s, e in zip(starts, starts[1:]) for x in stars(fps[s:e], max_bits)]
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
            held = frame.iloc[starts[-1] :] if len(frame) else None
        if held is not None:
            yield pd.DataFrame(stars(held["fp"].to_numpy(), max_bits), columns=["a", "b"], dtype="int64")

    dense = shared.repartition("place", "bytes").sortWithinPartitions("place", "bytes", "fp")
    return pairs.unionByName(dense.mapInPandas(connected, "a long, b long"))


def _named(hashed: DataFrame, max_bits: int) -> DataFrame:
    """``fp`` and ``component_id`` of every fingerprint in ``hashed`` (``key``, ``fp``)."""
    classes = settle(hashed.groupBy("fp").agg(F.min("key").alias("first")), "classes")
    if not max_bits:
        return classes.select("fp", F.col("first").alias("component_id"))
    roots = components(_links(classes.select("fp"), max_bits))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return settle(rooted.join(ids, "root").select("fp", "component_id"), "named")


def _checked(max_bits: int) -> None:
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits is from 0 to 4")


def simhash_classes(
    docs: DataFrame, words: int = 3, max_bits: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``fingerprint`` (16 lowercase hex digits) and ``component_id`` of every row.

    ``component_id`` is the smallest key that is reachable over links of at most ``max_bits``
    differing bits, its own included. Whole texts are hashed once and only fingerprints go on.

    A NULL, empty or blank text has fingerprint zero and is linked by it like any other.
    Repeated rows are all returned with the same component. Rows without a key are returned
    and connect others, but a component has no id only if none of its rows has a key. An
    empty table gives an empty result. Other columns are not read.
    """
    _checked(max_bits)
    hashed = settle(fingerprints(docs, key, text, words), "fingerprints")
    return hashed.join(_named(hashed, max_bits), "fp").select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(
    docs: DataFrame, words: int = 3, max_bits: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one row of every group, the one with the smallest key, and all columns.

    Of repeated rows one is kept, and of different texts with the group's smallest key the
    one with the smallest hash. Rows without a key cannot be named and are all kept.
    """
    _checked(max_bits)
    hash_ = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    hashed = settle(fingerprints(docs, key, text, words, hash_), "fingerprints")
    rows = hashed.filter("key is not null").groupBy("key", "hash", "fp").agg(F.count("*").alias("n"))
    rows = settle(rows.join(_named(hashed, max_bits), "fp"), "rows")
    best = F.min(F.struct("key", "hash")).alias("best")
    stays = rows.groupBy("component_id").agg(best).select("best.*", F.lit(True).alias("stays"))
    judged = rows.join(stays, ["key", "hash"], "left")
    dropped = judged.filter("stays is null").select("key", "hash")
    repeated = judged.filter("stays and n > 1").select("key", "hash")
    marked = docs.withColumn("__key", F.col(key)).withColumn("__hash", hash_)

    def among(found: DataFrame, label: str) -> DataFrame:
        return settle(found.toDF("__key", "__hash"), label)

    several = among(repeated, "repeated")
    kept = marked.join(among(dropped, "dropped"), ["__key", "__hash"], "left_anti")
    if several.isEmpty():  # as a rule keys differ, and texts are joined once
        return kept.select(*docs.columns)
    once = kept.join(several, ["__key", "__hash"], "left_anti")
    more = kept.join(several, ["__key", "__hash"], "left_semi")
    more = keep_first(more, ["__key", "__hash"], columns_as_order(docs))
    return once.select(*docs.columns).unionByName(more.select(*docs.columns))
