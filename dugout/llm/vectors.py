"""Near-duplicate vectors by product quantisation.

Every vector is put into the inverted list of its nearest coarse centroid and its residual
is coded by subspace codewords. A vector looks for partners in the lists near it: a table of
distances from its own residual to all codewords gives the distance to any coded vector by
look-ups, and since the rounding error of each code is kept, the look-up distance tells for
certain which members cannot be near enough. The others are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField, StructType

from .common import settle
from .components import components

#: Vectors that the centroids and codewords are fitted on, those with the smallest hashes.
FIT_VECTORS = 20_000
#: Lists follow the square root of the number of vectors up to here.
MOST_LISTS = 4096
SUBSPACES = 8
CODEWORDS = 256
#: Members or visitors of a list that one task compares; longer lists are dealt in blocks.
BLOCK = 4096
#: Rows of a comparison at once.
STEP = 256
#: Visits that are handed on at once.
VISITS = 16_384


def usable(vector: Column) -> Column:
    """Whether a vector can have a cosine: no NULL, no infinite component, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def kmeans(points: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's algorithm from ``k`` distinct points; empty cells keep their centre."""
    chosen = np.random.default_rng(seed).choice(len(points), min(k, len(points)), replace=False)
    centres = points[np.sort(chosen)].copy()
    for _ in range(rounds):
        cells = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, cells, points)
        sizes = np.bincount(cells, minlength=len(centres))
        full = sizes > 0
        centres[full] = sums[full] / sizes[full, None]
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points (rows) to centres (columns)."""
    square = (points**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * points @ centres.T
    return np.maximum(square, 0)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    parts = (distances(points[i : i + 4096], centres).argmin(1) for i in range(0, len(points), 4096))
    return np.concatenate([*parts, np.zeros(0, np.int64)])


@dataclass(frozen=True)
class Quantiser:
    """Coarse centroids, and codewords of the residuals for each range of components."""

    centroids: np.ndarray
    bounds: np.ndarray
    codewords: list[np.ndarray]

    @property
    def ranges(self) -> list[tuple[int, int]]:
        return list(zip(self.bounds[:-1], self.bounds[1:]))

    def code(self, units: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the distances between residuals and codes."""
        residuals = units - self.centroids[cells]
        codes = np.stack(
            [nearest(residuals[:, a:b], w) for (a, b), w in zip(self.ranges, self.codewords)], axis=1
        )
        back = np.concatenate([w[codes[:, m]] for m, w in enumerate(self.codewords)], axis=1)
        return codes.astype(np.uint8), np.sqrt(((residuals - back) ** 2).sum(1))

    def probes(
        self, units: np.ndarray, reach: float, most: int | None = None, own: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and lists: those of a row that can hold vectors within ``reach``.

        A list holds what is nearer to its centroid than to others. A vector within reach of
        ``u`` lies there only if ``u`` is at most ``reach`` beyond the border between its own
        list and that one. A pair is looked for from its lower list, so higher ones suffice.
        With ``most``, only so many of them are taken, the nearest ones.
        """
        square = distances(units, self.centroids)
        own = square.argmin(1) if own is None else own
        between = np.sqrt(distances(self.centroids, self.centroids))[own]
        beyond = square - square[np.arange(len(units)), own][:, None]
        possible = beyond <= 2 * reach * between + 1e-6
        possible &= np.arange(len(self.centroids)) >= own[:, None]
        if most is not None and most < len(self.centroids):
            order = np.argsort(np.where(possible, square, np.inf), axis=1, kind="stable")
            np.put_along_axis(possible, order[:, most:], False, axis=1)
        return np.nonzero(possible)


def _units(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow, no underflow
    return vectors / np.sqrt((vectors**2).sum(1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def fit(sample: np.ndarray, vectors: int, seed: int = 5) -> Quantiser:
    """A quantiser for about ``vectors`` vectors, from a sample of their directions."""
    lists = int(min(max(1, math.isqrt(vectors)), MOST_LISTS, max(1, len(sample) // 4)))
    centroids = kmeans(sample, lists, 8, seed)
    residuals = sample - centroids[nearest(sample, centroids)]
    bounds = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
    words = [kmeans(residuals[:, a:b], CODEWORDS, 5, seed) for a, b in zip(bounds, bounds[1:])]
    return Quantiser(centroids, bounds, words)


def _indexed(classes: DataFrame, quantiser: Quantiser, dimension: int) -> DataFrame:
    """Every class of one dimension with its list, code and code error."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            units = _units(_matrix(batch.column(3)))
            cells = nearest(units, quantiser.centroids)
            codes, errors = quantiser.code(units, cells)
            more = [
                pa.array(cells, pa.int32()),
                pa.array([c.tobytes() for c in codes], pa.binary()),
                pa.array(errors, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *more], ["id", "label", "rows", "vector", "list", "code", "error"]
            )

    more = [("list", IntegerType()), ("code", BinaryType()), ("error", DoubleType())]
    schema = StructType([*classes.schema.fields, *(StructField(*m) for m in more)])
    return classes.filter(F.size("vector") == dimension).mapInArrow(coded, schema)


def _visits(index: DataFrame, quantiser: Quantiser, reach: float, probes: int | None, span: int) -> DataFrame:
    """One row for every group of ``span`` lists that a vector looks into, with its own ``list``."""

    def probing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                some = batch.slice(start, STEP)
                own = some.column(4).to_numpy()
                rows, lists = quantiser.probes(_units(_matrix(some.column(3))), reach, probes, own)
                rows, groups = np.unique(np.stack([rows, lists // span]), axis=1)
                for i in range(0, len(rows), VISITS):
                    taken = some.take(pa.array(rows[i : i + VISITS]))
                    yield pa.RecordBatch.from_arrays(
                        [*taken.columns, pa.array(groups[i : i + VISITS], pa.int32())],
                        ["id", "label", "rows", "vector", "list", "group"],
                    )

    rows = index.select("id", "label", "rows", "vector", "list")
    return rows.mapInArrow(probing, StructType([*rows.schema.fields, StructField("group", IntegerType())]))


def _near(
    visitors: np.ndarray, members: np.ndarray, codes: np.ndarray, errors: np.ndarray,
    cell: np.ndarray, quantiser: Quantiser, reach: float, least: float,
) -> np.ndarray:
    """Which visitors (rows) have a cosine of ``least`` with which members (columns).

    Look-up distances plus the members' code errors decide what is compared exactly.
    """
    residuals = visitors - cell
    looked = np.zeros((len(visitors), len(members)), np.float32)
    for m, ((a, b), words) in enumerate(zip(quantiser.ranges, quantiser.codewords)):
        table = distances(residuals[:, a:b], words).astype(np.float32)
        looked += table[:, codes[:, m]]
    possible = np.sqrt(looked) <= errors + reach + 1e-3
    near = np.zeros(possible.shape, bool)
    rows, columns = np.nonzero(possible)
    if len(rows) * 8 > possible.size:  # mostly near: one product is less work than picking
        return possible & (visitors @ members.T >= least)
    for i in range(0, len(rows), 65536):
        r, c = rows[i : i + 65536], columns[i : i + 65536]
        near[r, c] = np.einsum("ij,ij->i", visitors[r], members[c]) >= least
    return near


def _merge(roots: np.ndarray, one: int, others: np.ndarray) -> None:
    """Give ``one`` and ``others`` the same, smallest root."""
    found = np.unique(np.append(roots[others], roots[one]))
    if len(found) > 1:
        roots[np.isin(roots, found[1:])] = found[0]


def _linked(
    index: DataFrame, quantiser: Quantiser, least: float, probes: int | None, span: int
) -> DataFrame:
    """``id``, ``links`` (rows linked to it, found here) and ``root`` of linked classes.

    Each group of ``span`` lists of a label is one task; large ones are dealt in blocks of
    members and visitors, every block of one kind meeting every block of the other. Inside,
    a visitor is compared with the lists that it looks into.
    """
    reach = math.sqrt(max(0.0, 2 - 2 * least))
    index = index.withColumn("group", (F.col("list") / span).cast("int"))
    visits = _visits(index, quantiser, reach, probes, span)
    place = ["label", "group"]
    members = index.groupBy(*place).agg(F.count("*").alias("members"))
    visitors = visits.groupBy(*place).agg(F.count("*").alias("visitors"))
    sizes = settle(
        members.join(visitors, place).select(
            *place,
            F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"),
            F.ceil(F.col("visitors") / BLOCK).cast("int").alias("turns"),
        ),
        "sizes",
    )
    salt = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sides = [*place, "block", "turn", "id", "rows", "vector", "list", "code", "error"]
    none = [F.lit(None).cast("binary").alias("code"), F.lit(None).cast("double").alias("error")]
    stored = index.join(sizes, place).withColumn("block", F.pmod(salt, "blocks").cast("int"))
    stored = stored.withColumn("turn", every("turns")).select(*sides)
    coming = visits.join(sizes, place).withColumn("turn", F.pmod(salt, "turns").cast("int"))
    coming = coming.withColumn("block", every("blocks")).select(
        *place, "block", "turn", "id", "rows", "vector", "list", *none
    )

    def compared(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, weights, own = table["id"].to_numpy(), table["rows"].to_numpy(), table["list"].to_numpy()
        inside = table["code"].is_valid().to_numpy(zero_copy_only=False)
        units = _units(_matrix(table["vector"].combine_chunks()))
        stay, come = np.flatnonzero(inside), np.flatnonzero(~inside)
        stay = stay[np.argsort(own[stay], kind="stable")]
        coded = table.take(pa.array(stay))
        codes = np.frombuffer(b"".join(coded["code"].to_pylist()), np.uint8).reshape(len(stay), -1)
        errors = coded["error"].to_numpy().astype(np.float32)
        names, at = np.unique(ids, return_inverse=True)
        links, roots = np.zeros(len(names), np.int64), np.arange(len(names))
        cells, firsts, numbers = np.unique(own[stay], return_index=True, return_counts=True)
        looks = np.zeros((len(come), len(cells)), bool)
        for i in range(0, len(come), STEP):
            some = come[i : i + STEP]
            rows, lists = quantiser.probes(units[some], reach, probes, own[some])
            held = np.isin(lists, cells)
            looks[rows[held] + i, np.searchsorted(cells, lists[held])] = True
        for c, (cell, first, number) in enumerate(zip(cells, firsts, numbers)):
            part = slice(first, first + number)
            some = come[looks[:, c]]
            step = max(STEP, STEP * BLOCK // (8 * number))
            for i in range(0, len(some), step):
                rows = some[i : i + step]
                near = _near(
                    units[rows], units[stay[part]], codes[part], errors[part],
                    quantiser.centroids[cell], quantiser, reach, least,
                )
                # Two members of one list meet once: the one with the larger id is the visitor.
                near &= (own[rows] != cell)[:, None] | (ids[rows][:, None] > ids[stay[part]][None, :])
                links[at[rows]] += near @ weights[stay[part]]
                np.add.at(links, at[stay[part]], weights[rows] @ near)
                for r in np.flatnonzero(near.any(1)):
                    _merge(roots, at[rows[r]], at[stay[part][near[r]]])
        found = np.flatnonzero(links > 0)
        return pa.table(
            {"id": names[found], "links": links[found], "root": names[roots[found]]},
            pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())]),
        )

    both = stored.unionByName(coming)
    return both.groupBy(*place, "block", "turn").applyInArrow(compared, "id long, links long, root long")


def near_vectors(
    vectors: DataFrame,
    least: float = 0.93,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    probes: int | None = None,
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Rows with the same label are linked if the cosine of their vectors is ``least`` or more.
    ``n_links`` counts the rows linked directly, ``component_id`` is the smallest key that
    links lead to, and ``kept`` says that it is the row's own.

    Equal vectors of a label are compared as one class that counts its rows, so copies cost
    nothing however many there are; other classes of a list are compared in blocks. No pair
    is written out: tasks return counts and links to a smallest member. Every list that can
    hold a partner is visited, so no link is lost; with ``probes``, only that many nearest
    ones are, and links may be.

    Rows without a label, and vectors that are NULL, empty, zero or hold a NULL or non-finite
    component, have no links and are kept. Vectors of different lengths are not linked. A row
    without a key takes part and has its component's id. Repeated rows are linked to each
    other. An empty table gives an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"
    rows = vectors.select(
        F.col(key).alias("key"), F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<float>" if single else "array<double>").alias("vector"),
    ).withColumn("usable", usable(F.col("vector")) & F.col("label").isNotNull())
    grouped = rows.filter("usable").groupBy("label", "vector").agg(
        F.count("*").alias("rows"), F.min("key").alias("first")
    )
    # Written before they are read: from here on the numbers belong to the rows for good.
    classes = settle(grouped.withColumn("id", F.monotonically_increasing_id()), "classes")
    shape = classes.select("id", "label", "rows", "vector")
    lengths = classes.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("classes")).collect()
    found = spark.createDataFrame([], "id long, links long, root long")
    for dimension, count in sorted(tuple(r) for r in lengths):
        # The bounded sample of the index: its directions are all that comes to the driver.
        most = max(256, min(FIT_VECTORS, 32_000_000 // (8 * dimension)))
        sample = classes.filter(F.size("vector") == dimension).orderBy(F.xxhash64("vector"), "id").limit(most)
        directions = _units(_matrix(sample.select("vector").toArrow()["vector"].combine_chunks()))
        quantiser = fit(directions, count)
        index = settle(_indexed(shape, quantiser, dimension), "index")
        # Lists are visited in groups: about a block of members of the largest label in each.
        largest = index.groupBy("label").count().agg(F.max("count")).first()[0]
        span = max(1, BLOCK * len(quantiser.centroids) // largest)
        found = found.unionByName(settle(_linked(index, quantiser, least, probes, span), "linked"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = classes.join(links, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    named = named.withColumn("root", F.coalesce("root", "id"))
    firsts = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.join(firsts, "root").select(
        "label", "vector", (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "component"
    )
    named = settle(named, "named")
    linked = rows.filter("usable").join(named, ["label", "vector"]).select("key", "links", "component")
    alone = rows.filter("not usable").select("key", F.lit(0).cast("long").alias("links"), F.col("key").alias("component"))
    return linked.unionByName(alone).select(
        F.col("key").alias(key),
        F.col("links").alias("n_links"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("key") == F.col("component"), F.lit(False)).alias("kept"),
    )
