"""Exact search for the largest inner products by elimination with a pivot table.

Vectors get one more component that gives them all the same length; then the largest inner
product is the smallest distance. Distances of all vectors to a set of pivots are worked out
beforehand. For a query, the largest difference of its own and a candidate's pivot distances
is a lower bound of their distance. Candidates are evaluated in the order of their bounds,
until the next bound is above the k-th best distance: no later one can be better.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import settle

#: Pivots, taken from the candidates with the smallest hashes.
PIVOTS = 48
#: Candidates, and queries, that one task searches. The tables of a task follow from both.
CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 4096
#: Candidates that are evaluated between two looks at the stopping rule.
STEP = 256


def grid(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component, the product in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def pivot_distances(lifted: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (lifted**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * lifted @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def lift(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with a component that makes their squared lengths equal to ``longest``."""
    rest = np.sqrt(np.maximum(longest - (vectors**2).sum(1), 0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def search(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray,
    to_pivots: np.ndarray, pivots: np.ndarray, longest: float, k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its row, and ids and scores of the ``k`` best candidates (all, if fewer).

    ``vectors`` are integers, so scores are exact; bounds are widened by what their own
    rounding can be, and a candidate whose bound equals the k-th best is still evaluated.
    """
    origin = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
    from_query = pivot_distances(origin, pivots)
    for q, query in enumerate(queries):
        bounds = np.abs(to_pivots - from_query[q]).max(axis=1)
        most = (query @ query + longest - np.maximum(bounds - 1e-6 * (1 + bounds), 0) ** 2) / 2
        order = np.argsort(-most, kind="stable")
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for i in range(0, len(order), STEP):
            at = order[i : i + STEP]
            if len(best) == k and most[at[0]] + 1e-6 * (1 + abs(most[at[0]])) < best[-1]:
                break
            at = at[ids[at] != query_ids[q]]
            scores = np.rint(vectors[at] @ query).astype(np.int64)
            best_ids, best = np.append(best_ids, ids[at]), np.append(best, scores)
            first = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[first], best[first]
        yield q, best_ids, best


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1)


def top_products(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    pivots: int = PIVOTS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of every query's ``k`` best rows.

    Components become ``floor(scale * x)``. Queries are the rows where ``queries`` holds,
    candidates all rows with another key; equal scores go to the smaller key. Candidates and
    queries are dealt into blocks by hash, every block of the one meets every block of the
    other, and each meeting gives ``k`` rows per query for the final choice.

    Vectors that are NULL, empty or hold a NULL or non-finite component, and rows without a
    key, take no part. A zero vector does. Only vectors of the query's length are its
    candidates. Rows that repeat a key and vector are one candidate and one query; different
    vectors of one key are candidates each. A query without candidates has no rows, and an
    empty table gives an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(key).isNotNull() & fine & (F.size(vector) > 0)).select(
        F.col(key).cast("long").alias("id"), grid(F.col(vector), scale).alias("vector"), queries.alias("asks")
    )
    rows = rows.groupBy("id", "vector").agg(F.max(F.coalesce("asks", F.lit(False))).alias("asks"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    rows = settle(rows.withColumn("square", square), "grid")
    sizes = rows.groupBy(F.size("vector").alias("n")).agg(
        F.count("*").alias("rows"), F.sum(F.col("asks").cast("int")).alias("asks"), F.max("square").alias("longest")
    )
    best = spark.createDataFrame([], "query_id long, vec_id long, score long")
    for length, count, asking, longest in sorted(tuple(r) for r in sizes.collect()):
        if not asking:
            continue
        own = rows.filter(F.size("vector") == length)
        table = own.orderBy(F.xxhash64("vector"), "id").limit(pivots).select("vector").toArrow()
        chosen = lift(_matrix(table["vector"]), longest)
        best = best.unionByName(_meet(own, chosen, longest, k, -(-count // CANDIDATE_BLOCK), -(-asking // QUERY_BLOCK)))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    # The same candidate key can come with several vectors; each counts, as each is a row.
    return best.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _meet(own: DataFrame, chosen: np.ndarray, longest: float, k: int, blocks: int, turns: int) -> DataFrame:
    """The ``k`` best of each block of candidates for each query of each block of queries."""

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lifted = lift(_matrix(pa.chunked_array([batch.column(1)])), longest)
                far = pivot_distances(lifted, chosen)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(far.ravel()), far.shape[1]).cast(
                    pa.list_(pa.float64())
                )
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["id", "vector", "pivots"])

    index = settle(own.select("id", "vector").mapInArrow(indexed, "id long, vector array<long>, pivots array<double>"), "index")

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("id", "vector"), F.lit(n)).cast("int")

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    side = ["block", "turn", "id", "vector", "pivots"]
    there = index.withColumn("block", dealt(blocks)).withColumn("turn", all_of(turns)).select(*side)
    asking = own.filter("asks").withColumn("turn", dealt(turns)).withColumn("block", all_of(blocks))
    asking = asking.withColumn("pivots", F.lit(None).cast("array<double>")).select(*side)

    def met(table: pa.Table) -> pa.Table:
        inside = table["pivots"].is_valid()
        candidates, asked = table.filter(inside), table.filter(pc.invert(inside))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if candidates.num_rows and asked.num_rows:
            ids = asked["id"].to_numpy()
            results = search(
                _matrix(asked["vector"]), ids, _matrix(candidates["vector"]), candidates["id"].to_numpy(),
                _matrix(candidates["pivots"]), chosen, longest, k,
            )
            found = [(np.full(len(c), ids[q]), c, s) for q, c, s in results]
        columns = [np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*found)] or [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    both = there.unionByName(asking)
    return both.groupBy("block", "turn").applyInArrow(met, "query_id long, vec_id long, score long")
