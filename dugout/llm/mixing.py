"""Mixing sources to target weights by Poisson replication.

Every document occurs as often as a Poisson number with its source's repetition rate says.
The number is found by inverting the distribution at a hash of the document's key, so a
document decides for itself, and no counts besides those per source are gathered.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .common import settle

#: A rate above this is split into equal parts that are drawn one by one: the sum of Poisson
#: numbers is a Poisson number, and exp(-rate) stays well above zero.
PART_RATE = 64.0


def rates(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    source: str = "source",
    temperature: float = 0.5,
    total: float | None = None,
) -> DataFrame:
    """``source``, ``parts`` and ``cdf``: cumulative probabilities of a part's numbers 0, 1, ...

    A source's share of the ``total`` (the number of rows if not given) is in proportion to
    its weight, or to its row count to the power of ``temperature`` without weights. Rows
    without a source are a source of their own. A source that ``weights`` doesn't name, or
    with no positive weight, has rate 0.
    """
    spark = docs.sparkSession
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").cast("double").alias("n"))
    if weights is None:
        weighted = counts.withColumn("weight", F.pow("n", F.lit(temperature)))
    else:
        given = spark.createDataFrame([(k, float(w)) for k, w in weights.items()], "name string, weight double")
        same = F.col("source").cast("string").eqNullSafe(F.col("name"))
        weighted = counts.join(given, same, "left").select(
            "source", "n", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight")
        )
    weighted = settle(weighted, "weights")
    sums = weighted.agg(F.sum("weight").alias("weights"), F.sum("n").alias("rows")).first()
    scale = (total if total is not None else sums.rows or 0.0) / (sums.weights or 1.0)
    rate = weighted.select("source", (F.col("weight") * F.lit(float(scale)) / F.col("n")).alias("rate"))
    parts = rate.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_RATE)).cast("int"))
    each = parts.withColumn("each", F.col("rate") / F.col("parts"))
    last = F.ceil(F.col("each") + 12 * F.sqrt("each") + 40).cast("int")
    start = F.array(F.exp(-F.col("each")))
    chance = F.aggregate(
        F.sequence(F.lit(1), last),
        start,
        lambda made, k: F.concat(made, F.array(F.element_at(made, -1) * F.col("each") / k)),
    )
    table = each.withColumn("chance", chance).select(
        "source", "parts",
        F.aggregate(
            "chance", F.array().cast("array<double>"),
            lambda made, p: F.concat(made, F.array(F.coalesce(F.try_element_at(made, F.lit(-1)), F.lit(0.0)) + p)),
        ).alias("cdf"),
    )
    return settle(table, "rates")


def uniform(seed: int, key: Column, part: Column) -> Column:
    """A number between 0 and 1 that follows from seed, key and part: 52 bits of an MD5."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("")), part.cast("string"))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def replicate(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    seed: int = 11,
    key: str = "doc_id",
    source: str = "source",
    temperature: float = 0.5,
    total: float | None = None,
) -> DataFrame:
    """``docs`` as often as drawn, with the number of the ``copy``, in a random order.

    Copies are dealt at random over all partitions and sorted by a hash there, so that
    reading the result from the first file to the last is a global shuffle. A document with
    number 0 is left out; that is what a rate below 1 means. The source table is joined by
    its measured size, and a source with many rows needs no shuffle of its own.

    Repeated rows with one key have the same number of copies each. Rows without a key count
    as one key, rows without a source as one source. An empty table gives an empty result.
    Other columns are passed through; one called ``copy`` is replaced.
    """
    docs = docs.drop("copy")
    table = rates(docs, weights, source, temperature, total).select(
        F.col("source").alias("__source"), F.col("parts").alias("__parts"), F.col("cdf").alias("__cdf")
    )
    joined = docs.join(table, F.col(source).eqNullSafe(F.col("__source")))
    number = F.aggregate(
        F.sequence(F.lit(0), F.col("__parts") - 1),
        F.lit(0),
        lambda made, part: made + F.size(F.filter("__cdf", lambda c: c <= uniform(seed, F.col(key), part))),
    )
    copies = joined.withColumn("__number", number).filter("__number > 0").select(
        *[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), "__number")).alias("copy")
    )
    place = F.xxhash64(F.lit(seed), F.rand(seed), F.col(key), "copy")
    return copies.withColumn("__place", place).repartition("__place").sortWithinPartitions("__place").drop("__place")
