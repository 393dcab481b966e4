"""Changes of the fields of JSON messages from batch to batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def batch_fields(messages: DataFrame, batch: str, value: str) -> DataFrame:
    """``batch``, ``field`` and ``kind``, the type that all of a batch's values of it have.

    Fields are those at the top of the messages' objects; a field that holds objects has
    their merged schema as its kind. Messages that are no JSON objects have no fields, nor has
    a field that is NULL in all messages a kind other than VOID.
    """
    parsed = messages.select(F.col(batch).alias("batch"), F.try_parse_json(F.col(value)).alias("v"))
    objects = parsed.filter(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))
    fields = objects.sparkSession.sql(
        "SELECT batch, e.key AS field, e.value AS held FROM {objects}, LATERAL variant_explode(v) AS e", objects=objects
    )
    return fields.groupBy("batch", "field").agg(F.schema_of_variant_agg("held").alias("kind"))


def field_changes(fields: DataFrame) -> DataFrame:
    """``batch``, ``field``, ``change`` (added, removed or retyped), ``before`` and ``after``:
    each batch against the one before it. ``fields`` has a line per batch and field."""
    batches = fields.select("batch").distinct()
    # One line per batch, so the one window over all of them is small.
    order = batches.withColumn("earlier", F.lag("batch").over(Window.orderBy("batch"))).filter("earlier is not null")
    old = fields.select(F.col("batch").alias("earlier"), "field", F.col("kind").alias("before"))
    before = order.join(old, "earlier").select("batch", "field", "before")
    after = order.select("batch").join(fields, "batch").select("batch", "field", F.col("kind").alias("after"))
    change = (
        F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed")
        .when(F.col("before") != F.col("after"), "retyped")
    )
    both = before.join(after, ["batch", "field"], "full").withColumn("change", change)
    return both.filter("change is not null").select("batch", "field", "change", "before", "after")
