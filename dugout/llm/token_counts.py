"""Token counts of whole texts: Arrow batches in, lengths out."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import encoding


def count_texts(texts: list[str | None], path: str) -> list[int]:
    """Tokens of whole texts."""
    return encoding.encoder(path, "count", len).texts(texts, encoding.spaced_chunks, sum)


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row of ``docs``.

    ``path`` is a byte-level vocabulary file that every worker can open. Counts are those of
    encoding the whole text without added begin or end tokens; the name of a special token
    inside a text counts as the library handles it by default. Texts of a group are cut into
    chunks at safe boundaries; those that the worker does not know are encoded in batches of
    equal bytes, filled across texts. A text of any length is counted segment by segment,
    wherever it has white space; without any it is one chunk. Nothing is shuffled and only the
    lengths leave the workers.

    A NULL text counts as an empty one: zero bytes, zero tokens. Repeated rows and rows
    without a key are counted like others, one result row each. An empty table gives an
    empty result. Other columns are not read, whatever their names are.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [n for some in encoding.groups(batch.column(1)) for n in count_texts(some, path)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())],
                ["key", "n_bytes", "n_tokens"],
            )

    schema = StructType(
        [
            StructField("key", docs.schema[key].dataType),
            StructField("n_bytes", LongType()),
            StructField("n_tokens", LongType()),
        ]
    )
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), size)
    return rows.mapInArrow(counted, schema).withColumnRenamed("key", key)
