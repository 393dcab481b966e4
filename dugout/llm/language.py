"""Language of whole texts: known words first, shorter and shorter character n-grams else.

A model is a sorted array of entries, words and n-grams by their 64-bit hashes, each with the
languages that have it and how often. What a language does not have costs nothing, so the size
follows from the learned texts alone, not from the number of languages.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType
from xxhash import xxh64_intdigest

from . import encoding
from .common import in_worker, settle
from .memory import BYTES, Recent

UNDETERMINED = "und"
#: Labelled documents per language that the model is fitted on, by the smallest key hashes.
FIT_DOCUMENTS = 1000
#: Lengths of the n-grams, in the order in which they are tried; 0 stands for whole words.
ORDERS = (5, 4, 3, 2, 1)
SMOOTHING = 0.5

_RUN = re.compile(r"[^\W\d_]+")
#: What adds to a text's sums: a language or, behind the languages, the order that decides a word.
_PART = np.dtype([("at", "<i4"), ("weight", "<f8")])


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters. Numbers that are no digits, such as fractions, are none."""
    text = text.lower()
    if text.isalpha():
        return [text]
    runs = _RUN.findall(text)
    if all(map(str.isalpha, runs)):
        return runs
    return [w for r in runs for w in "".join(c if c.isalpha() else " " for c in r).split()]


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its ends marked; single letters without the marks."""
    marked = word if n == 1 else f"\x02{word}\x03"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def entry_hash(order: int, entry: str) -> int:
    """The hash of an entry, as Spark's ``xxhash64`` gives it for the two joined."""
    return xxh64_intdigest(f"{order}{entry}", 42)


@dataclass(frozen=True)
class Model:
    """Counts of entries by language.

    The languages ``places[starts[i] : starts[i + 1]]`` have the entry with the hash ``keys[i]``
    so often as ``counts`` says. ``floor`` has by order and language the log frequency of an
    entry that the language has not.
    """

    languages: tuple[str, ...]
    keys: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    counts: np.ndarray
    floor: np.ndarray

    def found(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of entries, -1 for unknown ones."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)

    def parts(self, words: list[str]) -> list[np.ndarray]:
        """What each word adds, worked out for all of them at once.

        A known word has its own log frequencies; another one the mean of those of its longest
        n-grams of which one at least is known. Log frequencies are kept as the order's floor
        and what the entry has above it.
        """
        base, orders = len(self.languages), (0, *ORDERS)
        decided = np.full(len(words), len(orders))
        owner, at, weight = [], [], []
        left = np.arange(len(words))
        for place, n in enumerate(orders):
            if not len(left):
                break
            prefix = str(n)
            shown = [[words[i]] if n == 0 else grams(words[i], n) for i in left.tolist()]
            sizes = np.array([len(s) for s in shown])
            hashes = [xxh64_intdigest(prefix + g, 42) for s in shown for g in s]  # entry_hash, of very many
            hashes = np.array(hashes, np.uint64)
            entry = self.found(hashes)
            which = np.repeat(np.arange(len(left)), sizes)
            known = entry >= 0
            sure = np.unique(which[known])
            decided[left[sure]] = place
            entry, which = entry[known], which[known]
            many = self.starts[entry + 1] - self.starts[entry]
            rows = np.repeat(self.starts[entry], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            which = np.repeat(which, many)
            owner.append(left[which])
            at.append(self.places[rows])
            weight.append(np.log1p(self.counts[rows] / SMOOTHING) / sizes[which])
            left = np.delete(left, sure)
        owner = np.concatenate([np.arange(len(words)), *owner])
        made = np.zeros(len(owner), _PART)
        made["at"] = np.concatenate([base + decided, *at])
        made["weight"] = np.concatenate([np.ones(len(words)), *weight])
        order = np.argsort(owner, kind="stable")
        made, ends = made[order], np.searchsorted(owner[order], np.arange(len(words) + 1))
        return [made[a:b] for a, b in pairwise(ends.tolist())]

    def sums(self, parts: np.ndarray) -> np.ndarray:
        """By language what its entries are above the floor, and how many words each order decided."""
        return np.bincount(parts["at"], parts["weight"], len(self.languages) + len(ORDERS) + 2)


class Scorer:
    """Judges texts by their words; what runs between white space add is remembered."""

    def __init__(self, model: Model, size: int = BYTES):
        self.model = model
        self.known: Recent[str, bytes] = Recent(self._learnt, size)

    def _learnt(self, chunks: list[str]) -> dict[str, bytes]:
        shown = [words_of(c) for c in chunks]
        words = list({w for s in shown for w in s})
        parts = {w: p.tobytes() for w, p in zip(words, self.model.parts(words))}
        return {c: b"".join([parts[w] for w in s]) for c, s in zip(chunks, shown)}

    def _sums(self, texts: list[str | None]) -> list[np.ndarray]:
        shown: list[str] = []
        ends = [0]
        for text in texts:
            shown += text.split() if text else ()
            ends.append(len(shown))
        parts = self.known.values_of(shown)
        return [self.model.sums(np.frombuffer(b"".join(parts[a:b]), _PART)) for a, b in pairwise(ends)]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, int]]:
        """Language of each text, its probability among the learned languages, and its words."""
        if len(texts) == 1 and texts[0] and len(texts[0]) > encoding.SEGMENT_CHARS:
            # A long text is read segment by segment.
            return [self._judged(sum(self._sums([s])[0] for s in encoding.segments(texts[0])))]
        return [self._judged(sums) for sums in self._sums(texts)]

    def _judged(self, sums: np.ndarray) -> tuple[str, float, int]:
        base = len(self.model.languages)
        words = round(sums[base:].sum())
        if not words or not base:
            return UNDETERMINED, 0.0, words
        # The last place counts words of which nothing is known; they speak for no language.
        total = sums[:base] + sums[base:-1] @ self.model.floor
        odds = np.exp(total - total.max())
        best = int(odds.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum()), words


def _sample(docs: DataFrame, learn_from: Column, key: str, text: str, lang: str, most: int) -> DataFrame:
    """At most ``most`` different keys of each language, those with the smallest hashes.

    Hashes are compared before texts are read, and a key that repeats counts once.
    """
    labelled = docs.filter(learn_from).select(
        F.col(lang).alias("lang"), F.xxhash64(key).alias("hash"), F.col(text).alias("text")
    ).filter("lang is not null")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    least = labelled.select("lang", "hash").distinct().withColumn("place", place).filter(f"place <= {most}")
    limits = settle(least.groupBy("lang").agg(F.max("hash").alias("limit")), "limits")
    chosen = labelled.join(limits, "lang").filter("hash <= limit and text is not null")
    return chosen.groupBy("lang", "hash").agg(F.min("text").alias("text"))


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words: Counter[tuple[str, str]] = Counter()
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            words.update((lang, w) for s in encoding.segments(text) for w in words_of(s))
    counts: Counter[tuple[str, int, str]] = Counter()
    for (lang, word), n in words.items():
        counts[lang, 0, word] += n
        for order in ORDERS:
            for gram in grams(word, order):
                counts[lang, order, gram] += n
    rows = [(*k, n) for k, n in counts.items()]
    yield pd.DataFrame(rows, columns=["lang", "order", "entry", "n"])


def fit(
    docs: DataFrame,
    learn_from: Column,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    most: int = FIT_DOCUMENTS,
) -> Model:
    """A model of the labelled rows where ``learn_from`` holds.

    It is fitted on ``most`` whole documents a language, and keeps all words and n-grams of
    them: twelve bytes for each and six more for each language that has it. Rows without a
    language or a text teach nothing. Without any labelled row the model knows no language.
    """
    counts = (
        _sample(docs, learn_from, key, text, lang, most)
        .mapInPandas(_counted, "lang string, `order` int, entry string, n long")
        .groupBy("lang", "order", "entry").agg(F.sum("n").alias("n"))
    )
    counts = settle(counts, "entries")
    sums = counts.groupBy("lang", "order").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).collect()
    languages = tuple(sorted({r.lang for r in sums}))
    total = np.ones((len(ORDERS) + 1, len(languages)))
    for r in sums:
        total[(0, *ORDERS).index(r.order), languages.index(r.lang)] = r.total + SMOOTHING * (r.kinds + 1)
    numbers = docs.sparkSession.createDataFrame([*enumerate(languages)], "place int, lang string")
    hashed = F.xxhash64(F.concat(F.col("order").cast("string"), "entry")).alias("key")
    rows = counts.join(F.broadcast(numbers), "lang").select(hashed, F.col("place").cast("short"), F.col("n").cast("int"))
    rows = rows.toArrow()  # numbers only, of the bounded sample
    keys = rows["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys, kind="stable")
    keys, first = np.unique(keys[order], return_index=True)
    places, n = (rows[c].to_numpy()[order] for c in ("place", "n"))
    return Model(languages, keys, np.append(first, len(order)).astype(np.int32), places, n, np.log(SMOOTHING / total))


def _judged(docs: DataFrame, model: Model, text: str) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``__words``, the number of words."""
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    at = docs.columns.index(text)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = in_worker(name, lambda: Scorer(shared.value))
        for batch in batches:
            found = [x for some in encoding.groups(batch.column(at)) for x in scorer.predict(some)]
            langs, scores, words = zip(*found) if found else ((), (), ())
            yield (
                batch.append_column("lang_pred", pa.array(langs, pa.string()))
                .append_column("score", pa.array(scores, pa.float64()))
                .append_column("__words", pa.array(words, pa.int64()))
            )

    more = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("__words", LongType())]
    return docs.mapInArrow(judged, StructType([*docs.schema.fields, *more]))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced.

    A letter is what Unicode calls one. A NULL text or one without a letter has the language
    ``und`` and score 0, and so has every text if the model knows no language. Equal scores go
    to the first language by name. Every row is judged by its own whole text, repeated ones
    alike; a very long text is judged as a whole, its words are held in memory. An empty table
    gives an empty result.
    """
    return _judged(docs.drop("lang_pred", "score"), model, text).drop("__words")


def remainder(key: str = "doc_id", of: int = 4) -> Column:
    """crc32 of the key as text, modulo ``of``; NULL without a key."""
    return F.crc32(F.col(key).cast("string")) % of


def fit_and_predict(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", held_out: int = 2
) -> DataFrame:
    """``key``, ``held_out``, ``lang_pred`` and ``score`` of every row.

    The model learns from rows whose key's remainder is not ``held_out``. Rows without a key
    teach nothing and are not held out. Only text is an input of a prediction.
    """
    model = fit(docs, remainder(key) != held_out, key, text, lang)
    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(remainder(key) == held_out, F.lit(False)).alias("held_out"),
        F.col(text).alias("text"),
    )
    return predict(rows, model).drop("text").withColumnRenamed("key", key)


def keep_determined(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", held_out: int = 2
) -> DataFrame:
    """``docs`` without the rows whose language cannot be told, all columns as they were.

    These are NULL texts and those without a letter. If the model knows no language, since no
    row that it may learn from is labelled, all other texts are kept too. Repeated rows are
    kept or go together; an empty table gives an empty result.
    """
    model = fit(docs, remainder(key) != held_out, key, text, lang)
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    return _judged(rows, model, "text").filter("__words > 0").select("row.*")
