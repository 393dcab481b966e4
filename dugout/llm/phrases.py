"""Collocations: phrases that occur far more often than their parts make likely.

Tasks count phrases in burst tries over word ids: below the first word lies a hash container of
the rest, which bursts into containers by the second word when it grows. When the tries are
full, their largest subtrees are spilled whole, as runs that are sorted by words; the runs of a
prefix are merged in one partition (a prefix is dealt to several by the word behind it, so that
a frequent one makes no large group).

Phrases are counted level by level: one of three words can occur ``least`` times only if both
pairs in it do. Pairs that do are marked in a bitmap of fixed size by their hashes. A mark too
many costs a count that is dropped later; no phrase is missed, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import settle

#: Bytes of text that are split at once.
SEGMENT_BYTES = 1 << 21
#: Entries of all tries of a task, about a hundred bytes each, before subtrees are spilled.
MOST_ENTRIES = 400_000
#: Entries of a container before it bursts.
MOST_IN_CONTAINER = 2048
#: Words that a task knows, and their bytes, before it starts afresh.
MOST_WORDS, MOST_WORD_BYTES = 400_000, 16_000_000
#: Partitions that one prefix is dealt to at most.
SALTS = 64
#: Bits of the bitmap of frequent pairs: 8 MB.
MAP_BITS = 26

_NONE, _BREAK, _FIRST_ID = 0, 1, 2
_ID_BITS = 21
_ID = (1 << _ID_BITS) - 1
#: One byte for one: A-Z in lower case, all marks that end a piece as line breaks, tabs as blanks.
_PLAIN = bytes(
    0x0A if chr(b) in ".,;:!?\n\v\f\r" else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


class Words(dict[bytes, int]):
    """Numbers of words in the order in which they come, and their hashes."""

    def __init__(self) -> None:
        from xxhash import xxh64_intdigest

        super().__init__({b"": _NONE, b"\n": _BREAK})
        # What is behind a phrase, and a break, are spelled by nothing.
        self.spelled = [b"", b""]
        self.hash, self.hashes, self.size = xxh64_intdigest, [0, 0], 0

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.spelled.append(word)
        self.hashes.append(self.hash(word))
        self.size += len(word)
        return number


def places(lang: str, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Bits of pairs of words, given by their hashes."""
    from xxhash import xxh64_intdigest

    own = np.uint64(xxh64_intdigest(lang.encode(), 1))
    mixed = (first ^ own) * np.uint64(0x9E3779B97F4A7C15)
    mixed = ((mixed ^ mixed >> np.uint64(29)) + second) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ mixed >> np.uint64(32)) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - MAP_BITS)).astype(np.int64)


class Trie:
    """Counts of phrases of one language: by first word, containers by the rest of the phrase.

    A rest is the second word's id, or that and the third one's. Containers of two words that
    have grown large are burst: a node by second word takes their place.
    """

    def __init__(self, rest_words: int):
        self.deep = rest_words == 2
        self.nodes: dict[int, dict] = {}
        self.burst: set[int] = set()
        self.sizes: dict[int, int] = {}
        self.entries = 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        """Add phrases, given sorted and without repeats."""
        bits = _ID_BITS * (1 + self.deep)
        for first, rest, times in _grouped(codes, counts, bits):
            before = self.sizes.get(first, 0)
            if first in self.burst:
                node, grown = self.nodes[first], 0
                for second, last, n in _grouped(np.array(rest), np.array(times), _ID_BITS):
                    grown += _count(node.setdefault(second, {}), last, n)
            else:
                container = self.nodes.setdefault(first, {})
                grown = _count(container, rest, times)
                if self.deep and len(container) > MOST_IN_CONTAINER:
                    node = {}
                    for code, n in container.items():
                        node.setdefault(code >> _ID_BITS, {})[code & _ID] = n
                    self.nodes[first] = node
                    self.burst.add(first)
            self.sizes[first] = before + grown
            self.entries += grown

    def largest(self, keep: int) -> list[int]:
        """First words whose subtrees have to go so that ``keep`` entries stay."""
        found, left = [], self.entries
        for first in sorted(self.sizes, key=self.sizes.__getitem__, reverse=True):
            if left <= keep:
                break
            found.append(first)
            left -= self.sizes[first]
        return found

    def taken(self, firsts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Codes and counts of whole subtrees, which are removed."""
        containers, bases = [], []
        for first in firsts:
            node, base = self.nodes.pop(first), first << _ID_BITS * (1 + self.deep)
            if first in self.burst:
                self.burst.discard(first)
                containers += node.values()
                bases += [base | second << _ID_BITS for second in node]
            else:
                containers.append(node)
                bases.append(base)
            self.entries -= self.sizes.pop(first)
        sizes = [len(c) for c in containers]
        codes = np.fromiter(chain.from_iterable(containers), np.int64, sum(sizes))
        counts = np.fromiter(chain.from_iterable([c.values() for c in containers]), np.int64, len(codes))
        return codes + np.repeat(np.array(bases, np.int64), sizes), counts


def _grouped(codes: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """The codes below each leading id, without it, and their counts."""
    leading = codes >> bits
    starts = np.flatnonzero(np.diff(leading, prepend=-1))
    rest, times = (codes & ((1 << bits) - 1)).tolist(), counts.tolist()
    for first, start, end in zip(leading[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(codes)]):
        yield first, rest[start:end], times[start:end]


def _count(container: dict[int, int], codes: list[int], counts: list[int]) -> int:
    """Add to a container; how many entries are new."""
    before = len(container)
    if not before:
        container.update(zip(codes, counts))
    else:
        get = container.get
        for code, n in zip(codes, counts):
            container[code] = get(code, 0) + n
    return len(container) - before


class Counter:
    """Counts the phrases of a task, of one and two words or of three, and hands on runs."""

    def __init__(self, words: int, marks: np.ndarray | None = None):
        self.longest, self.marks = words, marks
        self._reset()

    def _reset(self) -> None:
        self.words = Words()
        self.tries: dict[str, Trie] = {}
        self.totals: dict[str, int] = {}

    def _ids(self, data: bytes) -> Iterator[np.ndarray]:
        """Numbers of the words of ``data``, segment by segment, breaks among them.

        Arrow finds the different words of a segment, so that each is looked up once.
        """
        at, size = 0, len(data)
        while at < size:
            end = at + SEGMENT_BYTES
            if end < size:
                stops = [x for x in (data.find(b" ", end), data.find(b"\n", end)) if x >= 0]
                end = min(stops, default=size)
            segment = data[at:end].replace(b"\n", b" \n ") + b" "
            ends = np.flatnonzero(np.frombuffer(segment, np.uint8) == 0x20) + 1
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            words = pa.Array.from_buffers(
                pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(segment)]
            ).dictionary_encode()
            known = np.array([self.words[word[:-1]] for word in words.dictionary.to_pylist()], np.int64)
            ids = known[words.indices.to_numpy()]
            yield ids[ids != _NONE]
            at = end

    def _phrases(self, lang: str, ids: np.ndarray, new: int) -> np.ndarray:
        """Codes of the phrases that end in one of the last ``new`` words."""
        first = len(ids) - new
        if self.longest == 2:
            last = ids[first:]
            single = last[last >= _FIRST_ID]
            self.totals[lang] = self.totals.get(lang, 0) + len(single)
            a, b = ids[max(0, first - 1) : -1], ids[max(1, first) :]
            fine = (a >= _FIRST_ID) & (b >= _FIRST_ID)
            return np.concatenate([single << _ID_BITS, a[fine] << _ID_BITS | b[fine]])
        start = max(0, first - 2)
        a, b, c = ids[start:-2], ids[start + 1 : -1], ids[start + 2 :]
        fine = np.flatnonzero((a >= _FIRST_ID) & (b >= _FIRST_ID) & (c >= _FIRST_ID))
        hashes = np.array(self.words.hashes, np.uint64)
        here = np.flatnonzero((ids[start:-1] >= _FIRST_ID) & (ids[start + 1 :] >= _FIRST_ID))
        marked = np.zeros(max(0, len(ids) - start - 1), bool)
        bits = places(lang, hashes[ids[start:][here]], hashes[ids[start:][here + 1]])
        marked[here] = self.marks[bits >> 3] >> (bits & 7).astype(np.uint8) & 1
        fine = fine[marked[fine] & marked[fine + 1]]
        return a[fine] << 2 * _ID_BITS | b[fine] << _ID_BITS | c[fine]

    def add(self, lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        """Count texts; gives the runs that have to be spilled meanwhile."""
        data = b"\n".join(texts).translate(_PLAIN) + b"\n"
        carried = np.zeros(0, np.int64)
        for ids in self._ids(data):
            codes = self._phrases(lang, np.concatenate([carried, ids]), len(ids))
            carried = np.concatenate([carried, ids])[-self.longest + 1 :]
            codes, counts = np.unique(codes, return_counts=True)
            if lang not in self.tries:
                self.tries[lang] = Trie(self.longest - 1)
            self.tries[lang].add(codes, counts)
            if len(self.words) > MOST_WORDS or self.words.size > MOST_WORD_BYTES:
                spelled = [w for w in carried.tolist()]
                back = {n: w for w, n in self.words.items() if n in spelled}
                yield from self.rest()
                carried = np.array([self.words[back[n]] for n in spelled], np.int64)
            while sum(t.entries for t in self.tries.values()) > MOST_ENTRIES:
                name = max(self.tries, key=lambda x: self.tries[x].entries)
                trie = self.tries[name]
                yield from self._run(name, *trie.taken(trie.largest(trie.entries // 2)))

    def rest(self) -> Iterator[pa.RecordBatch]:
        """Everything that is held; the counter is empty then."""
        for lang, trie in self.tries.items():
            yield from self._run(lang, *trie.taken(list(trie.nodes)))
        for lang, n in self.totals.items():
            yield _rows(lang, pa.array([""]), pa.array([""]), np.array([n]))
        self._reset()

    def _run(self, lang: str, codes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A run of subtrees in the order of their words. What is behind a first word alone is empty."""
        if not len(codes):
            return
        ids = [codes >> _ID_BITS * i & _ID for i in reversed(range(self.longest))]
        held = np.zeros(len(self.words), bool)
        for i in ids:
            held[i] = True
        held = np.flatnonzero(held)
        spelled = pa.array([self.words.spelled[i] for i in held.tolist()], pa.binary())
        by_bytes = pc.sort_indices(spelled)
        order = np.zeros(len(self.words), np.int64)
        order[held[by_bytes.to_numpy()]] = np.arange(len(held))
        spelled = spelled.take(by_bytes).cast(pa.string())
        ids = [order[i] for i in ids]
        place = ids[0]
        for i in ids[1:]:
            place = place << _ID_BITS | i
        place = np.argsort(place)
        parts = [spelled.take(pa.array(i[place])) for i in ids]
        prefix = parts[0] if len(parts) == 2 else pc.binary_join_element_wise(*parts[:2], " ")
        yield _rows(lang, prefix, parts[-1], counts[place])


def _rows(lang: str, prefix: pa.Array, last: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    langs = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(counts), np.int32)), pa.array([lang]))
    columns = [langs.cast(pa.string()), prefix, last, pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "prefix", "last", "n"])


def _runs(docs: DataFrame, words: int, marks: np.ndarray | None) -> DataFrame:
    """Sorted runs of all tasks: ``lang``, ``prefix`` (all words but the last), ``last``, ``n``.

    The row of empty words has the number of all words of a language.
    """
    shared = None if marks is None else docs.sparkSession.sparkContext.broadcast(marks)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(words, None if shared is None else shared.value)
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            texts = batch.column(1).cast(pa.binary())
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                own = texts.filter(pc.equal(langs.indices, i)).to_pylist()
                yield from counter.add(lang, own)
        yield from counter.rest()

    return docs.mapInArrow(counted, "lang string, prefix string, last string, n long")


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """The runs of each prefix merged: ``lang``, ``phrase``, ``words`` and ``n`` of frequent ones."""
    salt = F.pmod(F.xxhash64("last"), F.lit(SALTS))
    dealt = runs.withColumn("salt", salt).repartition("lang", "prefix", "salt")
    counts = dealt.groupBy("lang", "prefix", "salt", "last").agg(F.sum("n").alias("n"))
    phrase = F.when(F.col("last") == "", F.col("prefix")).otherwise(F.concat_ws(" ", "prefix", "last"))
    words = F.when(F.col("prefix") == "", 0).otherwise(F.size(F.split(phrase, " ")))
    kept = counts.filter((F.col("n") >= least) | (F.col("prefix") == ""))
    return kept.select("lang", phrase.alias("phrase"), words.alias("words"), "n")


def _marks(pairs: DataFrame) -> np.ndarray:
    """The bitmap of pairs of words (``lang``, ``phrase``), of fixed size."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            hashes = np.array(
                [[xxh64_intdigest(w) for w in p.encode().split(b" ")] for p in batch.column(1).to_pylist()], np.uint64
            ).reshape(-1, 2)
            index = langs.indices.to_numpy()
            bits = np.zeros(len(index), np.int64)
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                own = index == i
                bits[own] = places(lang, hashes[own, 0], hashes[own, 1])
            yield pa.RecordBatch.from_arrays([pa.array(bits)], ["bit"])

    bit = F.col("bit") + 1  # Spark numbers bits from 1
    bits = pairs.select("lang", "phrase").mapInArrow(placed, "bit long")
    bits = bits.select(F.bitmap_bucket_number(bit).alias("part"), F.bitmap_bit_position(bit).alias("bit"))
    made = np.zeros(1 << MAP_BITS - 3, np.uint8)
    # 2048 parts of 4 kB at most, however many pairs there are.
    for row in bits.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        at = (row.part - 1) * 4096
        made[at : at + 4096] = np.frombuffer(row.bits, np.uint8)
    return made


def phrase_counts(
    docs: DataFrame, least: int = 10, longest: int = 3, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``lang``, ``phrase``, ``words`` and ``n`` of all phrases of up to ``longest`` words (2 or 3)
    that occur ``least`` times, stored; the phrase of no words has the number of all words.

    Texts are split at ``.,;:!?`` and line breaks into pieces and these at blanks and tabs into
    words, with A-Z in lower case. Phrases are counted within pieces, overlaps included.
    """
    if longest not in (2, 3) or least < 1:
        raise ValueError("phrases have 2 or 3 words and occur once at least")
    rows = docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    counts = settle(_merged(_runs(rows, 2, None), least), "pairs")
    if longest == 2:
        return counts
    marks = _marks(counts.filter("words = 2"))
    return counts.unionByName(settle(_merged(_runs(rows, 3, marks), least).filter("words = 3"), "triples"))


def _part(start: int | Column, size: int | Column) -> Column:
    return F.array_join(F.slice("split", start, size), " ")


def collocations(
    docs: DataFrame,
    most: int = 2000,
    least: int = 10,
    longest: int = 3,
    inside: float = 0.5,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The ``most`` best phrases of every language: ``lang``, ``rank`` from 1, ``phrase``, ``a``,
    ``l``, ``r``, ``n`` and ``score``.

    A phrase of 2 to ``longest`` words with ``a`` >= ``least`` occurrences is cut in two in all
    ways; the score of a cut is floor(1000000 a a / (l r)) with the occurrences of its parts, in
    exact decimals, and the lowest one counts, of equal ones that behind the fewest words. A
    phrase that lies in a longer one which occurs at least ``inside`` times as often is left
    out. Equal scores go by ``a``, then by the bytes of the phrase. ``n`` counts all words.

    Whole texts of any length are counted; a NULL text has no words, and a NULL language is
    ``und``. Repeated rows count each time. An empty table gives an empty result, and so has a
    language without frequent phrases no rows. Other columns are not read.
    """
    counts = phrase_counts(docs, least, longest, text, lang)
    split = F.split("phrase", " ")
    frequent = settle(
        counts.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), split.alias("split")),
        "frequent",
    )
    known = counts.filter("words > 0").select("lang", "phrase", "n")
    # All ways to cut a phrase, with the counts of both parts.
    cuts = frequent.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _part(1, F.col("k")).alias("left"),
        _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        part = known.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
        cuts = cuts.join(part, ["lang", side])
    exact = {c: F.col(c).cast("decimal(18,0)") for c in "alr"}
    score = F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (exact["a"] * exact["a"]), exact["l"] * exact["r"])
    lowest = F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest)
    # Phrases that lie in longer ones, which may be left out themselves.
    inner = frequent.filter("words > 2").select(
        "lang", F.col("a").alias("longer"), "split", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"), "words"
    )
    inner = inner.select("lang", "longer", "split", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("start"))
    inner = inner.select("lang", _part(F.col("start"), F.col("size")).alias("phrase"), "longer")
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = 100 * F.coalesce("longer", F.lit(0)) >= F.lit(round(100 * inside)) * F.col("a")
    kept = scored.join(inner, ["lang", "phrase"], "left").filter(~covered)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    first = kept.withColumn("rank", place).filter(F.col("rank") <= most)
    total = counts.filter("words = 0").select("lang", "n")
    return first.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
