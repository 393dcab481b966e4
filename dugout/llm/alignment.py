"""Alignment of two tokenizers' tokens over the same texts.

Where tokens of both vocabularies that carry a leading space start at the same byte, both have
ended before it: these verified ends split the text into windows of token ids, mostly of a word
each. What a window's tokens have in common depends on its ids alone.

Texts with single blanks between their words can be cut before each blank, since no token of
either kind reaches over it: a word with its blank is a window. The different words of a block
of texts are encoded and aligned once. Other texts are encoded as a whole, and their windows are
remembered by their ids.

Corpus-wide counts of linked ids are gathered by blocks of texts: a block has each linked pair
once, and its texts refer to the pair's place. So the join with the counts has a row per pair
and block, not one per pair and text, and a pair that every text holds is no hot key.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from .byte_bpe import PATTERN
from .common import give_back, in_worker, settle
from .encoding import byte_of, groups
from .memory import Recent

#: Bytes of the texts of one block; a longer text is a block of its own.
BLOCK_CHARS = 1 << 21
#: Bytes of texts whose windows are sought together; a longer text is alone.
GROUP_CHARS = 1 << 18
#: Characters of words that are encoded and aligned together.
ENCODED_CHARS = 1 << 16
#: Links of words that are put in their places together, and the most that one word may have.
PLACED_LINKS, WORD_LINKS = 1 << 18, 128
#: Windows with more ids of either kind are not remembered.
LONG_WINDOW = 32
#: Bytes of remembered windows in a worker process.
WINDOW_BYTES = 80_000_000
_MARK = "▁"
#: What stands between the ids of both kinds in a remembered window; no vocabulary has it.
_BETWEEN = 0xFFFFFFFF
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
#: Characters whose class can differ between the libraries' versions of Unicode.
_OTHER = re.compile("[^\x00-\u024f]")
#: What keeps a text from being cut before each blank: tokens could reach over the cut.
_ODD = re.compile(r"\A | \Z| \s|[^\x00-\u024f]")

#: What a window's ids have in common: its groups as text, with a mark behind the last one too,
#: and its links one after another, the first id times 2^32 plus the second, as bytes.
Window = tuple[str, bytes]
#: What is found of a text: how many ids of either kind it has, its groups as text, its
#: different linked pairs, and how often each is linked.
Found = tuple[int, int, str, np.ndarray, np.ndarray]


class Pair:
    """Two vocabularies, and the windows that this worker process has aligned lately."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(byte_level)
        self.first.encode_special_tokens = True
        self.second = SentencePieceProcessor(model_file=pieces)
        names = [self.first.id_to_token(i) or "" for i in range(self.first.get_vocab_size())]
        shown = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.bytes = [_level_bytes(n) for n in names], [_piece_bytes(n) for n in shown]
        self.lengths = [np.array([len(t) for t in x], np.int64) for x in self.bytes]
        self.spaced = [np.array([t[:1] == b" " for t in x]) for x in self.bytes]
        self.shown = [f"{i}{mark}" for i in range(max(map(len, self.bytes))) for mark in ",|;"]
        self.windows: Recent[bytes, Window] = Recent(self._aligned, WINDOW_BYTES, _weight)
        # No piece reaches from another character to a blank, so words' pieces are the text's.
        self.cuttable = not any(_MARK in name.lstrip(_MARK) for name in shown)
        self.marked = pa.array(self.shown)
        # The same vocabulary in the library that is quicker; added names are no tokens of it.
        added = self.first.get_added_tokens_decoder()
        ranks = {_level_bytes(n): i for i, n in enumerate(names) if i not in added}
        self.quick = Encoding("same", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the whole text by both vocabularies; none if they don't stand for its bytes."""
        said = " " + text
        if _OTHER.search(text) is None:
            a = self.quick.encode_to_numpy(said, disallowed_special=())  # all bytes, whatever they are
            fine = True
        else:
            ids = self.first.encode_batch_fast([said], add_special_tokens=False)[0].ids
            a, fine = np.array(ids, np.uint32), self._say(0, ids, said)
        b = self.second.encode(text)
        if not (fine and self._say(1, b, said)):
            return a[:0], a[:0]
        return a, np.array(b, np.uint32)

    def _say(self, side: int, ids: list[int], text: str) -> bool:
        return b"".join(map(self.bytes[side].__getitem__, ids)) == text.encode()

    def _groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids of either kind lie before the end of each group of ids."""
        ends = [np.cumsum(self.lengths[i][x]) for i, x in enumerate((a, b))]
        shared = np.intersect1d(*ends, assume_unique=True)
        return np.searchsorted(ends[0], shared) + 1, np.searchsorted(ends[1], shared) + 1

    def _marked(self, a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> np.ndarray:
        """Group by group, which of the decimal ids with the mark behind it."""
        marked = np.zeros(len(a) + len(b), np.int64)
        for ids, ends, others, mark in ((a, to_a, np.append(0, to_b)[:-1], 1), (b, to_b, to_a, 2)):
            sizes = np.diff(ends, prepend=0)
            codes = ids.astype(np.int64) * 3
            codes[ends - 1] += mark
            marked[np.arange(len(ids)) + np.repeat(others, sizes)] = codes
        return marked

    def _texts(self, a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> list[str]:
        """Decimal ids group by group, each with the mark behind it."""
        return list(map(self.shown.__getitem__, self._marked(a, b, to_a, to_b).tolist()))

    @staticmethod
    def _links(a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The links of all groups, and how many lie before the end of each group."""
        sizes = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        many = sizes[0] * sizes[1]
        to_links = np.cumsum(many)
        group = np.repeat(np.arange(len(many)), many)
        inside = np.arange(len(group)) - (to_links - many)[group]
        left = a[(to_a - sizes[0])[group] + inside // sizes[1][group]].astype(np.int64)
        right = b[(to_b - sizes[1])[group] + inside % sizes[1][group]]
        return left << 32 | right, to_links

    def _aligned(self, windows: list[bytes]) -> dict[bytes, Window]:
        """Groups and links of each window, worked out for all of them at once."""
        ids = np.frombuffer(b"".join(windows), np.uint32)
        ends = np.cumsum([len(w) // 4 for w in windows])
        middle = np.flatnonzero(ids == _BETWEEN)
        first = middle - np.append(0, ends[:-1])  # ids of either kind in each window
        second = ends - middle - 1
        sides = np.repeat(np.tile([0, 2, 1], len(windows)), np.stack([first, np.ones_like(first), second], 1).ravel())
        a, b = ids[sides == 0], ids[sides == 1]
        to_a, to_b = self._groups(a, b)
        linked, to_links = self._links(a, b, to_a, to_b)
        links = linked.tobytes()
        shown = self._texts(a, b, to_a, to_b)
        texts = [0, *np.cumsum(first + second).tolist()]
        places = [0, *(8 * to_links[np.searchsorted(to_a, np.cumsum(first))]).tolist()]
        return {
            w: ("".join(shown[i:k]), links[j:m])
            for w, (i, k), (j, m) in zip(windows, pairwise(texts), pairwise(places))
        }

    def _long(self, window: bytes) -> tuple[str, Counter[int]]:
        """Groups and links of a long window; a group's ids are counted before they are linked."""
        ids = np.frombuffer(window, np.uint32)
        middle = int(np.flatnonzero(ids == _BETWEEN)[0])
        a, b = ids[:middle], ids[middle + 1 :]
        to_a, to_b = self._groups(a, b)
        links: Counter[int] = Counter()
        for (i, k), (j, m) in zip(pairwise([0, *to_a.tolist()]), pairwise([0, *to_b.tolist()])):
            others = Counter(b[j:m].tolist()).items()
            for x, n in Counter(a[i:k].tolist()).items():
                for y, times in others:
                    links[x << 32 | y] += n * times
        return "".join(self._texts(a, b, to_a, to_b)), links

    def _starts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Where the windows of texts that follow each other begin in ``a`` and ``b``, and their sizes.

        They begin where tokens of both kinds that carry a blank start at the same byte.
        """
        ids, starts = (a, b), []
        for i in (0, 1):
            lengths = self.lengths[i][ids[i]]
            starts.append(np.cumsum(lengths) - lengths)
        marked = [starts[i][self.spaced[i][ids[i]]] for i in (0, 1)]
        shared = np.intersect1d(*marked, assume_unique=True)
        first, second = (np.searchsorted(starts[i], shared) for i in (0, 1))
        return first, second, [np.diff(x, append=len(y)) for x, y in ((first, a), (second, b))]

    def _windows(self, a: np.ndarray, b: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The windows of texts that follow each other, their places in ``a``, and their sizes."""
        first, second, sizes = self._starts(a, b)
        # Window by window: ids of A, a word between, ids of B.
        number = np.arange(len(first))
        laid = np.full(len(a) + len(b) + len(first), _BETWEEN, np.uint32)
        laid[np.arange(len(a)) + np.repeat(second + number, sizes[0])] = a
        laid[np.arange(len(b)) + np.repeat(first + sizes[0] + number + 1, sizes[1])] = b
        data = laid.tobytes()
        cuts = [*(4 * (first + second + number)).tolist(), len(data)]
        return [data[i:k] for i, k in pairwise(cuts)], first, np.maximum(*sizes)

    def align(self, encoded: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[str, np.ndarray, np.ndarray]]:
        """For each text that has tokens: groups as text, its linked pairs, and the links of each."""
        a, b = (np.concatenate([x[i] for x in encoded]) for i in (0, 1))
        windows, first, sizes = self._windows(a, b)
        long = np.flatnonzero(sizes > LONG_WINDOW).tolist()
        if long:
            skipped = set(long)
            found = self.windows.values_of([w for i, w in enumerate(windows) if i not in skipped])
        else:
            found = self.windows.values_of(windows)
        extra = []
        for i in long:  # in order, so that places are right
            groups, links = self._long(windows[i])
            found.insert(i, (groups, b""))
            extra.append(links)
        # A text begins with a blank and so with a window.
        behind = np.append(np.searchsorted(first, np.cumsum([0, *(len(x) for x, _ in encoded[:-1])])), len(windows))
        shown, linked = zip(*found)
        pairs = np.frombuffer(b"".join(linked), np.int64)
        text = np.repeat(np.arange(len(encoded)), np.diff(behind))
        owner = np.repeat(text, np.fromiter(map(len, linked), np.int64, len(linked)) >> 3)
        times = np.ones(len(pairs), np.int64)
        for i, links in zip(long, extra):
            pairs = np.append(pairs, np.fromiter(links.keys(), np.int64, len(links)))
            times = np.append(times, np.fromiter(links.values(), np.int64, len(links)))
            owner = np.append(owner, np.full(len(links), text[i]))
        order = np.lexsort((pairs, owner))
        pairs, owner, times = pairs[order], owner[order], times[order]
        firsts = np.flatnonzero((np.diff(pairs, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
        pairs, owner, times = pairs[firsts], owner[firsts], np.add.reduceat(times, firsts)
        ends = np.searchsorted(owner, np.arange(len(encoded) + 1)).tolist()
        return [
            ("".join(shown[i:k])[:-1], pairs[j:m], times[j:m])
            for (i, k), (j, m) in zip(pairwise(behind.tolist()), pairwise(ends))
        ]


    def by_words(self, texts: list[str]) -> list[Found | None]:
        """What is found of texts that can be cut before each blank; None for the others.

        Every different word of the texts is encoded and aligned once, with the blank before it:
        it is a window. Words are aligned in portions, so that a block takes little more memory
        than what is found of it. Arrow puts that in the places of all its occurrences.
        """
        found: list[Found | None] = [None] * len(texts)
        fit = [i for i, t in enumerate(texts) if _ODD.search(t) is None] if self.cuttable else []
        if not fit:
            return found
        split = pc.split_pattern(pa.array([texts[i] for i in fit], pa.string()), " ")
        coded = split.flatten().dictionary_encode()
        parts = []
        for words in _portions(coded.dictionary):
            part = self._words(words)
            if part is None:
                return found
            parts.append(part)
        *numbers, shown = zip(*parts)
        long, n_a, n_b, n_links, links = map(np.concatenate, numbers)
        shown = pa.concat_arrays(shown)
        del parts, numbers
        at = split.offsets.to_numpy()
        index = coded.indices.to_numpy()
        crossed, *counts = (np.diff(np.append(0, np.cumsum(n[index]))[at]).tolist() for n in (long, n_a, n_b))
        shown = _joined(shown.take(coded.indices), at)
        linked = _placed(links, n_links, index, at)
        for i, cross, a, b, groups, (pairs, times) in zip(fit, crossed, *counts, shown, linked):
            found[i] = None if cross else (a, b, groups.as_py()[:-1], pairs, times)
        return found

    def _words(self, words: list[str]) -> tuple[np.ndarray | pa.Array, ...] | None:
        """What is found of words that are encoded together; None if they are not windows.

        Which of them are left out, and so are the texts that have them, for they are long or
        have many links; how many ids of either kind and links each of the others has; their
        links one after another; and the groups of each as text.
        """
        a, b = self.encode(" ".join(words))
        if not len(a):
            return None
        _, _, sizes = self._starts(a, b)
        if len(sizes[0]) != len(words):
            return None
        long = np.maximum(*sizes) > LONG_WINDOW
        for last in (False, True):
            own = [np.where(long, 0, n) for n in sizes]
            ids = [x[np.repeat(~long, n)] for x, n in zip((a, b), sizes)]
            to_ids = self._groups(*ids)
            before = np.append(0, np.cumsum(np.prod([np.diff(t, prepend=0) for t in to_ids], axis=0)))
            n_links = np.diff(before[np.searchsorted(to_ids[0], np.cumsum(own[0]), "right")], prepend=0)
            more = n_links > WORD_LINKS
            if last or not more.any():
                break
            long |= more
        shown = self.marked.take(pa.array(self._marked(*ids, *to_ids)))
        shown = _joined(shown, np.append(0, np.cumsum(own[0] + own[1])))
        return long, *own, n_links, self._links(*ids, *to_ids)[0], shown


def _placed(
    links: np.ndarray, n_links: np.ndarray, index: np.ndarray, at: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The different pairs of each text and how often it has them.

    ``links`` are those of the different words, ``n_links`` of each; ``index`` has the words of
    the texts, ``at`` where each text's begin and the last end.
    """
    different, place = _coded(links)
    words = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_links)), pa.int32()), pa.array(place, pa.int32()))
    before = np.append(0, np.cumsum(n_links[index]))[at]
    start = 0
    while start < len(at) - 1:
        stop = max(start + 1, int(np.searchsorted(before, before[start] + PLACED_LINKS, "right")) - 1)
        own = index[at[start] : at[stop]]
        if stop == start + 1:  # maybe a long text: its words are counted before they are linked
            weights = np.repeat(np.bincount(own, minlength=len(n_links)), n_links)
            times = np.bincount(place, weights, len(different)).astype(np.int64)
            placed = np.flatnonzero(times)
            yield different[placed], times[placed]
        else:
            owner = np.repeat(np.arange(stop - start), np.diff(before[start : stop + 1]))
            keys = np.sort(owner * len(different) + words.take(pa.array(own)).flatten().to_numpy())
            firsts = np.flatnonzero(np.diff(keys, prepend=-1))
            times = np.diff(firsts, append=len(keys))
            owner, placed = np.divmod(keys[firsts], len(different))
            cuts = np.searchsorted(owner, np.arange(stop - start + 1)).tolist()
            pairs = different[placed]
            yield from ((pairs[i:k], times[i:k]) for i, k in pairwise(cuts))
        start = stop


def _portions(words: pa.Array) -> Iterator[list[str]]:
    """Words that are encoded together."""
    number = np.cumsum(pc.add(pc.binary_length(words), 1).to_numpy()) // ENCODED_CHARS
    cuts = np.flatnonzero(np.diff(number, prepend=-1)).tolist()
    return (words.slice(i, k - i).to_pylist() for i, k in pairwise([*cuts, len(words)]))


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in order, and the place of each value among them."""
    coded = pa.array(values).dictionary_encode()
    different = coded.dictionary.to_numpy()
    order = np.argsort(different)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    return different[order], rank[coded.indices.to_numpy()]


def _joined(texts: pa.Array, ends: np.ndarray) -> pa.Array:
    """Neighbouring texts as one: ``ends`` says how many lie before each, and the last end."""
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(np.ascontiguousarray(places[ends])), data)


def _weight(new: dict[bytes, Window]) -> int:
    """Bytes of remembered windows: a tuple, two byte strings and a string each."""
    return 174 * len(new) + sum(sum(map(len, x)) for x in (new, *zip(*new.values())))


def _level_bytes(name: str) -> bytes:
    """The bytes of an entry in which every character stands for a byte."""
    return bytes(byte_of(c) for c in name) if all(byte_of(c) is not None for c in name) else name.encode()


def _piece_bytes(name: str) -> bytes:
    byte = _BYTE_PIECE.fullmatch(name)
    return bytes([int(byte[1], 16)]) if byte else name.replace(_MARK, " ").encode()


_FACTS = ("n_a", "n_b", "n_groups", "n_links")
_ALIGNED = (
    ", ".join(f"{n} long" for n in _FACTS)
    + ", groups string, block long, links array<struct<place: int, times: long>>"
    + ", pairs array<struct<a: int, b: int, docs: long>>"
)


class _Block:
    """The texts of a block, aligned."""

    def __init__(self, texts: list[str | None], both: Pair) -> None:
        none = np.zeros(0, np.int64)
        some = [i for i, t in enumerate(texts) if t]
        found: list[Found | None] = [(0, 0, "", none, none)] * len(texts)
        for i, own in zip(some, both.by_words([texts[i] for i in some])):
            found[i] = own
        rest = [i for i, own in enumerate(found) if own is None]
        for group in groups(pa.array([texts[i] for i in rest], pa.string()), GROUP_CHARS):
            places, rest = rest[: len(group)], rest[len(group) :]
            encoded = [both.encode(t) for t in group]
            fine = [e for e in encoded if len(e[0])]
            aligned = iter(both.align(fine) if fine else ())
            for i, (a, b) in zip(places, encoded):
                found[i] = len(a), len(b), *(next(aligned) if len(a) else ("", none, none))
        n_a, n_b, self.groups, self.pairs, self.times = zip(*found)
        n_groups, n_links = [g.count("|") for g in self.groups], [int(t.sum()) for t in self.times]
        self.facts = n_a, n_b, n_groups, n_links

    def columns(self, number: int) -> list[pa.Array]:
        rows = len(self.groups)
        different, place = _coded(np.concatenate(self.pairs))
        docs = np.bincount(place, minlength=len(different))
        behind = np.cumsum([0, *map(len, self.pairs)])
        links = pa.StructArray.from_arrays(
            [pa.array(place, pa.int32()), pa.array(np.concatenate(self.times), pa.int64())], ["place", "times"]
        )
        pairs = pa.StructArray.from_arrays(
            [
                pa.array(different >> 32, pa.int32()),
                pa.array(different & 0xFFFFFFFF, pa.int32()),
                pa.array(docs, pa.int64()),
            ],
            ["a", "b", "docs"],
        )
        # The block's pairs stand in its first row.
        at = pa.array([0] + [len(different)] * rows, pa.int32())
        pairs = pa.ListArray.from_arrays(at, pairs, mask=pa.array([False] + [True] * (rows - 1)))
        facts = [pa.array(f, pa.int64()) for f in self.facts]
        return [
            *facts, pa.array(self.groups, pa.string()), pa.array([number] * rows, pa.int64()),
            pa.ListArray.from_arrays(pa.array(behind, pa.int32()), links), pairs,
        ]


def align(
    docs: DataFrame, byte_level: str, pieces: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The alignment of every row's whole text, with a blank before it.

    Returns ``key``; ``n_a`` and ``n_b``, the tokens by the vocabulary files ``byte_level`` (A)
    and ``pieces`` (B); ``groups``, cut where tokens of both end at one byte, as decimal ids
    ``a1,a2|b1;a3|b2``, and ``n_groups``; ``n_links``, the pairs of an A token and a B token
    that share a group; ``links``, for each different pair of ids its ``place`` among the
    ``pairs`` of the row's ``block`` and how often it is linked. The first row of a block has
    its ``pairs``: the ids and how many of the block's rows link them. Nothing is shuffled.

    Names of special tokens inside texts are ordinary text. A NULL or empty text, or one whose
    tokens don't stand for its bytes, has no tokens, no groups and no links. Repeated rows and
    rows without a key are aligned like others. A text of any length is held in memory with its
    ids. An empty table gives an empty result. Other columns are not
    read.
    """

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = in_worker(("alignment", byte_level, pieces), lambda: Pair(byte_level, pieces))
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            at = 0
            for texts in groups(batch.column(1), BLOCK_CHARS):
                keys = batch.column(0).slice(at, len(texts))
                # No name holds what a block has left when the next one is worked on.
                yield pa.RecordBatch.from_arrays([keys, *_Block(texts, both).columns(number)], schema.names)
                give_back()
                at, number = at + len(texts), number + 1

    schema = StructType([StructField("key", docs.schema[key].dataType), *StructType.fromDDL(_ALIGNED).fields])
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(aligned, schema).withColumnRenamed("key", key)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n`` and ``best`` of all linked pairs of ids: how many rows link them, and
    whether no other partner of ``a`` has more. Blocks have counted their own rows before."""
    pairs = aligned.filter("pairs is not null").select(F.inline("pairs"))
    counts = settle(pairs.groupBy("a", "b").agg(F.sum("docs").alias("n")), "pairs")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def score(aligned: DataFrame) -> DataFrame:
    """The rows of ``align`` without ``block``, ``links`` and ``pairs``, but with ``n_best``, the
    links whose pair is the best one of its A id, and ``count_sum``, the sum of all links'
    counts. Further columns stay; without links both are 0.

    ``aligned`` is read twice, so it should be a stored table.
    """
    counts = settle(pair_counts(aligned), "counts")
    placed = aligned.filter("pairs is not null").select("block", F.posexplode("pairs").alias("place", "pair"))
    placed = placed.select("block", "place", "pair.a", "pair.b").join(counts, ["a", "b"])
    rows = aligned.drop("pairs")
    kept = [c for c in rows.columns if c not in ("block", "links")]

    def scored(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        counts, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, np.int64)
        places = pairs["place"].to_numpy()
        counts[places], best[places] = pairs["n"].to_numpy(), pairs["best"].to_numpy()
        links = texts["links"].combine_chunks()
        flat = links.flatten()
        place, times = flat.field("place").to_numpy(), flat.field("times").to_numpy()
        sums = [np.concatenate([[0], np.cumsum(times * x[place])]) for x in (best, counts)]
        behind = np.cumsum([0, *links.value_lengths().to_pylist()])
        more = [pa.array(np.diff(s[behind]), pa.int64()) for s in sums]
        return pa.table([*(texts[c] for c in kept), *more], [*kept, "n_best", "count_sum"])

    schema = StructType([*(rows.schema[c] for c in kept), *StructType.fromDDL("n_best long, count_sum long").fields])
    sides = placed.select(F.col("block").alias("of"), "place", "n", "best").groupBy("of")
    return rows.groupBy("block").cogroup(sides).applyInArrow(scored, schema)
