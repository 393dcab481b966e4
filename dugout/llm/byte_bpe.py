"""Byte-level BPE: whole texts to ids with offsets, and back to bytes.

Pieces of a text are found without a regular expression. Every character becomes a symbol, by
its class and what follows it; a symbol is a function from the state before the character to
the state behind it. Functions of that kind are composed associatively, so the states of a
million characters come from a blocked scan over whole arrays. A piece is merged once by its
ranks and remembered; token lengths by id give the offsets, and a decoder puts every token's
bytes at its offset. Both can run one after the other in the same pass over the rows.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import cache, cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .common import give_back, in_worker
from .encoding import groups
from .memory import Recent

#: Fixed value: the pre-tokenisation that the scan stands for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that are scanned at once.
SEGMENT_CHARS = 1 << 18
#: Positions of a scan that are composed one after another, in all blocks at once.
BLOCK = 128
#: Pieces of more bytes are merged with a heap.
LONG_PIECE = 256

#: Classes of characters; END stands between texts.
OTHER, LETTER, NUMBER, WHITE, BLANK, END = range(6)
_END = 0xDFFF
#: Symbols: characters by class, apostrophes that can begin an ending of one or two letters, and
#: white space before a visible character (LAST), which is cut off from the run it ends.
S_OTHER, S_LETTER, S_NUMBER, S_WHITE, S_END, S_ONE, S_TWO, S_LAST, S_JOIN = range(9)
#: States: nothing open, a run of a class, white space, a blank that the next run takes, and an
#: ending that needs two letters more or one.
FRESH, OTHERS, LETTERS, NUMBERS, WHITES, JOINED, TWO_MORE, ONE_MORE = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The state behind a character, and whether a piece starts at it."""
    if symbol == S_END:
        return FRESH, False
    if symbol == S_JOIN:
        return JOINED, True
    if symbol == S_LAST:
        return WHITES, True
    if symbol == S_WHITE:
        return WHITES, state != WHITES
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return FRESH, False
    if symbol in (S_ONE, S_TWO) and state not in (OTHERS, JOINED):
        return (ONE_MORE if symbol == S_ONE else TWO_MORE), True
    run = {S_LETTER: LETTERS, S_NUMBER: NUMBERS}.get(symbol, OTHERS)
    return run, state not in (run, JOINED)


class Scan:
    """All functions that symbols compose to, numbered, and the table of their compositions."""

    def __init__(self) -> None:
        states, symbols = range(8), range(9)
        made = [tuple(states), *(tuple(_step(s, x)[0] for s in states) for x in symbols)]
        number = {f: i for i, f in reversed(list(enumerate(made)))}
        self.of_symbol = np.array([number[f] for f in made[1:]], np.uint8)
        functions = list(number)
        for f in functions:  # the list grows until it is closed
            for g in made:
                both = tuple(g[s] for s in f)
                if both not in number:
                    number[both] = len(made)
                    made.append(both)
                    functions.append(both)
        # Numbers are places in ``made``; equal symbols share the first one.
        places = {f: i for i, f in reversed(list(enumerate(made)))}
        self.size = len(made)
        self.table = np.array(
            [[places[tuple(g[s] for s in f)] for g in made] for f in made], np.uint8
        ).ravel()
        self.behind_fresh = np.array([f[FRESH] for f in made], np.uint8)
        self.starts = np.array([[_step(s, x)[1] for x in symbols] for s in states]).ravel()

    def _composed(self, first: np.ndarray, then: np.ndarray) -> np.ndarray:
        return self.table.take(first.astype(np.intp) * self.size + then)

    def prefixes(self, functions: np.ndarray) -> np.ndarray:
        """The composition of all functions up to each place."""
        n = len(functions)
        if n <= 1:
            return functions
        width = min(BLOCK, n)
        padded = np.zeros(-(-n // width) * width, np.uint8)
        padded[:n] = functions
        local = np.ascontiguousarray(padded.reshape(-1, width).T)
        for j in range(1, width):
            local[j] = self._composed(local[j - 1], local[j])
        if local.shape[1] > 1:
            before = np.zeros(local.shape[1], np.uint8)  # nothing stands before the first block
            before[1:] = self.prefixes(local[-1, :-1].copy())
            local = self._composed(before[None, :], local)
        return local.T.ravel()[:n]

    def boundaries(self, symbols: np.ndarray) -> np.ndarray:
        """Whether a piece starts at each place."""
        states = np.empty(len(symbols), np.intp)
        states[:1] = FRESH
        states[1:] = self.behind_fresh[self.prefixes(self.of_symbol[symbols])[:-1]]
        return self.starts.take(states * 9 + symbols)


@cache
def scan() -> Scan:
    return Scan()


def classes() -> np.ndarray:
    """The class of every codepoint, as the library's own tables have it.

    The library is asked which characters are letters, numbers and white space, so that they
    agree whatever version of Unicode either has.
    """
    import tiktoken

    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    found = np.full(0x110000, OTHER, np.uint8)
    for kind, which in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        asked = tiktoken.Encoding("classes", pat_str=which, mergeable_ranks=single, special_tokens={})
        members = bytes(asked.encode_ordinary(everything)).decode()
        found[np.frombuffer(members.encode("utf-32-le"), np.uint32)] = kind
    found[ord(" ")], found[_END] = BLANK, END
    return found


def symbols(codes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """The symbol of every character; the last one must be an end."""
    kind = kinds.take(codes)
    found = np.array([S_OTHER, S_LETTER, S_NUMBER, S_WHITE, S_WHITE, S_END], np.uint8).take(kind)
    visible = np.append(kind[1:] <= NUMBER, False)
    found[(kind == WHITE) & visible] = S_LAST
    found[(kind == BLANK) & visible] = S_JOIN
    marks = np.flatnonzero(codes[:-1] == ord("'"))
    if len(marks):
        one, two = codes[marks + 1], codes[np.minimum(marks + 2, len(codes) - 1)]
        found[marks[np.isin(one, [ord(c) for c in "stmd"])]] = S_ONE
        pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
        found[marks[np.logical_or.reduce([(one == a) & (two == b) for a, b in pairs])]] = S_TWO
    return found


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: the neighbours of the lowest rank are joined, the leftmost first."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > LONG_PIECE:
        return _merged_long(piece, ranks)
    none = 1 << 62
    parts = [piece[i : i + 1] for i in range(len(piece))]
    costs = [ranks.get(a + b, none) for a, b in pairwise(parts)]
    while costs:
        least = min(costs)
        if least == none:
            break
        at = costs.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del costs[at]
        if at:
            costs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
        if at < len(costs):
            costs[at] = ranks.get(parts[at] + parts[at + 1], none)
    return [ranks[p] for p in parts]


def _merged_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As above, with the joins that are possible in a heap: it takes n log n."""
    n = len(piece)
    ends = array("q", range(1, n + 1))  # of the part that starts here; 0 if none does
    before = array("q", range(-1, n - 1))
    heap = [(ranks[p], i, i + 2) for i in range(n - 1) if (p := piece[i : i + 2]) in ranks]
    heapq.heapify(heap)
    while heap:
        _, start, end = heapq.heappop(heap)
        middle = ends[start]
        if not middle or middle >= n or ends[middle] != end:
            continue  # one of the two has been joined to something else
        ends[start], ends[middle] = end, 0
        if end < n:
            before[end] = start
            cost = ranks.get(piece[start : ends[end]])
            if cost is not None:
                heapq.heappush(heap, (cost, start, ends[end]))
        if start:
            cost = ranks.get(piece[before[start] : end])
            if cost is not None:
                heapq.heappush(heap, (cost, before[start], end))
    found, at = [], 0
    while at < n:
        found.append(ranks[piece[at : ends[at]]])
        at = ends[at]
    return found


class Vocabulary:
    """Ranks of a file, the bytes of all ids in one array, and pieces that were merged lately."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        size = 1 + max(self.ranks.values(), default=-1)
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.pieces: Recent[bytes, bytes] = Recent(self._packed)

    @cached_property
    def kinds(self) -> np.ndarray:
        found = classes()
        give_back()  # asking the library takes more memory than the answer
        return found

    def _packed(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        return {p: array("I", merged(p, self.ranks)).tobytes() for p in pieces}

    def _ids(self, pieces: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(self.pieces.values_of(pieces)), np.uint32)

    def _cut(self, text: str) -> tuple[bytes, np.ndarray]:
        """Bytes of texts with ends between them, and the byte places where pieces start."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = scan().boundaries(symbols(codes, self.kinds))
        widths = np.ones(len(codes), np.int64)
        for limit in (0x80, 0x800, 0x10000):
            widths += codes >= limit
        widths[codes == _END] = 0
        return text.replace(chr(_END), "").encode(), (np.cumsum(widths) - widths)[starts]

    def _several(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the number of ids of each."""
        data, starts = self._cut(chr(_END).join([*texts, ""]))
        places = [*starts.tolist(), len(data)]
        ids = self._ids([data[a:b] for a, b in pairwise(places)])
        ends = np.cumsum(self.lengths[ids])
        sizes = [len(t) if t.isascii() else len(t.encode()) for t in texts]
        behind = np.searchsorted(ends, np.cumsum(sizes), side="right")
        return ids, np.diff(behind, prepend=0)

    def _one(self, text: str) -> np.ndarray:
        """Ids of a long text, a segment after the other.

        A match depends on nothing before it, so a scan may start anew where a piece starts.
        The last characters of a segment don't show yet what follows them.
        """
        found, at, size = [], 0, SEGMENT_CHARS
        while len(text) - at > size:
            part = text[at : at + size]
            data, starts = self._cut(part + chr(_END))
            sure = len(part[:-3].encode())
            starts = starts[starts < sure]
            if len(starts) < 2:
                size *= 2  # one piece so far
                continue
            places = starts.tolist()
            found.append(self._ids([data[a:b] for a, b in pairwise(places)]))
            at += len(data[: places[-1]].decode())
            size = SEGMENT_CHARS
        found.append(self._several([text[at:]])[0])
        return np.concatenate(found)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of groups of texts, in order, and the number of ids of each text."""
        group: list[str] = []
        held = 0
        for text in texts:
            text = text or ""
            if group and held + len(text) > SEGMENT_CHARS:
                yield self._several(group)
                group, held = [], 0
            if len(text) > SEGMENT_CHARS:
                ids = self._one(text)
                yield ids, np.array([len(ids)])
                continue
            group.append(text)
            held += len(text)
        if group:
            yield self._several(group)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> bytes:
        """The bytes of ``ids``, every token in front of its end."""
        lengths = self.lengths[ids]
        starts = ends - lengths
        if len(ids) and (starts[0] or (starts[1:] != ends[:-1]).any()):
            raise ValueError("offsets do not belong to these ids")
        places = np.repeat(self.first[ids] - starts, lengths)
        return self.bytes[places + np.arange(len(places))].tobytes()


def _vocabulary(path: str) -> Vocabulary:
    return in_worker(("byte_bpe", path), lambda: Vocabulary(path))


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Batches of keys and texts as batches of keys, ids and ends, a group of texts each."""
    words = _vocabulary(path)
    for batch in batches:
        at = 0
        for texts in groups(batch.column(1), SEGMENT_CHARS):
            for ids, sizes in words.encode(texts):
                behind = np.concatenate([[0], np.cumsum(sizes)])
                total = np.cumsum(words.lengths[ids])
                base = np.concatenate([[0], total])[behind[:-1]]
                ends = total - np.repeat(base, sizes)
                lists = [
                    pa.ListArray.from_arrays(pa.array(behind, pa.int32()), pa.array(x.astype(np.int32)))
                    for x in (ids, ends)
                ]
                owner = batch.column(0).slice(at, len(sizes))
                yield pa.RecordBatch.from_arrays([owner, *lists], ["key", "ids", "ends"])
                at += len(sizes)


def _portions(batch: pa.RecordBatch, ids: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, in portions of about as many ids as a segment has characters."""
    sizes = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy().astype(np.int64)
    starts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // SEGMENT_CHARS, prepend=-1))
    for a, b in pairwise([*starts.tolist(), len(sizes)]):
        yield batch.slice(a, b - a)


def _decoded(batches: Iterator[pa.RecordBatch], path: str, ids: int, ends: int) -> Iterator[pa.RecordBatch]:
    """Batches with the bytes of their ids behind the other columns."""
    words = _vocabulary(path)
    for batch in batches:
        for some in _portions(batch, ids):
            found = [
                None if not a.is_valid else words.decode(
                    a.values.to_numpy(zero_copy_only=False).astype(np.int64),
                    b.values.to_numpy(zero_copy_only=False).astype(np.int64),
                )
                for a, b in zip(some.column(ids), some.column(ends))
            ]
            yield some.append_column("decoded", pa.array(found, pa.binary()))


def _rows(docs: DataFrame, key: str, text: str, pattern: str) -> tuple[DataFrame, StructType]:
    """Keys and texts, and the schema of their ids."""
    if pattern != PATTERN:
        raise ValueError("the scan stands for another pattern")
    schema = StructType(
        [
            StructField("key", docs.schema[key].dataType),
            StructField("ids", ArrayType(IntegerType())),
            StructField("ends", ArrayType(IntegerType())),
        ]
    )
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")), schema


def encode(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", pattern: str = PATTERN
) -> DataFrame:
    """``key``, ``ids`` and ``ends`` of every row: the ids of the whole text, and the byte place
    behind each of them in the UTF-8 text.

    ``path`` is a file of ranks that every worker can open. Ids are those that the library
    gives without special tokens, whose names inside texts are ordinary text. Only the
    ``pattern`` that the scan stands for is accepted. Nothing is shuffled. Long texts are
    scanned in segments; a single piece of many megabytes is merged as one and takes about a
    hundred bytes of memory for each of its own.

    A NULL or empty text has no ids. Repeated rows and rows without a key are encoded like
    others, one result row each. An empty table gives an empty result. Other columns are not
    read, whatever their names are.
    """
    rows, schema = _rows(docs, key, text, pattern)
    return rows.mapInArrow(lambda batches: _encoded(batches, path), schema).withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, ids: str = "ids", ends: str = "ends") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ids; a column of this name is replaced.

    Every token is put at its offset, so a row whose ``ends`` do not belong to its ``ids``
    fails, as do ids that the vocabulary has not. NULL ids give NULL; no ids give no bytes.
    All other columns are passed through.
    """
    encoded = encoded.drop("decoded")
    i, e = encoded.columns.index(ids), encoded.columns.index(ends)

    schema = StructType([*encoded.schema.fields, StructField("decoded", BinaryType())])
    return encoded.mapInArrow(lambda batches: _decoded(batches, path, i, e), schema)


def round_trip(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", pattern: str = PATTERN
) -> DataFrame:
    """The rows of ``decode(encode(docs))``: every text is encoded, and what that gives is decoded.

    Both steps run in one worker process, a group of texts after the other, so the ids and ends
    of a whole batch of rows are never held, neither there nor on the way to another worker.
    """
    rows, schema = _rows(docs, key, text, pattern)
    schema = StructType([*schema.fields, StructField("decoded", BinaryType())])

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(_encoded(batches, path), path, ids=1, ends=2)

    return rows.mapInArrow(both, schema).withColumnRenamed("key", key)
