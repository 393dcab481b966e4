"""Tokenizer results for whole texts, worked out chunk by chunk.

A text is cut where no token of the vocabulary file can cross, and the result of every
chunk is remembered, since most chunks of a corpus are frequent words. The library itself
encodes every chunk, so results equal those of encoding the whole text. For vocabularies of
words, the plain chunks of a group of texts are merged together instead, each once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import in_worker
from .memory import BYTES, Recent

#: Where a long text may be cut: behind a visible character, before plain white space.
_CUT = re.compile(r"\S(?=[ \t\n\r])")
#: White space and the word behind it. Unusual white space does not end a chunk.
_CHUNK = re.compile(r"\s*\S+(?:[^\S \t\n\r]\s*\S+)*(?:[^\S \t\n\r]\s*\Z)?|\s+")
#: Characters of a text that are worked on at once.
SEGMENT_CHARS = 1 << 20
#: UTF-8 bytes given to the library at once.
BATCH_BYTES = 1 << 18


def segments(text: str, size: int = SEGMENT_CHARS) -> Iterator[str]:
    """``text`` in parts of ``size`` characters or a little more, cut at safe places only.

    A part without a safe place stays whole, however long it is.
    """
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size - 1)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    if start < len(text):
        yield text[start:] if start else text


def spaced_chunks(segment: str) -> list[str]:
    """Words with the white space before them, for byte-level vocabularies.

    No token crosses from a visible character to white space, so the chunks' tokens are the
    segment's. The quick way is for texts whose words are one blank or line break apart.
    """
    odd = segment[0].isspace() or segment[-1].isspace() or "  " in segment or "\n\n" in segment
    if not (odd or " \n" in segment or "\n " in segment):
        parts = segment.replace("\n", " \n").split(" ")
        if len(parts) == len(segment.split()):
            return [parts[0], *[p if p[0] == "\n" else " " + p for p in parts[1:]]]
    return _CHUNK.findall(segment)


def plain_chunks(segment: str) -> list[str]:
    """Runs between plain white space, for vocabularies that drop white space.

    Empty strings may be among them; they have no tokens.
    """
    return segment.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def by_bytes(texts: list[str], size: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Batches of nearly equal numbers of bytes, ``size`` at most unless one text has more."""
    sizes = [len(t) if t.isascii() else len(t.encode("utf-8", "surrogatepass")) for t in texts]
    even = sum(sizes) / max(1, -(-sum(sizes) // size))
    batch, held = [], 0
    for text, n in zip(texts, sizes):
        if batch and held + n / 2 > even:
            yield batch
            batch, held = [], 0
        batch.append(text)
        held += n
    if batch:
        yield batch


def slices(texts: pa.Array, size: int = SEGMENT_CHARS) -> Iterator[pa.Array]:
    """An Arrow batch's texts in slices of about ``size`` bytes; a longer text is alone."""
    start, held = 0, 0
    for at, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if at > start and held + n > size:
            yield texts.slice(start, at - start)
            start, held = at, 0
        held += n
    if start < len(texts):
        yield texts.slice(start)


def groups(texts: pa.Array, size: int = SEGMENT_CHARS) -> Iterator[list[str | None]]:
    """The texts of an Arrow batch, in groups of about ``size`` bytes; a longer text is alone."""
    return (some.to_pylist() for some in slices(texts, size))


class ChunkEncoder:
    """Remembers ``value(ids)`` of the chunks it has seen, within a memory bound."""

    def __init__(self, path: str, value: Callable[[list[int]], object], size: int = BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.value = Tokenizer.from_file(path), value
        self.known: Recent[str, object] = Recent(self._learnt, size)

    def texts(
        self, texts: list[str | None], chunks: Callable[[str], list[str]], joined: Callable[[list], object]
    ) -> list[object]:
        """``joined`` values of the chunks of each text. What no text of the group has shown
        before is encoded together, in batches of equal bytes."""
        found = []
        several: list[str] = []
        ends: list[int] = []
        for text in texts:
            if text is None or len(text) <= SEGMENT_CHARS:
                if text:
                    several += chunks(text)
                ends.append(len(several))
                continue
            found += _cut(self.known.values_of(several), ends, joined)
            several, ends = [], []
            found.append(joined([joined(self.known.values_of(chunks(s))) for s in segments(text)]))
        return found + _cut(self.known.values_of(several), ends, joined)

    def _learnt(self, unseen: list[str]) -> dict[str, object]:
        """Values of chunks that are not known."""
        found = {}
        for batch in by_bytes(unseen):
            for chunk, code in zip(batch, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)):
                found[chunk] = self.value(code.ids)
        return found


def _cut(values: list, ends: list[int], joined: Callable[[list], object]) -> list[object]:
    return [joined(values[a:b]) for a, b in pairwise([0, *ends])]


#: Chunks of Latin letters, digits and marks that are no part of a special token or an ending,
#: and the parts that word vocabularies cut them into.
_PLAIN = r"^[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:;=-@\[-`{-~]+$"
_PART = r"([a-zß-öø-ÿ]+|[0-9]|[!-&(-/:;=-@\[-`{-~]+)"
#: Bytes of the longest chunks that are merged with others.
PLAIN_BYTES = 256
_END = "</w>"
#: Characters that stand for bytes: printable ones for themselves, the others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _PRINTABLE]
_BYTES = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(_HIDDEN)}
#: The byte that a character stands for.
byte_of = {c: b for b, c in _BYTES.items()}.get


class WordEncoder(ChunkEncoder):
    """For vocabularies that lower-case, cut words from marks, and know a word's end.

    The merges of plain chunks are made by ``tiktoken`` for all of them at once, with the same
    vocabulary and a blank for the end of a word: the end is joined to the last byte first.
    Other chunks are left to the file's own library.
    """

    def __init__(self, path: str, value: Callable[[list[int]], object], size: int = BYTES):
        super().__init__(path, value, size)
        from tiktoken import Encoding

        added = self.tokenizer.get_added_tokens_decoder()
        ranks = {_word_bytes(name): i for name, i in self.tokenizer.get_vocab().items() if i not in added}
        self.quick = Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.last[[i for token, i in ranks.items() if len(token) > 1 and token.endswith(b" ")]] = True

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin and the last end.

        For values that are a chunk's ids as 32-bit numbers. Every different chunk of the texts
        is encoded once; Arrow puts the ids in the places of all its occurrences.
        """
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        plain = _is_plain(coded.dictionary)
        ids, ends = self._merged(coded.dictionary.filter(plain))
        values = self.known.values_of(coded.dictionary.filter(pc.invert(plain)).to_pylist())
        ends = np.append(ends, len(ids) + np.cumsum([len(v) // 4 for v in values], dtype=np.int64))
        ids = np.append(ids, np.frombuffer(b"".join(values), np.uint32))
        is_plain = plain.to_numpy(zero_copy_only=False)
        place = np.empty(len(is_plain), np.int32)
        place[np.append(np.flatnonzero(is_plain), np.flatnonzero(~is_plain))] = np.arange(len(place))
        different = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
        placed = different.take(pa.array(place[coded.indices.to_numpy()]))
        behind = placed.offsets.to_numpy()[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return placed.flatten().to_numpy(), behind

    def _learnt(self, unseen: list[str]) -> dict[str, object]:
        chunks = pa.array(unseen, pa.string())
        plain = _is_plain(chunks)
        ids, ends = self._merged(chunks.filter(plain))
        ids = ids.tolist()
        found = {c: self.value(ids[i:k]) for c, (i, k) in zip(chunks.filter(plain).to_pylist(), pairwise(ends.tolist()))}
        return found | super()._learnt(chunks.filter(pc.invert(plain)).to_pylist())

    def _merged(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain chunks one after another, and where each chunk's begin and the last end."""
        ended = pc.replace_substring_regex(pc.utf8_lower(chunks), _PART, r"\1 ")
        ids = self.quick.encode_to_numpy("".join(ended.to_numpy(zero_copy_only=False)), disallowed_special=())
        stops = np.append(0, np.flatnonzero(self.last[ids]) + 1)
        return ids, stops[np.cumsum(np.append(0, pc.count_substring(ended, " ").to_numpy()))]


def _is_plain(chunks: pa.Array) -> pa.BooleanArray:
    return pc.and_(pc.match_substring_regex(chunks, _PLAIN), pc.less_equal(pc.binary_length(chunks), PLAIN_BYTES))


def _word_bytes(name: str) -> bytes:
    """An entry's bytes, with a blank for the end of a word."""
    word = name.removesuffix(_END)
    return bytes(map(byte_of, word)) + b" " * (word != name)


def encoder(
    path: str, kind: str, value: Callable[[list[int]], object], made: type[ChunkEncoder] = ChunkEncoder
) -> ChunkEncoder:
    """The encoder of this worker process; tasks that follow each other share it."""
    return in_worker((path, kind), lambda: made(path, value))
