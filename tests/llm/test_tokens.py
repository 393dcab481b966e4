"""Byte-level BPE and the alignment of two vocabularies, against the libraries."""

import base64
import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from conftest import plan

public_tokenizers = pytest.importorskip("public_tokenizers")

from dugout.llm import alignment, byte_bpe, queries  # noqa: E402
from dugout.llm.memory import Recent  # noqa: E402

RANKS, BYTE_JSON, PIECES = map(
    public_tokenizers.path, ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model")
)
PARTS = [
    "a", "b", "'", "s", "re", "ll", " ", "  ", "\n", "\t", "1", "²", "é", "中", "😀", "!", "'s", "　", "\x1c", "\u0085",
    "<|endoftext|>", "<s>", "<0x41>", "ǅ", "\x00", "\U00010d50", "٣", "▁", "the ", "word ", "ſ", " ", "don't",
]


def texts(n, seed, longest=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def both():
    return alignment.Pair(BYTE_JSON, PIECES)


def test_memory_keeps_what_is_asked_for():
    made = []
    memory = Recent(lambda keys: made.extend(keys) or {k: str(k) for k in keys}, 60_000)
    for i in range(2000):
        assert memory.values_of([i, -1, i]) == [str(i), "-1", str(i)]
    assert made.count(-1) == 1 and len(made) == 2001 and len(memory) + len(memory.older) < 700
    small = Recent(lambda keys: {k: "x" * 500 for k in keys}, 100)
    assert small.values_of([1, 2]) == ["x" * 500] * 2 and not small


def test_scan_is_closed_and_associative():
    scan = byte_bpe.Scan()
    assert scan.size < 256
    rng = np.random.default_rng(3)
    table = scan.table.reshape(scan.size, scan.size)
    a, b, c = rng.integers(0, scan.size, (3, 5000))
    assert (table[table[a, b], c] == table[a, table[b, c]]).all()
    symbols = rng.integers(0, 9, 70_000).astype(np.uint8)
    state, starts = byte_bpe.FRESH, []
    for s in symbols.tolist():
        state, start = byte_bpe._step(state, s)
        starts.append(start)
    assert scan.boundaries(symbols).tolist() == starts


def test_pieces_are_the_librarys(library):
    words = byte_bpe.Vocabulary(RANKS)
    rows = [*texts(4000, 1), None, "", "x" * 700, "'s" * 300, " " * 300 + "x", "\n" * 400]
    got = [x for ids, n in words.encode(rows) for x in np.split(ids, np.cumsum(n)[:-1])]
    assert [g.tolist() for g in got] == [library.encode_ordinary(t or "") for t in rows]


def test_long_texts_are_scanned_in_segments(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "SEGMENT_CHARS", 40)
    words = byte_bpe.Vocabulary(RANKS)
    rows = [*texts(60, 2, 400), "a" * 900 + "'re", "é" * 500, " " * 500 + "'ll"]
    got = [x for ids, n in words.encode(rows) for x in np.split(ids, np.cumsum(n)[:-1])]
    assert [g.tolist() for g in got] == [library.encode_ordinary(t) for t in rows]


def test_long_pieces_are_merged_like_short_ones(library, monkeypatch):
    rng = random.Random(4)
    pieces = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 200))) for _ in range(200)]
    words = byte_bpe.Vocabulary(RANKS)
    short = [byte_bpe.merged(p.encode(), words.ranks) for p in pieces]
    monkeypatch.setattr(byte_bpe, "LONG_PIECE", 1)
    assert [byte_bpe.merged(p.encode(), words.ranks) for p in pieces] == short
    assert short == [library.encode_ordinary(p) for p in pieces]


def test_encode_and_decode_round_trip(spark, library):
    rows = [(i, t) for i, t in enumerate(texts(300, 5))] + [(7, None), (None, ""), (7, "again"), (7, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 ids", "2 ends", "3 decoded")
    encoded = byte_bpe.encode(docs, RANKS)
    assert encoded.columns == ["doc_id", "ids", "ends"]
    got = byte_bpe.decode(encoded, RANKS).collect()
    want = Counter((k, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for k, t in rows)
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got) == want
    for r in got:
        for start, end, token in zip([0, *r.ends], r.ends, r.ids):
            assert bytes(r.decoded)[start:end] == library.decode_single_token_bytes(token)
    assert byte_bpe.decode(byte_bpe.encode(docs.limit(0), RANKS), RANKS).collect() == []


def test_decode_refuses_foreign_offsets(spark):
    rows = spark.createDataFrame([([1, 2], [1, 3])], "ids array<int>, ends array<int>")
    with pytest.raises(Exception, match="offsets do not belong"):
        byte_bpe.decode(rows, RANKS).collect()
    none = spark.createDataFrame([(None, None), ([], [])], "ids array<int>, ends array<int>")
    assert [r.decoded for r in byte_bpe.decode(none, RANKS).collect()] == [None, b""]
    with pytest.raises(ValueError):
        byte_bpe.encode(spark.createDataFrame([(1, "a")], "doc_id long, text string"), RANKS, pattern=r"\w+")


def test_round_trip_is_decode_of_encode_in_one_pass(spark):
    rows = [(i, t) for i, t in enumerate(texts(300, 9))] + [(7, None), (None, ""), (7, "again"), (7, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 ids", "2 ends", "3 decoded")
    got = byte_bpe.round_trip(docs, RANKS)
    want = byte_bpe.decode(byte_bpe.encode(docs, RANKS), RANKS)
    assert got.schema == want.schema
    assert Counter(map(repr, got.collect())) == Counter(map(repr, want.collect()))
    assert byte_bpe.round_trip(docs.limit(0), RANKS).collect() == []
    with pytest.raises(ValueError):
        byte_bpe.round_trip(docs, RANKS, pattern=r"\w+")
    # A second worker for each task would hold the ids and offsets of a whole batch.
    assert plan(queries.op11_byte_bpe(spark, "/root/testdata/sf0.001")).count("MapInArrow") == 1


def test_batches_are_encoded_and_decoded_in_portions(monkeypatch):
    monkeypatch.setattr(byte_bpe, "SEGMENT_CHARS", 200)
    rows = [*texts(400, 10), None, "", "word " * 300, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows, pa.string())], ["key", "text"])
    encoded = list(byte_bpe._encoded(iter([batch]), RANKS))
    assert all(b.num_rows == 1 or len(b.column(1).values) <= 200 for b in encoded)
    whole = pa.Table.from_batches(encoded).combine_chunks().to_batches()
    assert len(whole) == 1
    # Rows without ids stay rows.
    ids, ends = (pa.array([*c.to_pylist(), None, None], c.type) for c in whole[0].columns[1:])
    with_none = pa.RecordBatch.from_arrays([pa.array(range(len(ids))), ids, ends], ["key", "ids", "ends"])
    decoded = list(byte_bpe._decoded(iter([with_none.slice(0, 0), with_none]), RANKS, 1, 2))
    longest = max(map(len, whole[0].column(1).to_pylist()))
    assert len(decoded) > 5
    assert all((pc.sum(pc.list_value_length(b.column(1))).as_py() or 0) < 200 + longest for b in decoded)
    got = pa.Table.from_batches(decoded)
    assert got["key"].to_pylist() == [*range(len(ids))]
    assert got["decoded"].to_pylist() == [*((t or "").encode() for t in rows), None, None]


def by_library(both, text):
    """Both libraries on the whole text; nothing if the tokens don't stand for it."""
    a = both.first.encode(" " + text, add_special_tokens=False).ids
    b = both.second.encode(text)
    whole = (" " + text).encode()
    fine = all(b"".join(map(t.__getitem__, x)) == whole for x, t in zip((a, b), both.bytes))
    return (a, b) if text and fine else ([], [])


def by_hand(both, a, b):
    """Groups and links, token by token."""
    ends = [set(np.cumsum(both.lengths[i][x]).tolist()) for i, x in enumerate((a, b))]
    groups = [[], []]
    for i, ids in enumerate((a, b)):
        at, held = 0, []
        for t in ids:
            held.append(t)
            at += int(both.lengths[i][t])
            if at in ends[0] & ends[1]:
                groups[i].append(held)
                held = []
    links = Counter((x, y) for g, h in zip(*groups) for x in g for y in h)
    return ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in zip(*groups)), links


def test_both_vocabularies_encode_whole_texts(both):
    rows = texts(1500, 6) + ["plain words, again and again.\nNew line", "Ünïcode ſtill fine"]
    for t in rows:
        a, b = both.encode(t) if t else ([], [])
        assert (list(a), list(b)) == tuple(map(list, by_library(both, t))), repr(t)


def test_quick_vocabulary_is_the_same(both):
    """Every token but the added one comes from merging its own text, as the quick library takes it."""
    added = both.first.get_added_tokens_decoder()
    for name, number in both.first.get_vocab().items():
        if number not in added:
            assert [t.id for t in both.first.model.tokenize(name)] == [number]


@pytest.mark.parametrize("longest", [32, 3])
def test_windows_give_the_groups_of_the_whole_text(both, monkeypatch, longest):
    monkeypatch.setattr(alignment, "LONG_WINDOW", longest)
    both.windows = Recent(both._aligned, 40_000)
    rows = [*texts(400, 7), "x" * 3000, "中" * 400 + " word " + "-" * 100, "😀" * 90]
    encoded = [e for e in (both.encode(t) for t in rows if t) if len(e[0])]
    for size in (1, 7, len(encoded)):
        got = [x for i in range(0, len(encoded), size) for x in both.align(encoded[i : i + size])]
        assert len(got) == len(encoded)
        for (a, b), (groups, pairs, times) in zip(encoded, got):
            want, links = by_hand(both, a.tolist(), b.tolist())
            assert groups == want
            assert {(p >> 32, p & 0xFFFFFFFF): n for p, n in zip(pairs.tolist(), times.tolist())} == links


@pytest.mark.parametrize("longest, links, placed, encoded", [(32, 128, 1 << 21, 1 << 16), (6, 128, 50, 40), (32, 4, 300, 1)])
def test_words_give_the_groups_of_whole_texts(both, monkeypatch, longest, links, placed, encoded):
    """Texts cut before each blank, and others that tokens could reach over."""
    for name, value in (("LONG_WINDOW", longest), ("WORD_LINKS", links), ("PLACED_LINKS", placed), ("ENCODED_CHARS", encoded)):
        monkeypatch.setattr(alignment, name, value)
    rng = random.Random(9)
    parts = [*[p for p in PARTS if p not in (" ", "  ", "the ", "word ")], "\xa0", "the", "word", "-" * 40, "zqx" * 30, "\r\n", "<0x20>", "º¹½", "Word.\n\n"]
    words = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(400)]
    rows = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(400)]
    latin = [w for w in words if max(w) < "\u0250" and not w[0].isspace()]
    rows += [" ".join(rng.choices(latin, k=rng.randint(1, 30))) for _ in range(400)]
    rows += [" a", "a ", "a  b", "a \nb", "a\n b", "a\t  b", "a \x85b", "a\xa0 b", " ", "\n", "x" * 3000 + " a", "a", "\x1c a \x1c"]
    found = both.by_words(rows)
    assert sum(f is not None for f in found) > (100 if longest == 32 and links == 128 else 10)
    assert all(f is None for f, t in zip(found, rows) if alignment._ODD.search(t))
    for f, t in zip(found, rows):
        if f is not None:
            a, b = by_library(both, t)
            groups, linked = by_hand(both, a, b)
            assert f[:3] == (len(a), len(b), groups), repr(t)
            assert {(p >> 32, p & 0xFFFFFFFF): n for p, n in zip(f[3].tolist(), f[4].tolist())} == linked
    block = alignment._Block([None, *rows, ""], both)
    want = [both.encode(t) for t in rows]
    assert [list(f) for f in block.facts[:2]] == [[0, *(len(w[i]) for w in want), 0] for i in (0, 1)]
    assert list(block.groups) == ["", *(by_hand(both, a.tolist(), b.tolist())[0] for a, b in want), ""]


def test_different_words_of_a_block_are_encoded_once(both, monkeypatch):
    rng = random.Random(10)
    rows = [" ".join(rng.choices(["the", "words", "of", "été"], k=500)) for _ in range(40)]
    asked = []
    encode = both.encode
    monkeypatch.setattr(both, "encode", lambda text: asked.append(text) or encode(text))
    alignment._Block(rows, both)
    assert len(asked) == 1 and sorted(asked[0].split()) == ["of", "the", "words", "été"]


def test_words_of_a_block_are_aligned_in_portions(both, monkeypatch):
    """So the memory for it does not grow with a block's different words."""
    monkeypatch.setattr(alignment, "ENCODED_CHARS", 400)
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(600)]
    words[200:230] = ["qz" * 60 + str(i) for i in range(30)]  # all words of some portions are left out
    rows = [" ".join(words)] + [" ".join(rng.sample(words, 12)) for _ in range(300)]
    most = []
    groups = both._groups
    monkeypatch.setattr(both, "_groups", lambda a, b: most.append(len(a) + len(b)) or groups(a, b))
    found = both.by_words(rows)
    assert max(most) <= 2 * (400 + 130) and min(most) == 0
    monkeypatch.undo()
    assert found[0] is None and sum(f is not None for f in found) > 100
    for f, t in zip(found, rows):
        assert (f is None) == ("qz" * 60 in t)
        if f is not None:
            a, b = by_library(both, t)
            groups, linked = by_hand(both, a, b)
            assert f[:3] == (len(a), len(b), groups)
            assert {(p >> 32, p & 0xFFFFFFFF): n for p, n in zip(f[3].tolist(), f[4].tolist())} == linked


def test_a_block_takes_little_more_memory_than_its_result(both):
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(4, 12)))
    rows = [" ".join(word() for _ in range(200)) for _ in range(500)]
    both.by_words(rows[:2])
    tracemalloc.start()
    block = alignment._Block(rows, both)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    result = sum(map(len, block.groups)) + sum(x.nbytes for x in (*block.pairs, *block.times))
    assert peak < 4 * result


def test_vocabularies_that_reach_over_blanks_are_not_cut(both, monkeypatch):
    assert both.cuttable
    monkeypatch.setattr(both, "cuttable", False)
    assert both.by_words(["a b", "c"]) == [None, None]
    assert alignment._Block(["a b", "c"], both).groups == tuple(by_hand(both, *by_library(both, t))[0] for t in ("a b", "c"))


@pytest.mark.parametrize("chars", [1 << 22, 60])
def test_alignment_query_against_brute_force(spark, both, monkeypatch, tmp_path, chars):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", chars)
    rows = [(i, t) for i, t in enumerate(texts(120, 8))]
    rows += [(500, None), (500, ""), (None, "the word"), (3, "the word the"), (3, "the word the"), (9, "▁")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS links", "2 AS block", "'x' AS groups")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in queries.op13_alignment(spark, str(tmp_path)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum").collect())
    aligned = [(k, *by_library(both, t or "")) for k, t in rows]
    parts = [by_hand(both, a, b) for _, a, b in aligned]
    counts = Counter(pair for _, links in parts for pair in links)
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(n, most.get(a, 0))
    want = Counter()
    for (k, a, b), (groups, links) in zip(aligned, parts):
        digest = hashlib.sha256(groups.encode()).hexdigest() if a else ""
        best = sum(n for p, n in links.items() if counts[p] == most[p[0]])
        want[k, len(a), len(b), groups.count("|"), sum(links.values()), digest, best, sum(n * counts[p] for p, n in links.items())] += 1
    assert got == want


def test_alignment_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    found = alignment.align(docs, BYTE_JSON, PIECES)
    assert alignment.score(found).collect() == [] and alignment.pair_counts(found).collect() == []


def test_byte_bpe_query_against_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = []
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids)).encode()), sha((r.text or "").encode())))
    got = queries.op11_byte_bpe(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)
