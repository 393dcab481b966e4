"""Collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from dugout.llm import phrases


def pieces_of(text):
    plain = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", plain)]


def counted(rows, longest=3):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        for words in pieces_of(text):
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    return counts, totals


def brute(rows, most=2000, least=10, longest=3, percent=50):
    rows = [(lang or "und", text) for lang, text in rows]
    counts, totals = counted(rows, longest)
    frequent = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    covered = set()
    for p, longer in frequent.items():
        for size in range(2, len(p) - 1):
            for i in range(1, len(p) - size + 1):
                inner = (p[0], *p[i : i + size])
                if 100 * longer >= percent * counts[inner]:
                    covered.add(inner)
    found = {}
    for (lang, *w), a in frequent.items():
        if (lang, *w) in covered:
            continue
        cuts = [(k, counts[lang, *w[:k]], counts[lang, *w[k:]]) for k in range(1, len(w))]
        score, _, l, r = min((1000000 * a * a // (l * r), k, l, r) for k, l, r in cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    made = []
    for lang, rest in found.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rest)[:most], 1):
            made.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(made)


def corpus(seed, n=150, vocabulary=12):
    rng = random.Random(seed)
    words = ["New", "york", "CITY", "é", "Éa", "ß", "x\x00y", " ", "a b", "中", "don't", "end"][:vocabulary]
    marks = [" ", " ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n", "!? ", "\x0b"]
    made = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 80)))
        if rng.random() < 0.5:
            text += "new York city hall " * rng.randint(1, 3)
        made.append((rng.choice(["en", "en", "en", "de", "und", None]), text))
    return made


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_collocations_against_brute_force(spark):
    rows = corpus(1) + [("en", None), (None, None), ("fr", ""), ("fr", "."), ("xx", "one two")] + [("en", "twice " * 400)] * 2
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 AS n", "2 AS phrase", "3 AS prefix")
    got = phrases.collocations(docs).select(COLUMNS)
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert dict(got.dtypes) == {c: "string" if c in ("lang", "phrase") else "bigint" for c in COLUMNS}
    few = phrases.collocations(docs, most=5, least=3, longest=2).select(COLUMNS).collect()
    assert sorted(map(tuple, few)) == brute(rows, most=5, least=3, longest=2)


def test_empty_table_and_bad_limits(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(docs).collect() == []
    with pytest.raises(ValueError):
        phrases.phrase_counts(docs, longest=4)


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    """Counts of ten digits: the products have over forty digits without the division."""
    a, l, r = 3_000_000_019, 3_000_000_037, 9_000_000_011
    known = [("en", "x y", 2, a), ("en", "x", 1, l), ("en", "y", 1, r), ("en", "", 0, l + r)]
    frame = spark.createDataFrame(known, "lang string, phrase string, words int, n long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *_: frame)
    row = phrases.collocations(frame).first()
    assert row.score == 1000000 * a * a // (l * r)


def merged(batches):
    total = Counter()
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns)))
        assert [(p.encode(), x.encode()) for _, p, x, _ in rows] == sorted((p.encode(), x.encode()) for _, p, x, _ in rows)
        for lang, prefix, last, n in rows:
            total[lang, prefix, last] += n
    return total


@pytest.mark.parametrize("entries, container, words, segment", [(400_000, 2048, 400_000, 1 << 21), (60, 4, 9, 50), (1, 0, 4, 1)])
def test_counter_bursts_spills_and_starts_afresh(monkeypatch, entries, container, words, segment):
    for name, value in (("MOST_ENTRIES", entries), ("MOST_IN_CONTAINER", container), ("MOST_WORDS", words), ("SEGMENT_BYTES", segment)):
        monkeypatch.setattr(phrases, name, value)
    rows = [(lang or "und", text) for lang, text in corpus(2, 40)]
    counts, totals = counted(rows)
    by_lang = {}
    for lang, text in rows:
        by_lang.setdefault(lang, []).append(text.encode())
    everything = np.full(1 << phrases.MAP_BITS - 3, 255, np.uint8)
    for size, marks in ((2, None), (3, everything)):
        counter = phrases.Counter(size, marks)
        got = merged([b for lang, texts in by_lang.items() for b in counter.add(lang, texts)] + list(counter.rest()))
        want = Counter()
        for (lang, *w), n in counts.items():
            if len(w) == size or size == 2 and len(w) == 1:
                want[lang, " ".join(w[: size - 1]), " ".join(w[size - 1 :])] = n
        if size == 2:
            want.update({(lang, "", ""): n for lang, n in totals.items() if n})
        assert {k: n for k, n in got.items() if n} == dict(want)


def test_bitmap_marks_all_pairs(spark):
    rng = random.Random(3)
    pairs = [(rng.choice("ab"), f"w{rng.randint(0, 99)} é{rng.randint(0, 99)}") for _ in range(500)]
    marks = phrases._marks(spark.createDataFrame(pairs, "lang string, phrase string"))
    from xxhash import xxh64_intdigest

    assert marks.nbytes == 1 << phrases.MAP_BITS - 3 and 0 < np.unpackbits(marks).sum() <= len(set(pairs))
    for lang, phrase in pairs:
        first, second = (np.array([xxh64_intdigest(w)], np.uint64) for w in phrase.encode().split(b" "))
        bit = int(phrases.places(lang, first, second)[0])
        assert marks[bit >> 3] >> (bit & 7) & 1
