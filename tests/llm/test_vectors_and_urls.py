"""Operators on vectors and URLs, and the pipeline, against plain Python."""

import math
import random
import time
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from dugout.llm import components, topk, urls, vectors

VECTORS = "vec_id long, embedding array<float>, label int, list int, code string"


def cloud(seed=1):
    """Random vectors, near copies in several sizes of groups, exact copies, and unusable ones."""
    rng = np.random.default_rng(seed)
    rows, number = [], 0

    def add(vector, label):
        nonlocal number
        rows.append((number, None if vector is None else [float(x) for x in np.float32(vector)], label, 1, "x"))
        number += 1

    for _ in range(150):
        add(rng.normal(size=16), int(rng.integers(3)))
    for size in (2, 5, 40):
        base, label = rng.normal(size=16), int(rng.integers(3))
        for _ in range(size):
            add((base + rng.normal(size=16) * 0.12) * rng.uniform(0.5, 2), label)
    base = rng.normal(size=16)
    for i in range(30):
        add(base, 1 if i < 20 else 2)
    for vector in (None, [], [0.0] * 16, [math.nan] + [1.0] * 15, [math.inf] + [1.0] * 15):
        add(vector, 1)
    add(base, None)
    add(base[:8], 1)
    rows.append((3, rows[3][1], rows[3][2], 1, "x"))
    rows.append((None, [float(x) for x in np.float32(base)], 1, 1, "x"))
    add([1.0, None] + [1.0] * 14, 1)
    return rows


def usable(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def brute_links(rows, least):
    root, links = list(range(len(rows))), [0] * len(rows)
    unit = [np.array(v) / np.linalg.norm(v) if usable(v) else None for _, v, *_ in rows]
    for i, j in combinations(range(len(rows)), 2):
        same = rows[i][2] is not None and rows[i][2] == rows[j][2]
        if same and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]):
            if unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    least_key = {r: min((row[0] for row, x in zip(rows, root) if x == r and row[0] is not None), default=None) for r in root}
    return Counter((row[0], n, least_key[r], row[0] is not None and row[0] == least_key[r]) for row, n, r in zip(rows, links, root))


def test_near_vectors_against_brute_force(spark):
    rows = cloud()
    frame = spark.createDataFrame(rows, VECTORS)
    got = vectors.near_vectors(frame, least=0.93)
    assert Counter(map(tuple, got.collect())) == brute_links(rows, 0.93)
    assert vectors.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_long_lists_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rows = cloud(2)
    got = vectors.near_vectors(spark.createDataFrame(rows, VECTORS), least=0.93)
    assert Counter(map(tuple, got.collect())) == brute_links(rows, 0.93)


def test_probes_leave_out_only_lists_that_cannot_hold_a_partner():
    rng = np.random.default_rng(3)
    units = vectors._units(np.concatenate([rng.normal(size=(400, 16)), rng.normal(size=(4, 16)).repeat(50, 0) + rng.normal(size=(200, 16)) * 0.1]))
    quantiser = vectors.fit(units, 900)
    cells = vectors.nearest(units, quantiser.centroids)
    reach = math.sqrt(2 - 2 * 0.93)
    rows, lists = quantiser.probes(units, reach, len(quantiser.centroids))
    probed = set(zip(rows.tolist(), lists.tolist()))
    near = np.argwhere(units @ units.T >= 0.93)
    assert all((i, cells[j]) in probed or (j, cells[i]) in probed for i, j in near)
    codes, errors = quantiser.code(units, cells)
    back = np.concatenate([w[codes[:, m]] for m, w in enumerate(quantiser.codewords)], axis=1)
    assert np.allclose(np.linalg.norm(units - quantiser.centroids[cells] - back, axis=1), errors)


def test_recall_on_many_lists(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(1500, 64))
    points = np.concatenate([base, base + rng.normal(size=base.shape) * 0.15])
    rows = [(i, [float(x) for x in np.float32(v)], 0, 1, "x") for i, v in enumerate(points)]
    got = vectors.near_vectors(spark.createDataFrame(rows, VECTORS), least=0.93)
    units = points / np.linalg.norm(points, axis=1)[:, None]
    exact = int((units @ units.T >= 0.93).sum() - len(points))
    found = got.agg(F.sum("n_links")).first()[0]
    assert exact >= 2000 and 0.97 * exact <= found <= exact


def test_no_link_of_a_dense_noisy_group_is_lost(spark):
    rng = np.random.default_rng(11)
    group = rng.normal(size=64) + rng.normal(size=(3400, 64)) * 0.27
    points = np.float32(np.concatenate([rng.normal(size=(6800, 64)), group]))
    rows = [(i, [float(x) for x in v], 0, 1, "x") for i, v in enumerate(points)]
    got = vectors.near_vectors(spark.createDataFrame(rows, VECTORS), least=0.93)
    units = vectors._units(points)
    expected = [int((units[i : i + 1] @ units.T >= 0.93).sum()) - 1 for i in range(len(units))]
    assert sum(expected) > 500_000
    assert {r.vec_id: r.n_links for r in got.collect()} == dict(enumerate(expected))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 164)] + [(500, i) for i in range(501, 540)] + [(7, 7), (None, 3), (8, 9), (9, 8)]
    rng.shuffle(links)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {i: 100 for i in range(101, 165)} | {i: 500 for i in range(501, 540)} | {9: 8}
    assert got == expected
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_top(rows, every, k):
    whole = {(i, tuple(math.floor(256 * x) for x in v)) for i, v, *_ in rows if i is not None and v and usable([*v, 1.0])}
    found = set()
    for q, a in whole:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b))
            found |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return found


@pytest.mark.parametrize("block", [8192, 32])
def test_top_products_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    monkeypatch.setattr(topk, "STEP", 8)
    rows = cloud(4)
    got = topk.top_products(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 5 == 0, k=5)
    assert {tuple(r) for r in got.collect()} == brute_top(rows, 5, 5)


def test_top_products_edges(spark):
    alone = spark.createDataFrame([(0, [1.0, 2.0], 1, 1, "x")], VECTORS)
    assert topk.top_products(alone, F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_products(alone.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_elimination_skips_far_candidates():
    rng = np.random.default_rng(1)
    points = np.floor(256 * np.concatenate([rng.normal(size=(50, 8)), 20 + rng.normal(size=(20, 8))]))
    longest = (points**2).sum(1).max()
    lifted = topk.lift(points, longest)
    pivots = lifted[::7]
    query = points[60:61]
    bound = np.abs(topk.pivot_distances(lifted, pivots) - topk.pivot_distances(np.c_[query, [[0.0]]], pivots)).max(1)
    real = np.sqrt(np.maximum((query @ query.T)[0, 0] + longest - 2 * points @ query[0], 0))
    assert (bound <= real + 1e-6).all()


PAGES = "page_id long, url string, html string, bad string, host int, verdict int"
RULES = (
    urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/"),
)


def pages_of(spark, found):
    return spark.createDataFrame([(i, u, "h", "b", 1, 2) for i, u in found], PAGES)


def test_fixed_rules(spark):
    cases = {
        "http://a.COM/x?y=/z#t": ("a.com", "/x", "com/", "allow"),
        "http://example.com/en/1": ("example.com", "/en/1", "example.com/en/", "block"),
        "https://b.www.example.com/en/": ("b.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://x.net/fr/a": ("x.net", "/fr/a", "net/fr/", "block"),
        "https://xnet/fr/a": ("xnet", "/fr/a", None, "allow"),
        "https://a.com": ("a.com", "", None, "allow"),
        "https://a.com?q=/en/": ("a.com", "", None, "allow"),
        "https://É.com/#/en/": ("É.com", "/", "com/", "allow"),
        "x://y://z.com/a": ("y:", "//z.com/a", None, "allow"),
        "no scheme/com/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    frame = pages_of(spark, [*enumerate(cases), (0, next(iter(cases))), (None, "http://a.com/")])
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    got = urls.judge(frame, labels, RULES).collect()
    assert len(got) == len(cases) + 2
    by_key = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert [by_key[i] for i in range(len(cases))] == list(cases.values())
    assert urls.judge(frame.limit(0), labels, RULES).count() == 0


def test_mined_rules_against_brute_force(spark):
    rng = random.Random(9)
    found, bad = [], {}
    for i in range(600):
        spam, site = rng.random() < 0.3, rng.choice(["news", "shop", "blog"])
        path = "/casino/win" if spam else rng.choice(["/casino/hall", "/about/win", "/item"])
        found.append((i, f"http://{site}.org{path}/{i}.html?ref={i}"))
        if i % 2:
            bad[i] = spam or rng.random() < 0.05
    frame = pages_of(spark, found)
    labels = spark.createDataFrame([(k, v) for k, v in bad.items()] + [(1, None), (3, bad[3])], "page_id long, bad boolean")
    got = {r.page_id: r for r in urls.judge(frame, labels, (), min_support=0.02, min_confidence=0.8, min_count=10).collect()}
    parsed = urls.parse(frame, "url").select("page_id", urls._tokens().alias("t"))
    tokens = {r.page_id: frozenset(r.t) for r in parsed.collect()}
    assert max(len(t) for t in tokens.values()) <= 10
    known = [(tokens[i], b) for i, b in bad.items()]
    floor, rate = max(0.02 * len(known), 10), sum(bad.values()) / len(bad)
    rules = {}
    for items in {frozenset(c) for t, b in known if b for n in range(1, len(t) + 1) for c in combinations(sorted(t), n)}:
        hits = [b for t, b in known if items <= t]
        if sum(hits) >= floor - 1e-9 and sum(hits) / len(hits) >= max(0.8, rate):
            rules[items] = sum(hits) / len(hits)
    assert rules
    # Combinations with a token that is a rule alone decide nothing more.
    rules = {r: c for r, c in rules.items() if len(r) == 1 or not any(frozenset([t]) in rules for t in r)}
    for i, t in tokens.items():
        best = max((c for r, c in rules.items() if r <= t), default=None)
        assert got[i].verdict == ("allow" if best is None else "block")
        assert (got[i].confidence is None) == (best is None) and (best is None or abs(got[i].confidence - best) < 1e-9)


def test_rules_on_frequent_tokens_of_long_urls(spark):
    rng = random.Random(4)
    found, bad = [], {}
    for i in range(400):
        spam = i % 4 != 0
        # The keys are rarer than the path that tells.
        keys = "&".join(f"{k}=1" for k in ("abcdefghijk" if i % 2 else "lmnopqrstuv"))
        found.append((i, f"http://www.news.org/{'casino' if spam else 'item'}{rng.choice(['/x', ''])}?{keys if spam or i % 8 == 0 else 'a=1'}"))
        bad[i] = spam
    found += [(1000, "http://other.net/casino"), (1001, "http://other.net/item")]
    frame = pages_of(spark, found)
    labels = spark.createDataFrame(list(bad.items()), "page_id long, bad boolean")
    got = {r.page_id: r for r in urls.judge(frame, labels, (), min_support=0.02, min_confidence=0.9, min_count=10).collect()}
    assert all((got[i].verdict == "block") == b for i, b in bad.items())
    assert (got[1000].verdict, got[1000].confidence, got[1001].verdict) == ("block", 1.0, "allow")


def test_spam_with_many_query_keys_is_mined_in_time(spark):
    """Each of 22 keys stands in nine of ten bad URLs: four million combinations are frequent."""
    rng = random.Random(3)
    keys = [f"k{chr(97 + i)}" for i in range(22)]
    found, bad = [], {}
    for i in range(400):
        bad[i] = i % 2 == 0
        own = [k for k in keys if rng.random() < 0.9] if bad[i] else ["page"]
        found.append((i, f"http://www.site.org/view?{'&'.join(f'{k}=1' for k in own)}"))
    found += [(900, "http://www.site.org/view?kc=3"), (901, "http://www.site.org/view?page=3")]
    labels = spark.createDataFrame(list(bad.items()), "page_id long, bad boolean")
    began = time.monotonic()
    got = {r.page_id: r.verdict for r in urls.judge(pages_of(spark, found), labels, ()).collect()}
    assert time.monotonic() - began < 120
    assert all((got[i] == "block") == b for i, b in bad.items()) and (got[900], got[901]) == ("block", "allow")


def test_url_filter_uses_no_python(spark):
    frame = pages_of(spark, [(1, "http://a.com/x")])
    labels = spark.createDataFrame([(1, True)], "page_id long, bad boolean")
    plan = urls.judge(frame, labels, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_pipeline_against_stages_in_plain_python(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline
    from tokenizers import Tokenizer

    from dugout.llm import mixing, pii, simhash
    from dugout.llm.queries import vocabulary

    rng = random.Random(2)
    words = "the house is old and door was open when we came to river with our friends".split()
    documents = []
    for i in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(5, 400)))
        documents.append((i, text + f" mail a{i}b@host.example.com", "en", "hot" if i % 3 else "cold", len(text)))
    documents += [(100 + i, documents[i][1], "en", "hot", 1) for i in range(20)]
    documents += [(200, None, "en", "hot", 0), (201, "12 34", "en", "cold", 5), (202, "", None, None, 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(documents, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    lettered = [d for d in documents if d[1] and any(c.isalpha() for c in d[1])]
    fps = {d[0]: simhash.fingerprint(d[1]) for d in lettered}
    root = {d[0]: d[0] for d in lettered}
    for a, b in combinations(sorted(root), 2):
        if ((fps[a] ^ fps[b]) & ((1 << 64) - 1)).bit_count() <= 2 and root[a] != root[b]:
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = {k: new if r == old else r for k, r in root.items()}
    kept = [d for d in lettered if root[d[0]] == d[0]]
    clean = [(d[0], pii.replaced(d[1], b"proof", {})[0], *d[2:]) for d in kept]
    copies = Counter(r.doc_id for r in mixing.replicate(spark.createDataFrame(clean, schema), seed=11).collect())
    words = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    lengths = {d[0]: len(words.encode(d[1], add_special_tokens=False).ids) + 1 for d in clean}
    held = Counter()
    for r in got:
        held[r.doc_id] += r.length
        assert r.doc_tokens == lengths[r.doc_id]
    assert held == Counter({k: n * lengths[k] for k, n in copies.items()})
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "SimHash near-dedup", "PII", "mixing sources", "packing"]
    private = corpus_pipeline.personal_data(spark, spark.createDataFrame(kept, schema), "").select("doc_id", "text")
    assert sorted(map(tuple, private.collect())) == sorted((a, b) for a, b, *_ in clean)
