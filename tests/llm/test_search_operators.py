"""Near-duplicates, benchmark passages and personal data, against brute force."""

import re

import numpy as np
import pytest
import xxhash

from corpusmill.llm import components, fm_index, itq, pii, simhash


def least_reachable(pairs, nodes):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    random = np.random.default_rng(3)
    pairs = [tuple(map(int, p)) for p in random.integers(0, 150, (90, 2))] + [(1000, k) for k in range(1001, 1100)]
    pairs += [(k, k + 1) for k in range(2000, 2040)]
    found = components.components(spark.createDataFrame(pairs, "a long, b long"))
    named = {n for a, b in pairs if a != b for n in (a, b)}
    assert {r["node"]: r["component"] for r in found.collect()} == least_reachable(pairs, named)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    parts = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_groups(spark):
    base = " ".join(f"w{k}" for k in range(120))
    texts = [None, "", " \t", "One", "one", "ÀÉ b c d e", base, base.replace("w60", "x"), base + " more", "w x y\x85z a b", "a b c d", *[base] * 4]
    rows = [(None if k == 2 else k, t, 0) for k, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[3]], "doc_id long, text string, fp int")
    found = simhash.near_groups(docs, "doc_id", "text").collect()
    assert len(found) == len(rows) + 1
    prints = {plain_fingerprint(t) for t in texts}
    pairs = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4]
    root = least_reachable(pairs, prints)
    least = {}
    for key, text, _ in rows:
        if key is not None:
            own = root[plain_fingerprint(text)]
            least[own] = min(least.get(own, key), key)
    expected = sorted(str((k, plain_fingerprint(t), least[root[plain_fingerprint(t)]])) for k, t, _ in [*rows, rows[3]])
    assert sorted(str((r["id"], r["fp"] % 2**64, r["component"])) for r in found) == expected
    assert simhash.near_groups(docs.limit(0), "doc_id", "text").count() == 0


@pytest.mark.parametrize("direct", [1 << 18, 16])
def test_links_of_scattered_and_crowded_fingerprints(spark, monkeypatch, direct):
    monkeypatch.setattr(simhash, "DIRECT_PAIRS", direct)
    monkeypatch.setattr(simhash, "BLOCK", 8)
    random = np.random.default_rng(4)
    centres = random.integers(0, 2**63, 12)
    prints = {int(c) ^ sum(1 << int(b) for b in random.integers(0, 63, random.integers(0, 6))) for c in centres for _ in range(25)}
    nodes = spark.createDataFrame([(p,) for p in prints], "fp long").cache()
    edges = [tuple(r) for r in simhash.links(nodes, 4).collect()]
    expected = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4]
    assert least_reachable(edges, prints) == least_reachable(expected, prints)


def test_thresholds_add_up():
    sample = np.random.default_rng(5).integers(0, 2**63, 300).astype(np.uint64)
    for total in (10, 10**6, 10**9):
        plan = simhash.layout(sample, total, 4)
        assert sum(t + 1 for _, t in plan) == 5
        assert sorted(b for g, _ in plan for b in g) == sorted({b for g, _ in plan for b in g})


def test_suffix_array_and_search():
    random = np.random.default_rng(6)
    for symbols in (random.integers(0, 3, 200), random.integers(0, 50, 300), np.tile([1, 2, 3], 60), np.array([0])):
        symbols = np.concatenate([symbols + 1, [0]])
        order = fm_index.suffix_array(symbols)
        assert order.tolist() == sorted(range(len(symbols)), key=lambda k: symbols[k:].tolist())
        index = fm_index.FMIndex(symbols, 4)
        for size in (1, 2, 5):
            if len(symbols) < size:
                continue
            at = random.integers(0, len(symbols) - size + 1, 10)
            patterns = np.array([symbols[a : a + size] for a in at])
            for p, low, high in zip(patterns, *index.search(patterns), strict=True):
                where = [k for k in range(len(symbols) - size + 1) if (symbols[k : k + size] == p).all()]
                assert sorted(index.locate(np.arange(low, high)).tolist()) == where


@pytest.mark.parametrize("shard_words", [40, 1 << 19])
def test_benchmark_hits(spark, monkeypatch, shard_words):
    monkeypatch.setattr(fm_index, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(fm_index, "BLOCK_ROWS", 2)
    item = " ".join(f"q{k}" for k in range(20))
    items = [(10, item), (9, "only three words"), (10, "second text of ten"), (None, "no id here"), (7, None), (8, "!?"), (6, "lone")]
    texts = [None, "", "...", item.upper(), "pre " + " ".join(item.split()[3:17]) + " post " * 30, " ".join(item.split()[:12]),
             "x only-three.WORDS y no id here", "lone " * 50, "lone " * 50, "Second text of ten and q0", "long " * 2000 + item]
    docs = spark.createDataFrame([(k, t, "z") for k, t in enumerate(texts)], "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for key, text in items:
        own = fm_index.words_of(text or "")
        size = min(13, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[k : k + size]), set()).add("" if key is None else str(key))
    found = {r["id"]: r for r in fm_index.benchmark_hits(docs, bench).collect()}
    for key, text in enumerate(texts):
        own = fm_index.words_of(text or "")
        hit, names = set(), set()
        for w, who in windows.items():
            for k in range(len(own) - len(w) + 1):
                if tuple(own[k : k + len(w)]) == w:
                    hit |= set(range(k, k + len(w)))
                    names |= who
        r = found[key]
        assert (r["n_words"], r["n_hit"], r["items"]) == (len(own), len(hit), sorted(names))
        assert {x for a, b in r["spans"] for x in range(a, b)} == hit
    assert all(r["n_hit"] == 0 for r in fm_index.benchmark_hits(docs, bench.limit(0)).collect())
    assert fm_index.benchmark_hits(docs.limit(0), bench).count() == 0


def test_vectors_link_exactly(spark):
    random = np.random.default_rng(8)
    centres = random.standard_normal((6, 16))
    vectors = [(centres[k % 6] + 0.06 * random.standard_normal(16)).astype(np.float32).tolist() for k in range(160)]
    rows = [(k, v, k % 3 if k % 6 < 3 else 0) for k, v in enumerate(vectors)]
    rows += [(200 + k, rows[k][1], rows[k][2]) for k in range(5)] + [rows[9], (None, rows[9][1], rows[9][2])]
    odd = [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, rows[0][1], None), (304, [], 1), (305, [None] * 16, 1),
           (306, [1.0, 2.0], 1), (307, [2.0, 4.0], 1), (308, [float("inf")] * 2, 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows + odd], "vec_id long, embedding array<float>, label int, node string")
    found = itq.near_vectors(df, "vec_id", "embedding", "label").collect()
    every = [r for r in rows + odd if r[0] in (306, 307) or r[0] is None or r[0] < 300]
    unit = [np.array(r[1], float) / np.linalg.norm(np.array(r[1], float)) for r in every]
    near = [(a, b) for a in range(len(every)) for b in range(a) if every[a][2] == every[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98]
    links = np.bincount(np.array(near).ravel(), minlength=len(every))
    root, least = least_reachable(near, range(len(every))), {}
    for k, r in enumerate(every):
        if r[0] is not None:
            least[root[k]] = min(least.get(root[k], r[0]), r[0])
    expected = [(r[0], int(links[k]), least[root[k]]) for k, r in enumerate(every)]
    expected += [(r[0], 0, r[0]) for r in odd if r[0] not in (306, 307)]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert itq.near_vectors(df.limit(0), "vec_id", "embedding", "label").count() == 0


def test_subsets_are_complete():
    costs = np.random.default_rng(9).integers(0, 50, (20, 9))
    rows, masks = itq.subset_masks(costs, 60)
    found = sorted(zip(rows.tolist(), masks.tolist(), strict=True))
    expected = [(r, m) for r in range(20) for m in range(1 << 9) if sum(int(costs[r, b]) for b in range(9) if m >> b & 1) <= 60]
    assert found == sorted(expected)


def test_base_spans():
    text = "mail a.b@x.example.org, 300.1.1.1, 10.0.0.255, 4111 1111 1111 1111 and +1 (606) 555-7814, 4111111111111112"
    found = [(k, text[a:b]) for k, a, b in pii.base_spans(text)]
    assert found == [("email", "a.b@x.example.org"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (606) 555-7814")]
    assert pii.masked("a 1.2.3.4 b", [("ip", 2, 9), ("context", 4, 9)]) == "a <IP> b"


def test_contexts_find_unseen_identifiers(spark):
    known = [f"reach me at user{k}@mail.example.com today" for k in range(30)]
    texts = [None, "", *known, "please reach me at handle-4711-xyz today", "room 12-345-678 is free"]
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)] + [(None, known[0], "s")], "doc_id long, text string, spans string")
    found = {r["id"]: r for r in pii.personal_data(docs, "doc_id", "text").collect()}
    assert found[0]["base"] == [] and len(found) == len(texts) + 1
    last = len(texts) - 2
    assert [texts[last][s["start"] : s["end"]] for s in found[last]["more"]] == ["handle-4711-xyz"]
    assert found[len(texts) - 1]["more"] == []
    masked = {r["doc_id"]: r["text"] for r in pii.mask(docs, "doc_id", "text").collect()}
    assert masked[last] == "please reach me at <CONTEXT> today" and masked[0] is None
    assert masked[2] == "reach me at <EMAIL> today"
    assert pii.personal_data(docs.limit(0), "doc_id", "text").count() == 0
