"""The whole pipeline against a plain version of its stages, and the shapes of the queries."""

import re
from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from corpusmill.llm import pii, queries

SMALL = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    words = SPACED.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    votes = defaultdict(int)
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            votes[bit] += h >> bit & 1
    return sum(1 << b for b, n in votes.items() if 2 * n > len(shingles))


def smallest_of_groups(docs):
    """Positions in ``docs`` that stay: one of each group, that with the smallest id."""
    prints = [fingerprint(text) for _, text in docs]
    group = list(range(len(docs)))
    find = lambda k: k if group[k] == k else find(group[k])
    for a in range(len(docs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                group[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(docs):
        root = find(k)
        if root not in least or doc < docs[least[root]][0]:
            least[root] = k
    return sorted(least.values())


def contaminated(text, windows):
    words = WORD.findall((text or "").translate(LOWER))
    hit = set()
    for size in {len(w) for w in windows}:
        for k in range(len(words) - size + 1):
            if tuple(words[k : k + size]) in windows:
                hit.update(range(k, k + size))
    return bool(hit) and 20 * len(hit) >= len(words)


def benchmark_windows(texts):
    out = set()
    for text in texts:
        words = WORD.findall((text or "").translate(LOWER))
        if words:
            out |= {tuple(words[k : k + 13]) for k in range(max(1, len(words) - 12))}
    return out


def pieces(doc, text, tokenizer):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    first = len(ids) % 2048 or 2048
    cuts = [0, *range(first, len(ids) + 1, 2048)]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        yield doc, k, a, b - a, crc32(np.array(ids[a:b], "<u4").tobytes())


def test_pipeline_equals_a_plain_version(spark):
    table = queries.read(spark, SMALL, "documents")
    passage = max((r["text"] or "" for r in queries.read(spark, SMALL, "benchmark").collect()), key=len)
    extra = [(900_001, "a document with a passage " + passage), (900_002, "its copy, that is, a passage " + passage)]
    docs = [(r["doc_id"], r["text"]) for r in table.collect()]
    docs += [*extra, (900_003, docs[5][1]), (900_004, ""), (900_005, None), (900_006, "mail jane.doe@mail.example.org or 10.1.2.3")]

    planted = spark.createDataFrame(docs, "doc_id long, text string")
    stages = dict(corpus_pipeline.STAGES)
    scores = queries.toxicity_scores(spark, planted, queries.read(spark, SMALL, "labels")).collect()
    toxic = {r["doc_id"] for r in scores if r["is_toxic"]}
    expected = [d for d in docs if d[0] not in toxic]
    same(stages["toxicity"](spark, planted, SMALL), expected)
    assert toxic and len(expected) > 0.6 * len(docs)

    current = stages["simhash_near_dedup"](spark, spark.createDataFrame(expected, planted.schema), SMALL)
    kept = smallest_of_groups(expected)
    assert len(kept) < len(expected)
    expected = [expected[k] for k in kept]
    same(current, expected)

    current = stages["benchmark_decontamination"](spark, spark.createDataFrame(expected, planted.schema), SMALL)
    windows = benchmark_windows(r["text"] for r in queries.read(spark, SMALL, "benchmark").collect())
    clean = [d for d in expected if not contaminated(d[1], windows)]
    assert len(clean) < len(expected)
    expected = clean
    same(current, expected)

    given = spark.createDataFrame(expected, planted.schema)
    more = {r["id"]: [tuple(s) for s in r["more"]] for r in pii.personal_data(given, "doc_id", "text").collect()}
    expected = [(k, None if t is None else plainly_masked(t, more[k])) for k, t in expected]
    assert "mail <EMAIL> or <IP>" in [t for _, t in expected]
    same(stages["pii"](spark, given, SMALL), expected)

    packed = stages["best_fit_packing"](spark, spark.createDataFrame(expected, planted.schema), SMALL).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = [p for k, t in expected for p in pieces(k, t, tokenizer)]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == sorted(wanted)
    held = defaultdict(list)
    for r in packed:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        ends = np.cumsum([0, *[n for _, n in sorted(places)]])
        assert [o for o, _ in sorted(places)] == list(ends[:-1]) and ends[-1] <= 2048
    assert len(held) <= 1.02 * -(-sum(w[3] for w in wanted) // 2048) + 1


def plainly_masked(text, more):
    """Each character belongs to the first span that covers it, earlier and longer ones first."""
    spans = []
    for kind, pattern in pii.PATTERNS.items():
        spans += [(m.start(), m.end(), kind) for m in re.finditer(pattern, text) if pii._accepted(kind, m.group())]
    spans += [(a, b, kind) for kind, a, b in more]
    out, covered = "", 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= covered:
            out += text[covered:start] + f"<{kind.upper()}>"
        covered = max(covered, end)
    return out + text[covered:]


def same(found, expected):
    order = lambda rows: sorted(map(repr, rows))
    assert order((r["doc_id"], r["text"]) for r in found.collect()) == order(expected)


SHAPES = {
    "op1_toxicity": "doc_id bigint, p_low_quality double, p_toxic double, is_toxic boolean",
    "op2_itq": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op3_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op4_fm_index": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op5_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op6_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op7_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op9_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op10_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
}


@pytest.mark.parametrize("name", SHAPES)
def test_queries_have_the_columns_of_their_contract(spark, name):
    found = queries.QUERIES[name](spark, SMALL)
    types = dict(found.dtypes)
    for column in SHAPES[name].split(", "):
        key, wanted = column.split(" ")
        assert types[key] == wanted, (name, key, types[key])
    table, key = {"op2_itq": ("embeddings", "vec_id"), "op5_warc": ("pages", "page_id")}.get(name, ("documents", "doc_id"))
    given = sorted(r[0] for r in queries.read(spark, SMALL, table).select(key).collect())
    if name == "op10_packing":
        found = found.where("piece = 0")
    assert sorted(r[0] for r in found.select(key).collect()) == given


def test_personal_data_digest_of_every_text(spark):
    """``base_sha256`` and the counts by plain pattern matching over whole texts."""
    from hashlib import sha256

    texts = {r["doc_id"]: r["text"] or "" for r in queries.read(spark, SMALL, "documents").collect()}
    for r in queries.op3_pii(spark, SMALL).collect():
        own = [
            f"{kind}:{m.start()}:{m.end()}"
            for kind, pattern in pii.PATTERNS.items()
            for m in re.finditer(pattern, texts[r["doc_id"]])
            if pii._accepted(kind, m.group())
        ]
        assert r["base_sha256"] == sha256(",".join(own).encode()).hexdigest()
        assert r["spans"].split(",")[: len(own)] == (own or r["spans"].split(",")[:0])
        assert r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] == len(own)
