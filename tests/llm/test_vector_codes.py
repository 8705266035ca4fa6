"""Part codes and centroid clusters against plain versions, with awkward rows."""

from hashlib import sha256

import duckdb
import numpy as np
import pytest

from corpusmill.llm import part_trie, pivot_means, vector_queries

KIND = "vec_id long, embedding array<float>, label int, codes int, error int, cluster int, n int"


def awkward_rows(count=180, size=64, seed=5):
    random = np.random.default_rng(seed)
    vectors = random.normal(0, 0.2, (count, size)).astype(np.float32)
    vectors[40:60] = vectors[7]
    vectors[60:80, : size // 2] = vectors[8, : size // 2]
    vectors[80:100] = np.round(vectors[80:100])
    rows = [(k, [float(x) for x in v], k % 4 if k % 7 else None, 1, 2, 3, 4) for k, v in enumerate(vectors)]
    extra = [
        (900, None, 1), (901, [], 1), (902, [0.5] * (size - 1) + [None], 1), (903, [float("nan")] * size, 2),
        (904, [float("inf")] + [0.0] * (size - 1), 2), (905, [0.5] * (size - 1), 3), (None, [0.25] * size, None),
        (906, [0.0] * size, 1),
    ]
    return rows + [(*e, 0, 0, 0, 0) for e in extra] + rows[3:5]


def sound(rows, size):
    kept = [r for r in rows if r[1] is not None and len(r[1]) == size and all(x is not None and np.isfinite(x) for x in r[1])]
    return kept, np.array([np.floor(256 * np.array(r[1], np.float64)) for r in kept], np.int64).reshape(-1, size)


def plain_codes(rows, size, parts, entries, rounds):
    kept, whole = sound(rows, size)
    each = size // parts
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, whole[k].tolist()))[:entries]
    books = [whole[order, p * each : (p + 1) * each].copy() for p in range(parts)]
    for turn in range(rounds + 1):
        codes, error = np.zeros((len(kept), parts), int), np.zeros(len(kept), int)
        for p, book in enumerate(books):
            own = whole[:, p * each : (p + 1) * each]
            cost = ((own[:, None] - book) ** 2).sum(axis=2)
            codes[:, p] = cost.argmin(axis=1)
            error += cost.min(axis=1)
            if turn < rounds:
                for e in range(len(book)):
                    if (codes[:, p] == e).any():
                        book[e] = own[codes[:, p] == e].sum(axis=0) // (codes[:, p] == e).sum()
    return kept, codes, error, books


@pytest.mark.parametrize("size,parts,entries", [(64, 16, 64), (12, 3, 5), (8, 8, 500)])
def test_part_codes(spark, size, parts, entries):
    rows = awkward_rows(size=size)
    found, books = part_trie.coded(spark.createDataFrame(rows, KIND), "vec_id", "embedding", "label", parts, entries)
    kept, codes, error, plain = plain_codes(rows, size, parts, entries, 2)
    got = part_trie.with_label_error(found.cache()).collect()
    by_label = {}
    for row, e in zip(kept, error, strict=True):
        by_label[row[2]] = by_label.get(row[2], 0) + int(e)
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    want = [(r[0], r[2], c.tolist(), int(e), by_label[r[2]]) for r, c, e in zip(kept, codes, error, strict=True)]
    have = [(r["id"], r["label"], r["codes"], r["error"], r["label_error"]) for r in got]
    assert sorted(have, key=key) == sorted(want, key=key)
    assert np.array_equal(books, np.array(plain))


def test_walk_shares_prefixes_over_stretches(monkeypatch):
    random = np.random.default_rng(2)
    leaves, times, place = part_trie.distinct_parts(random.integers(-3, 3, (900, 4)))
    assert (leaves[place] == leaves[place]).all() and times.sum() == 900
    book = random.integers(-3, 3, (20, 4))
    cost = ((leaves[:, None] - book) ** 2).sum(axis=2)
    for stretch in (1, 2, 7, 5000):
        monkeypatch.setattr(part_trie, "STRETCH", stretch)
        nearest, least = part_trie.walk(leaves, book)
        assert np.array_equal(nearest, cost.argmin(axis=1)) and np.array_equal(least, cost.min(axis=1))


def test_part_codes_of_nothing(spark):
    for rows in ([], [(1, None, 1, 0, 0, 0, 0), (2, [float("nan")], None, 0, 0, 0, 0)]):
        found, books = part_trie.coded(spark.createDataFrame(rows, KIND), "vec_id", "embedding", "label")
        assert found.count() == 0 and part_trie.with_label_error(found).columns == ["id", "label", "codes", "error", "label_error"]
    with pytest.raises(ValueError, match="cannot be cut"):
        part_trie.coded(spark.createDataFrame([(1, [1.0] * 10, 1, 0, 0, 0, 0)], KIND), "vec_id", "embedding", "label")


def plain_clusters(rows, size, count, rounds, seed=2):
    kept, whole = sound(rows, size)
    digest = lambda k: sha256(f"{seed}:{kept[k][0]}".encode()).hexdigest()
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, digest(k), whole[k].tolist()))[:count]
    centres = whole[order].copy()
    for turn in range(rounds + 1):
        cost = ((whole[:, None] - centres) ** 2).sum(axis=2)
        found = cost.argmin(axis=1)
        for c in range(len(centres)):
            if turn < rounds and (found == c).any():
                centres[c] = whole[found == c].sum(axis=0) // (found == c).sum()
    return kept, found, cost.min(axis=1), centres


@pytest.mark.parametrize("count", [40, 7, 1, 400])
def test_clusters(spark, count):
    rows = awkward_rows()
    found, centres = pivot_means.clustered(spark.createDataFrame(rows, KIND), "vec_id", "embedding", 64, count)
    kept, cluster, distance, plain = plain_clusters(rows, 64, count, 5)
    assert np.array_equal(centres, plain)
    got = pivot_means.with_inertia(found.cache(), centres).collect()
    order = lambda r: (r[0] is None, r[0] or 0)
    want = [
        (r[0], int(c), int(d), int(distance[cluster == c].sum()), int(distance.sum()), sha256(",".join(map(str, plain[c].tolist())).encode()).hexdigest())
        for r, c, d in zip(kept, cluster, distance, strict=True)
    ]
    columns = ("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert sorted([tuple(r[c] for c in columns) for r in got], key=order) == sorted(want, key=order)


def test_clusters_of_nothing(spark):
    found, centres = pivot_means.clustered(spark.createDataFrame([(1, [1.0], 1, 0, 0, 0, 0)], KIND), "vec_id", "embedding")
    assert pivot_means.with_inertia(found, centres).count() == 0


def test_bounds_spare_measurements_and_lose_nothing():
    random = np.random.default_rng(4)
    centres = random.integers(-2000, 2000, (40, 64))
    vectors = centres[random.integers(0, 40, 500)] + random.integers(-40, 40, (500, 64))
    vectors[:5] = centres[:5]
    pivots = pivot_means.far_apart(centres, pivot_means.PIVOTS)
    stored, known = pivot_means.pivot_distances(vectors, pivots), pivot_means.pivot_distances(centres, pivots)
    found, distance, measured = pivot_means.nearest_centroid(vectors, stored, centres, known)
    cost = ((vectors[:, None] - centres) ** 2).sum(axis=2)
    assert np.array_equal(found, cost.argmin(axis=1)) and np.array_equal(distance, cost.min(axis=1))
    assert measured < 500 * 40 / 10


@pytest.mark.parametrize("name", ["op12_part_trie", "op13_laesa"])
def test_queries_equal_their_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    got = vector_queries.QUERIES[name](spark, folder).toPandas().sort_values("vec_id")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = con.sql(vector_queries.ORACLES[name]).df().sort_values("vec_id")
    assert list(got.columns) == list(want.columns) and got.values.tolist() == want.values.tolist()


def test_large_components_are_an_error(spark):
    rows = spark.createDataFrame([(1, [3e5] * 64, 1, 0, 0, 0, 0)], KIND)
    with pytest.raises(Exception, match="must be below"):
        pivot_means.clustered(rows, "vec_id", "embedding")
