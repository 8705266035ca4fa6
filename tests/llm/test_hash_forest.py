"""Nearest vectors of the hash forest against brute force, with awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import hash_forest, vector_queries

KIND = "vec_id long, embedding array<float>, label int, node long, size int, asks int, rank int"


def plain(rows, k, divisor=20):
    """Scores of the k nearest rows of every query row, and the allowed ids at each rank."""
    kept = [
        (i, r[0], np.array(r[1], np.float64))
        for i, r in enumerate(rows)
        if r[0] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
    ]
    wanted = []
    for i, key, vector in kept:
        if key % divisor == 0:
            near = [(-float(vector @ v), other) for j, other, v in kept if j != i and len(v) == len(vector)]
            wanted.append((key, sorted(near)[:k]))
    return wanted


def awkward(random, size=16, count=260):
    vectors = random.normal(0, 1, (count, size)) * random.uniform(0.2, 3, (count, 1))
    vectors[100:160] = vectors[0]
    vectors[160:170] = -vectors[3]
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(vectors)]
    rows += [(400, None), (420, []), (440, [0.0] * size), (460, [None] * size), (480, [float("nan")] * size), (None, rows[5][1]),
             (500, [1.0, 2.0]), (501, [2.0, 0.5]), (520, [3.0]), rows[20], rows[20], (40, rows[0][1]), rows[100]]
    return [(*r, 1, 2, 3, 4, 5) for r in rows]


def collected(found):
    out = {}
    for r in found.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    return out


def test_exact_results_of_small_tables(spark):
    rows = awkward(np.random.default_rng(8))
    found = collected(hash_forest.nearest(spark.createDataFrame(rows, KIND), "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20, wanted=10**9))
    wanted = {}
    for key, near in plain(rows, 20):
        wanted.setdefault(key, []).append(near)
    assert found.keys() == {k for k, lists in wanted.items() if any(lists)}
    for key, lists in wanted.items():
        if not any(lists):
            continue
        got = sorted(found[key])
        assert [g[0] for g in got] == sorted(r + 1 for near in lists for r in range(len(near)))
        assert sorted((round(-s, 4), i) for _, i, s in got) == sorted((round(s, 4), i) for near in lists for s, i in near)
    # Ties between equal vectors go to the smaller id.
    assert [i for _, i, _ in sorted(found[120])][:4] == sorted(r[0] for r in rows if r[1] == rows[0][1] and r[0] not in (120, None))[:4]


def test_fewer_rows_than_asked_for_and_none(spark):
    asks = F.col("vec_id") % 20 == 0
    three = [(k, [1.0, float(k)], 1, 0, 0, 0, 0) for k in (0, 1, 2)]
    found = collected(hash_forest.nearest(spark.createDataFrame(three, KIND), "vec_id", "embedding", asks))
    assert found == {0: [(1, 1, 1.0), (2, 2, 1.0)]}
    alone = spark.createDataFrame(three[:1], KIND)
    assert hash_forest.nearest(alone, "vec_id", "embedding", asks).count() == 0
    assert hash_forest.nearest(alone.limit(0), "vec_id", "embedding", asks).count() == 0


def test_recall_of_the_fitted_forest(spark, monkeypatch):
    random = np.random.default_rng(3)
    middle = random.normal(0, 1, (60, 24))
    vectors = middle[random.integers(0, 60, 3000)] + random.normal(0, 0.35, (3000, 24))
    rows = [(k, [float(np.float32(x)) for x in v], 0, 0, 0, 0, 0) for k, v in enumerate(vectors)]
    monkeypatch.setattr(hash_forest, "BLOCK", 128)
    monkeypatch.setattr(hash_forest, "PORTION", 16)
    goals = []
    fit = hash_forest.fitted_wanted
    monkeypatch.setattr(hash_forest, "fitted_wanted", lambda *a: goals.append(fit(*a)) or goals[-1])
    found = collected(hash_forest.nearest(spark.createDataFrame(rows, KIND), "vec_id", "embedding", F.col("vec_id") % 20 == 0))
    wanted = dict(plain(rows, 20))
    assert found.keys() == wanted.keys()
    shares = [len({i for _, i, _ in found[q]} & {i for _, i in near}) / 20 for q, near in wanted.items()]
    # The forest looks at a part of the vectors and finds nearly all that brute force finds.
    assert goals[0] < 3000 and np.mean(shares) >= 0.9
    for q, near in found.items():
        assert [s for _, _, s in sorted(near)] == sorted((s for _, _, s in near), reverse=True)


def test_levels_go_up_together():
    counts = np.array([[50, 8, 2, 0], [50, 4, 1, 1], [50, 9, 3, 0]])
    assert hash_forest.chosen_levels(counts, 1).tolist() == [3, 3, 3]
    assert hash_forest.chosen_levels(counts, 6).tolist() == [2, 2, 2]
    assert hash_forest.chosen_levels(counts, 7).tolist() == [1, 2, 2]
    assert hash_forest.chosen_levels(counts, 13, first=1).tolist() == [2, 1, 1]
    assert hash_forest.chosen_levels(counts, 22).tolist() == [0, 1, 1]
    assert hash_forest.chosen_levels(counts, 1000).tolist() == [0, 0, 0]


@pytest.mark.parametrize("size", [1, 2, 31, 64, 200])
def test_strings_fit_and_agree_for_near_vectors(size):
    random = np.random.default_rng(size)
    axes = hash_forest.rotations(size)
    assert axes.shape[:3] == (size + 1, hash_forest.TREES, hash_forest.SYMBOLS)
    vectors = random.normal(0, 1, (50, size))
    near = hash_forest.strings(hash_forest.asking(vectors), axes)
    assert (near >= 0).all() and (near == hash_forest.strings(hash_forest.asking(vectors * 3), axes)).mean() > 0.99
    assert (near < 1 << hash_forest.symbol_bits(size) * hash_forest.SYMBOLS).all()


def test_query_on_given_vectors(spark):
    found = vector_queries.op11_hash_forest(spark, "/root/testdata/sf0.001")
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    wanted = dict(plain([(r["vec_id"], r["embedding"]) for r in rows], 20))
    got = collected(found.withColumnRenamed("vec_id", "id"))
    assert got.keys() == wanted.keys() and all(len(v) == 20 for v in got.values())
    assert np.mean([len({i for _, i, _ in got[q]} & {i for _, i in near}) / 20 for q, near in wanted.items()]) >= 0.9
