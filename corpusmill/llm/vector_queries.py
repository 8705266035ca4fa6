"""Registered queries over the table of vectors, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import hash_forest, part_trie, pivot_means
from corpusmill.plans.staging import stage

PARTS, ENTRIES, BOOK_ROUNDS = 16, 64, 2
SIZE, CENTROIDS, MEAN_ROUNDS = 64, 40, 5


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    asks = F.col("vec_id") % 20 == 0
    found = hash_forest.nearest(_vectors(spark, sf_dir), "vec_id", "embedding", asks, 20)
    return found.withColumnRenamed("id", "vec_id")


def op12_part_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = part_trie.coded(_vectors(spark, sf_dir), "vec_id", "embedding", "label", PARTS, ENTRIES, BOOK_ROUNDS)
    found = part_trie.with_label_error(stage(found, "coded"))
    return found.select(
        F.col("id").alias("vec_id"),
        part_trie.code_text(F.col("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(part_trie.books_digest(books)).alias("codebooks_sha256"),
    )


def op13_laesa(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centres = pivot_means.clustered(_vectors(spark, sf_dir), "vec_id", "embedding", SIZE, CENTROIDS, MEAN_ROUNDS)
    found = pivot_means.with_inertia(stage(found, "clustered"), centres)
    return found.select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


# --- SQL ---------------------------------------------------------------------

_KEPT = """
kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


def _codes_sql() -> str:
    each = SIZE // PARTS
    names = [f"c{k}" for k in range(each)]
    columns = ", ".join(names)
    cost = " + ".join(f"(p.{c} - b.{c}) * (p.{c} - b.{c})" for c in names)
    cells = ", ".join(f"v[part * {each} + {k + 1}] AS {c}" for k, c in enumerate(names))
    text = [
        "WITH ",
        _KEPT,
        f""",
parts AS MATERIALIZED (
  SELECT vec_id, CAST(part AS INTEGER) AS part, {cells} FROM kept, range({PARTS}) r(part)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {ENTRIES}),
book0 AS MATERIALIZED (SELECT part, entry, {columns} FROM parts JOIN first USING (vec_id))""",
    ]
    for k in range(BOOK_ROUNDS + 1):
        text.append(f""",
near{k} AS MATERIALIZED (
  SELECT p.vec_id, p.part, min(({cost}) * {ENTRIES} + b.entry) AS best, {", ".join(f"any_value(p.{c}) AS {c}" for c in names)}
  FROM parts p JOIN book{k} b ON p.part = b.part GROUP BY p.vec_id, p.part)""")
        if k < BOOK_ROUNDS:
            means = ", ".join(f"CAST(floor(sum({c}) / count(*)) AS BIGINT) AS {c}" for c in names)
            either = ", ".join(f"coalesce(m.{c}, b.{c}) AS {c}" for c in names)
            text.append(f""",
book{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, {either} FROM book{k} b LEFT JOIN
    (SELECT part, best % {ENTRIES} AS entry, {means} FROM near{k} GROUP BY 1, 2) m
  ON b.part = m.part AND b.entry = m.entry)""")
    joined = " || ',' || ".join(names)
    text.append(f""",
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY part) AS code,
    CAST(sum(best // {ENTRIES}) AS BIGINT) AS error
  FROM near{BOOK_ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg({joined}, ',' ORDER BY part, entry)) FROM book{BOOK_ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)""")
    return "".join(text)


def _clusters_sql() -> str:
    text = [
        "WITH ",
        _KEPT,
        f""",
cells AS MATERIALIZED (
  SELECT vec_id, CAST(i AS INTEGER) AS i, v[i + 1] AS x FROM kept, range({SIZE}) r(i) WHERE len(v) = {SIZE}),
first AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c
  FROM kept WHERE len(v) = {SIZE} ORDER BY sha256('2:' || vec_id) LIMIT {CENTROIDS}),
mid0 AS MATERIALIZED (SELECT c, i, x FROM cells JOIN first USING (vec_id))""",
    ]
    for k in range(MEAN_ROUNDS + 1):
        text.append(f""",
near{k} AS MATERIALIZED (
  SELECT vec_id, min(d * {CENTROIDS} + c) AS best FROM (
    SELECT v.vec_id, m.c, sum((v.x - m.x) * (v.x - m.x)) AS d
    FROM cells v JOIN mid{k} m ON v.i = m.i GROUP BY v.vec_id, m.c) GROUP BY vec_id)""")
        if k < MEAN_ROUNDS:
            text.append(f""",
mid{k + 1} AS MATERIALIZED (
  SELECT m.c, m.i, coalesce(n.x, m.x) AS x FROM mid{k} m LEFT JOIN
    (SELECT best % {CENTROIDS} AS c, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x
     FROM near{k} JOIN cells USING (vec_id) GROUP BY 1, 2) n
  ON m.c = n.c AND m.i = n.i)""")
    text.append(f""",
found AS (
  SELECT vec_id, CAST(best % {CENTROIDS} AS INTEGER) AS cluster, CAST(best // {CENTROIDS} AS BIGINT) AS distance
  FROM near{MEAN_ROUNDS}),
digests AS (SELECT c, sha256(string_agg(x, ',' ORDER BY i)) AS centroid_sha256 FROM mid{MEAN_ROUNDS} GROUP BY c)
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM found JOIN digests ON cluster = c""")
    return "".join(text)


QUERIES = {"op11_hash_forest": op11_hash_forest, "op12_part_trie": op12_part_trie, "op13_laesa": op13_laesa}
ORACLES = {"op12_part_trie": _codes_sql(), "op13_laesa": _clusters_sql()}
