"""From raw documents to packed training sequences: five stages, each written and reread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bin_completion, fm_index, pii, queries, simhash, toxicity
from corpusmill.plans.staging import broadcast_if_small, stage

#: SQL cannot express trained models and token ids; the tests use brute force instead.
ORACLE_SQL = None
#: A Python worker keeps them beside what the other stages need.
CACHED_PIECES = 1 << 17


def _apart(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and a struct ``others``, so that no other column's name can clash."""
    others = [_column(c) for c in docs.columns if c not in ("doc_id", "text")]
    # A struct without fields cannot be written.
    return docs.select("doc_id", "text", F.struct(*(others or [F.lit(None).cast("int").alias("none")])).alias("others"))


def _restored(apart: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    own = ("doc_id", "text")
    return apart.select(*[F.col(c) if c in own else _column("others", c).alias(c) for c in docs.columns])


def _column(*names: str) -> Column:
    return F.col(".".join("`" + n.replace("`", "``") + "`" for n in names))


def _numbered(docs: DataFrame) -> DataFrame:
    """Written rows with a number ``row``, so that decisions do not hang on ``doc_id``."""
    return stage(_apart(docs).withColumn("row", F.monotonically_increasing_id()), "numbered")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain finds toxic go."""
    scored = queries.toxicity_scores(spark, _apart(docs), queries.read(spark, sf_dir, "labels"))
    return _restored(scored.where(~F.col("is_toxic")), docs)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    A document without an id stays only where no other one of its group has an id; of rows
    that repeat the smallest id one stays.
    """
    numbered = _numbered(docs)
    groups = simhash.near_groups(numbered, "row", "text").select("component", F.col("id").alias("row"))
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row")
    least = groups.join(numbered.select("row", "doc_id"), "row").groupBy("component").agg(F.min(order).alias("least"))
    kept = least.select(F.col("least.row").alias("row"))
    # Those that go are few; told by number alone, so that the texts need not be shuffled.
    gone = numbered.select("row").join(kept, "row", "left_anti")
    return _restored(_without(numbered, gone, "gone"), docs)


def _without(numbered: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """The rows whose number is not in ``gone``, which is broadcast while it is counted to be small."""
    return numbered.join(broadcast_if_small(stage(gone, name)), "row", "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark passages go."""
    numbered = _numbered(docs)
    texts = numbered.select(F.col("row").alias("doc_id"), "text")
    hits = fm_index.benchmark_hits(texts, queries.read(spark, sf_dir, "benchmark"))
    bad = hits.where(fm_index.contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("id").alias("row"))
    return _restored(_without(numbered, bad, "contaminated"), docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the new text."""
    masked = _restored(pii.mask(_apart(docs), "doc_id", "text"), docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, placed in sequences of 2,048 tokens."""
    return queries.packed(docs, CACHED_PIECES)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", keep_one_of_group),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``; each result is written and reread."""
    docs = queries.read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
