"""Evaluation aggregates over scored batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.numbers import whole_div
from corpusmill.functions.text import pretokens
from corpusmill.operators.tokens import pretoken_counts
from corpusmill.plans.staging import stage


def weighted_perplexity(scores: DataFrame) -> DataFrame:
    """Mean loss per token and its exponential, from rows ``loss, items``.

    No tokens, or a batch without a loss, is an error.
    """
    totals = scores.agg(
        F.sum(F.col("loss") * F.col("items")).alias("total"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("items"),
        F.count_if(F.col("loss").isNull()).alias("missing"),
    )
    no_loss = F.raise_error(F.lit("the loss of a batch is NULL")).cast("double")
    no_items = F.raise_error(F.lit("there are no items to average a loss over")).cast("double")
    loss = (
        F.when(F.col("missing") > 0, no_loss)
        .when(F.col("items") == 0, no_items)
        .otherwise(F.col("total") / F.col("items"))
    )
    return totals.select(loss.alias("loss")).select("loss", F.exp("loss").alias("perplexity"))


def unigram_scores(
    heldout: DataFrame, corpus: DataFrame, item_id: str, batch_size: int = 2, text: str = "text"
) -> DataFrame:
    """Scores of held-out texts under word frequencies of a corpus: ``batch_id, loss, items``.

    Counts are raised by one, so unseen words have a probability too. Words are counted
    per batch before the join, so a frequent word is one row and not one per occurrence.
    """
    counts = stage(pretoken_counts(corpus, text), "word_counts")
    total = counts.agg(F.sum("n")).scalar()
    distinct = counts.agg(F.count("*")).scalar()
    batch = whole_div(F.col(item_id), batch_size).alias("batch_id")
    words = (
        heldout.select(batch, F.explode(pretokens(F.col(text))).alias("word"))
        .groupBy("batch_id", "word")
        .agg(F.count("*").alias("times"))
    )
    # The held-out words are few, so they pick their counts before anything large is moved.
    wanted = counts.join(words.select("word"), "word", "left_semi")
    joined = words.join(wanted, "word", "left")
    chance = (F.coalesce(F.col("n"), F.lit(0)) + 1) / (total + distinct + 1)
    return (
        joined.groupBy("batch_id")
        .agg(
            F.sum(F.col("times") * -F.log(chance)).alias("loss"),
            F.sum("times").alias("items"),
        )
        .select("batch_id", (F.col("loss") / F.col("items")).alias("loss"), "items")
    )
