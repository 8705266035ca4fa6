"""Documents from lines of text."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import WHITESPACE, computed_once, normalize, strip
from corpusmill.operators.prefix import BLOCK_BITS, required, running_totals
from corpusmill.schemas import DEFAULT_MIN_CHARS

# A line end, then whitespace that holds at least one more line end.
_BLANK_LINES = rf"(?>\r\n|\r|\n)[{WHITESPACE}]*[\r\n]"


class EmptyDatasetError(ValueError):
    """No usable document was found."""


def assemble_documents(
    lines: DataFrame,
    file: str = "file",
    pos: str = "line_no",
    value: str = "value",
    min_chars: int = DEFAULT_MIN_CHARS,
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """Join lines to documents: ``file, first_line, text``.

    Blank lines end a document. The number of blank lines above a line tells which
    document it belongs to; it is summed in blocks, so a huge file is shared by many tasks.
    """
    rows = lines.select(
        required(file).alias("file"),
        F.col(pos).cast("bigint").alias("line_no"),
        computed_once(strip(F.col(value))).alias("value"),
    )
    blank = (F.col("value") == "").cast("bigint")
    placed = running_totals(rows, ["file"], "line_no", {"blanks": blank}, bits=bits)
    in_order = F.sort_array(F.collect_list(F.struct("line_no", "value")))
    joined = (
        placed.where(F.col("value") != "")
        .groupBy("file", "blanks")
        .agg(F.min("line_no").alias("first_line"), in_order.alias("parts"))
    )
    text = computed_once(normalize(F.array_join(F.col("parts.value"), " ")))
    return min_chars_filter(joined.select("file", "first_line", text.alias("text")), min_chars)


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    min_chars: int = DEFAULT_MIN_CHARS,
    separator: str = "\n\n",
) -> DataFrame:
    """Documents of text files without a shuffle: ``file, split_start, row, part, text``.

    The reader cuts at ``separator``, which is always a blank line; blank lines of other
    forms are cut inside the piece. The first four columns sort documents in file order.
    For files with ``\\r\\n`` line ends pass ``"\\r\\n\\r\\n"``, so that pieces stay small.
    """
    pieces = spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row"),
        F.make_valid_utf8("value").alias("piece"),
    )
    bodies = F.transform(F.split("piece", _BLANK_LINES), normalize)
    documents = pieces.select(
        "file", "split_start", "row", F.posexplode(bodies).alias("part", "text")
    )
    return min_chars_filter(documents.where(F.col("text") != ""), min_chars)


def normalized(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace a text column by its normalised form."""
    once = computed_once(normalize(F.col(text))).alias(text)
    return df.select(*[once if c == text else F.col(c) for c in df.columns])


def min_chars_filter(df: DataFrame, min_chars: int = DEFAULT_MIN_CHARS, text: str = "text") -> DataFrame:
    """Keep documents of at least ``min_chars`` code points."""
    if min_chars < 0:
        raise ValueError("min_document_chars must be non-negative")
    return df.where(F.char_length(text) >= min_chars)


def require_documents(df: DataFrame) -> DataFrame:
    """The same documents, or an error when there is none."""
    if df.isEmpty():
        raise EmptyDatasetError("every document was filtered out, or there were none")
    return df


def split_last(df: DataFrame, order: str, group: list[str] | None = None) -> DataFrame:
    """Add ``split``: the last document (of each group) validates, the others train."""
    if group:
        # A NULL group is a group of its own; a group with most rows is split by adaptive execution.
        renamed = [F.col(g).alias(f"__group_{g}") for g in group]
        last = df.groupBy(*renamed).agg(F.max(order).alias("__last"))
        same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"__group_{g}")) for g in group])
        with_last = df.join(last, same).drop(*[f"__group_{g}" for g in group])
        is_last = F.col(order) == F.col("__last")
    else:
        with_last = df
        is_last = F.col(order) == df.agg(F.max(order)).scalar()
    split: Column = F.when(is_last, "validation").otherwise("train")
    return with_last.withColumn("split", split).drop("__last")


def require_split(df: DataFrame) -> DataFrame:
    """At least two documents are needed to hold one back."""
    if len(df.take(2)) < 2:
        raise ValueError("at least two documents are needed to set one apart for validation")
    return df
