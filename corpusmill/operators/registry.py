"""The source registry: checks and selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.schemas import DEFAULT_BUDGET_BYTES, SOURCE_TYPES

# Fixed value: registry fields that must be given.
REQUIRED_FIELDS = ("source_type", "source_url", "license_name", "license_url", "max_bytes")


class RegistryError(ValueError):
    """The registry or its settings break a rule."""


def registry_check(registry: DataFrame, budget_bytes: int = DEFAULT_BUDGET_BYTES) -> DataFrame:
    """Everything wrong with a registry: ``source_id, problem``.

    Disabled sources do not count towards the budget.
    """
    per_row = F.array(
        F.when(F.col("source_id").isNull(), "missing id"),
        F.when(F.col("source_id") == "", "id must not be empty"),
        *[F.when(F.col(c).isNull(), f"missing {c}") for c in REQUIRED_FIELDS],
        F.when(F.col("max_bytes") <= 0, "max_bytes must be positive"),
    )
    rows = registry.select("source_id", F.explode(F.array_compact(per_row)).alias("problem"))
    twice = (
        registry.where(F.col("source_id").isNotNull())
        .groupBy("source_id")
        .count()
        .where("count > 1")
        .select("source_id", F.lit("source IDs must be unique").alias("problem"))
    )
    active = F.coalesce(F.sum(F.when(F.col("enabled"), F.col("max_bytes"))), F.lit(0))
    budget = (
        registry.agg(active.alias("active"))
        .where(F.col("active") > budget_bytes)
        .select(
            F.lit(None).cast("string").alias("source_id"),
            F.lit("enabled source max_bytes exceed raw budget").alias("problem"),
        )
    )
    return rows.unionByName(twice).unionByName(budget)


def require_valid(
    registry: DataFrame,
    budget_bytes: int = DEFAULT_BUDGET_BYTES,
    target: int | None = None,
    maximum: int | None = None,
    min_chars: int = 0,
) -> DataFrame:
    """The same registry, or an error naming the first problem."""
    if budget_bytes <= 0:
        raise RegistryError("raw_budget_bytes must be positive")
    if min_chars < 0:
        raise RegistryError("min_document_chars must be non-negative")
    if target is not None and maximum is not None and not 0 < target <= maximum:
        raise RegistryError("shard size bounds must satisfy 0 < target <= maximum")
    found = registry_check(registry, budget_bytes).take(1)
    if found:
        raise RegistryError(f"{found[0]['problem']}: {found[0]['source_id']}")
    return registry


def reader_for(source_type: Column, more: tuple[str, ...] = ()) -> Column:
    """The reader a source type is read with; other types are an error.

    Types in ``more`` have readers of their own, named like the type.
    """
    problem = F.raise_error(F.concat(F.lit("unsupported source type: "), source_type))
    return (
        F.when(source_type == "huggingface_dataset", "dataset")
        .when(source_type.isin("http_lines", "filesystem"), "lines")
        .when(source_type == "dolma_manifest", "manifest")
        .when(source_type.isin(*more), source_type)
        .otherwise(problem.cast("string"))
    )


def source_plan(
    registry: DataFrame, source_id: str | None = None, more_types: tuple[str, ...] = ()
) -> DataFrame:
    """The sources to run with their readers; sort by ``ordinal`` for registry order."""
    chosen = registry.where(F.col("enabled"))
    if source_id is not None:
        chosen = chosen.where(F.col("source_id") == source_id)
        if chosen.isEmpty():
            raise ValueError(f"unknown or disabled source: {source_id}")
    return chosen.withColumn("reader", reader_for(F.col("source_type"), more_types))


def unsupported_sources(registry: DataFrame) -> DataFrame:
    """Registry rows whose type no reader handles."""
    return registry.where(~F.coalesce(F.col("source_type").isin(*SOURCE_TYPES), F.lit(False)))
