"""Object keys, resume cursors and version ids."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters allowed in one part of an object key.
KEY_PART = r"^[A-Za-z0-9._=:-]+$"


def key_part_ok(part: Column) -> Column:
    """Whether a value may stand between two slashes of a key."""
    return F.coalesce(
        part.rlike(KEY_PART) & ~part.isin(".", "..") & ~part.contains("\n"), F.lit(False)
    )


def _checked(part: Column, name: str) -> Column:
    problem = F.concat(F.lit(f"invalid {name}: "), F.coalesce(part, F.lit("NULL")))
    return F.when(key_part_ok(part), part).otherwise(F.raise_error(problem).cast("string"))


def object_key(
    source_id: Column,
    dataset_name: Column,
    version_id: Column,
    ingestion_date: Column,
    run_id: Column,
    shard_sequence: Column,
    extension: Column,
) -> Column:
    """Key of one shard object; a bad part is an error."""
    number = F.when(shard_sequence >= 0, shard_sequence).otherwise(
        F.raise_error(F.lit("shard_sequence must be non-negative")).cast("bigint")
    )
    return F.concat_ws(
        "/",
        _checked(source_id, "source_id"),
        _checked(dataset_name, "dataset_name"),
        F.concat(F.lit("version="), _checked(version_id, "version_id")),
        F.concat(F.lit("ingestion_date="), _checked(ingestion_date, "ingestion_date")),
        F.concat(F.lit("run_id="), _checked(run_id, "run_id")),
        F.format_string(
            "shard-%06d.%s", number, _checked(F.ltrim(extension, F.lit(".")), "extension")
        ),
    )


def manifest_key(source_id: Column, version_id: Column, run_id: Column) -> Column:
    """Key of the manifest of a finished run."""
    return F.concat_ws(
        "/",
        _checked(source_id, "manifest component"),
        F.concat(F.lit("version="), _checked(version_id, "manifest component")),
        F.concat(F.lit("run_id="), _checked(run_id, "manifest component")),
        F.lit("manifest.json"),
    )


def shard_id(run_id: Column, shard_sequence: Column) -> Column:
    """Id of a shard that is the same however often the shard is built."""
    return F.format_string("%s-%06d", run_id, shard_sequence)


def canonical_cursor(cursor: Column) -> Column:
    """Resume cursor as compact JSON with sorted keys; NULL is the empty object."""
    parsed = F.try_parse_json(F.coalesce(cursor, F.lit("{}")))
    problem = F.raise_error(F.lit("checkpoint must decode to a JSON object")).cast("string")
    return F.when(F.schema_of_variant(parsed).startswith("OBJECT"), F.to_json(parsed)).otherwise(
        problem
    )


def encode_cursor(cursor: dict) -> str:
    """Driver-side form of :func:`canonical_cursor`."""
    return json.dumps(cursor, sort_keys=True, separators=(",", ":"))


def new_version_id() -> str:
    """UTC second and eight random hexadecimal digits, so ids sort by time."""
    return f"{datetime.now(timezone.utc):%Y-%m-%dT%H:%M:%SZ}-{uuid4().hex[:8]}"


def new_run_id() -> str:
    """Eight random hexadecimal digits."""
    return uuid4().hex[:8]
