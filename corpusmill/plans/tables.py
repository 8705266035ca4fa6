"""Control tables kept as append-only parquet folders."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import schemas
from corpusmill.operators import control
from corpusmill.operators.lifecycle import apply_status
from corpusmill.schemas import PENDING

_SCHEMAS = {
    "registrations": schemas.REGISTRATIONS,
    "runs": schemas.RUNS,
    "shards": schemas.SHARDS,
    "status_events": schemas.STATUS_EVENTS,
    "event_log": schemas.EVENT_LOG,
}


class ControlTables:
    """The five control tables below one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def read(self, name: str) -> DataFrame:
        """A table as appended so far; empty before the first append."""
        schema = _SCHEMAS[name]
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows; columns a table does not have are refused, missing ones are NULL."""
        schema = _SCHEMAS[name]
        extra = set(rows.columns) - set(schema.names)
        if extra:
            raise ValueError(f"unknown columns for {name}: {sorted(extra)}")
        columns = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
        rows.select(*columns).write.mode("append").parquet(f"{self.root}/{name}")

    def sources(self) -> DataFrame:
        """Every registered source as it is now."""
        described = control.latest_registrations(self.read("registrations"))
        status = _entity(self.read("status_events"), "source", "source_id")
        shards = self.read("shards")
        return (
            described.join(status, "source_id", "left")
            .join(control.source_totals(described, shards), "source_id")
            .join(control.resume_cursor(described, shards), "source_id")
            .join(control.current_runs(self.read("runs")), "source_id", "left")
            .withColumn("status", F.coalesce("status", F.lit(PENDING)))
        )

    def runs(self) -> DataFrame:
        """Every run as it is now."""
        runs = self.read("runs")
        status = _entity(self.read("status_events"), "run", "run_id")
        totals = control.run_totals(runs, self.read("shards")).drop("source_id")
        return (
            runs.join(status.withColumnRenamed("last_completed_at", "completed_at"), "run_id", "left")
            .join(totals, "run_id")
            .withColumn("status", F.coalesce("status", F.lit(PENDING)))
        )


def _entity(events: DataFrame, entity: str, key: str) -> DataFrame:
    mine = events.where(F.col("entity") == entity).withColumnRenamed("id", key)
    return apply_status(mine, key)
