"""Streaming ingest: each micro-batch is stored and committed as a whole, once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.functions import keys
from corpusmill.operators import control, quota, sharding
from corpusmill.plans.staging import scratch, stage
from corpusmill.schemas import CHECKSUM_ALGORITHM, COMPLETED
from corpusmill.sources import shards as shard_files
from corpusmill.sources.ranges import SPLIT_BYTES, stream_lines

_PAUSE = "ingest paused between batches"
_COMMITTED = "batch_id bigint, shard_id string, status string, source_id string, shard_sequence bigint, object_key string, record_count bigint, stored_size_bytes bigint, checksum_algorithm string, checksum string, last_pos bigint"


class ShardCommitter:
    """Stores a batch of records ``source_id, pos, payload`` and commits its shards.

    A shard is named by run and number. Numbers go on from the shards of earlier batches,
    so a batch that is replayed builds the same shards under the same names, and those
    already committed are left out. Copies made of a batch are removed when it is committed.
    """

    def __init__(
        self,
        spark,
        root: str,
        table: str,
        run_id: str,
        version_id: str,
        ingestion_date: str,
        target_bytes: int,
        pause_requested: Callable[[], bool] | None = None,
        by_position: bool = False,
    ) -> None:
        self.spark, self.root, self.table = spark, root, table
        self.run_id, self.version_id, self.ingestion_date = run_id, version_id, ingestion_date
        self.target_bytes = target_bytes
        self.pause_requested = pause_requested
        # Whether positions rise from batch to batch, so that they tell what came before even
        # if the stream's own progress was lost.
        self.by_position = by_position

    def committed(self) -> DataFrame:
        """The shards committed so far."""
        try:
            return self.spark.read.schema(_COMMITTED).parquet(self.table)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], _COMMITTED)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.pause_requested is not None and self.pause_requested():
            raise InterruptedError(_PAUSE)
        with scratch(self.spark):
            self._commit(batch, batch_id)

    def cursor(self, source_id: str) -> int:
        """The position behind the last committed record of a source; 0 before the first."""
        done = self.committed().where(F.col("source_id") == source_id)
        return done.agg(F.max("last_pos")).first()[0] or 0

    def _commit(self, batch: DataFrame, batch_id: int) -> None:
        records = stage(batch.select("source_id", "pos", "payload"), "batch")
        sized = quota.sized_records(records, "source_id", "pos", F.col("payload"))
        borders = stage(sharding.shard_borders(sized, self.target_bytes), "borders")
        existing = stage(self.committed(), "committed")
        if self.by_position:
            begins = sized.groupBy("source_id").agg(F.min("pos").alias("begin"))
            before = existing.join(begins, "source_id").where(F.col("last_pos") < F.col("begin"))
        else:
            before = existing.where(F.col("batch_id") < batch_id)
        earlier = before.groupBy("source_id").agg(F.max("shard_sequence").alias("done"))
        numbered = (
            sharding.tag_shards(records, borders)
            .join(earlier, "source_id", "left")
            .withColumn("shard_sequence", F.col("shard_sequence") + F.coalesce("done", F.lit(0)))
        )
        run = F.concat_ws("-", F.lit(self.run_id), "source_id")
        key = keys.object_key(
            F.col("source_id"),
            F.col("source_id"),
            F.lit(self.version_id),
            F.lit(self.ingestion_date),
            F.lit(self.run_id),
            F.col("shard_sequence"),
            F.lit("txt"),
        )
        tasks = shard_files.task_count(borders)
        written = stage(
            shard_files.write_shards(numbered, F.col("payload"), key, self.root, tasks), "written"
        )
        shard_files.require_verified(written)
        rows = written.select(
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            keys.shard_id(run, F.col("shard_sequence")).alias("shard_id"),
            F.lit(COMPLETED).alias("status"),
            "source_id",
            "shard_sequence",
            "object_key",
            "record_count",
            "stored_size_bytes",
            F.lit(CHECKSUM_ALGORITHM).alias("checksum_algorithm"),
            "checksum",
            "last_pos",
        )
        control.require_no_conflicts(existing, rows)
        control.new_shards(existing, rows).select(
            *[c.split()[0] for c in _COMMITTED.split(", ")]
        ).write.mode("append").parquet(self.table)


def start_ingest(records: DataFrame, commit: ShardCommitter, checkpoint: str) -> StreamingQuery:
    """Process everything that is available now, batch by batch, and stop."""
    return (
        records.writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


_FILE_SHIFT = 40


def ingest_lines(
    spark, source_id: str, files: list[tuple[int, str]], commit: ShardCommitter, checkpoint: str, bytes_per_trigger: int = SPLIT_BYTES
) -> bool:
    """Store the lines of numbered files from the last committed shard on; true when paused.

    The stream's offsets are line borders, at most ``bytes_per_trigger`` apart. The cursor of
    the committed shards says where it begins, so nothing is read or stored twice even when
    the checkpoint is gone. ``commit`` must number by position.
    """
    at = commit.cursor(source_id)
    lines = stream_lines(
        spark, files, first_file=at >> _FILE_SHIFT, start_offset=at & ((1 << _FILE_SHIFT) - 1), bytes_per_trigger=bytes_per_trigger
    )
    pos = F.shiftleft(F.col("file_index").cast("bigint"), _FILE_SHIFT) + F.col("end_offset")
    records = lines.select(F.lit(source_id).alias("source_id"), pos.alias("pos"), "payload")
    query = (
        records.writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime="0 seconds")
        .start()
    )
    try:
        # Several bounded batches, until no line is left.
        query.processAllAvailable()
    except StreamingQueryException as error:
        if _PAUSE in str(error):
            return True
        raise
    finally:
        query.stop()
    return False


def run_until_paused(records: DataFrame, commit: ShardCommitter, checkpoint: str) -> bool:
    """Run to the end or to a pause; true when paused.

    A pause is looked for between batches: shards of the batch at hand are committed
    first, and the next start goes on with the first batch that was not begun.
    """
    query = start_ingest(records, commit, checkpoint)
    try:
        query.awaitTermination()
    except StreamingQueryException as error:
        if _PAUSE in str(error):
            return True
        raise
    return False
