"""Status changes checked as they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusmill.operators.status_maps import judged
from corpusmill.plans.staging import remove, scratch
from corpusmill.schemas import PENDING, STATES, TRANSITIONS

_OUTPUT = "id string, seq bigint, from_status string, to_status string, accepted boolean"
_STATE = "status string"
_STATES = "id string, status string"


class StatusJudge:
    """Judges batches of status events ``id, seq, status`` against the statuses so far.

    A batch is judged by composed maps (see ``status_maps``), so one entity may have most of
    it. Verdicts and the statuses after a batch are stored under its number: a batch that is
    replayed starts from the same statuses and replaces its own files. Statuses of the batch
    before the last one are removed, so the folder does not grow with the batches.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def states(self, batch_id: int) -> DataFrame:
        """The statuses after a batch; none before the first one."""
        if batch_id < 0:
            return self.spark.createDataFrame([], _STATES)
        return self.spark.read.schema(_STATES).parquet(f"{self.root}/states/{batch_id}")

    def verdicts(self) -> DataFrame:
        try:
            return self.spark.read.schema(_OUTPUT).parquet(f"{self.root}/judged/*")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], _OUTPUT)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with scratch(self.spark):
            found, after = judged(batch, self.states(batch_id - 1))
            found.write.mode("overwrite").parquet(f"{self.root}/judged/{batch_id}")
            after.write.mode("overwrite").parquet(f"{self.root}/states/{batch_id}")
        if batch_id > 1:
            remove(self.spark, f"{self.root}/states/{batch_id - 2}")


def judge_stream(events: DataFrame, judge: StatusJudge, checkpoint: str) -> StreamingQuery:
    """Judge everything that is available now, batch by batch, and stop."""
    return (
        events.writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def lifecycle_stream(events: DataFrame) -> DataFrame:
    """Judge each status event ``id, seq, status`` against the status its entity has.

    A refused change leaves the status as it was. The state kept per entity is one word.
    All changes of one entity in a batch are walked in one task; :class:`StatusJudge` has no
    such limit.
    """
    allowed = frozenset(TRANSITIONS)
    states = frozenset(STATES)
    start = PENDING

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        current = state.get[0] if state.exists else start
        rows = pd.concat(list(frames)).sort_values("seq")
        judged = []
        for seq, target in zip(rows["seq"], rows["status"]):
            if target not in states:
                raise ValueError(f"unknown status: {target}")
            accepted = target == current or (current, target) in allowed
            judged.append((key[0], seq, current, target, accepted))
            current = target if accepted else current
        state.update((current,))
        yield pd.DataFrame(judged, columns=["id", "seq", "from_status", "to_status", "accepted"])

    return events.groupBy("id").applyInPandasWithState(
        step, _OUTPUT, _STATE, "append", GroupStateTimeout.NoTimeout
    )
